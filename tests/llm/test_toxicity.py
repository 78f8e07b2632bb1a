"""Toxicity on invented texts: held-out accuracy, scores by hand, and odd tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import toxicity

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"
BAD = ["nasty", "foulness", "wretched", "vileword"]


def texts(n, seed):
    """Half of the rows hold bad words among invented ones; some labels are wrong."""
    draw = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en"]
    known = ["".join(draw.choices(parts, k=draw.randint(1, 4))) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        words = draw.choices(known, k=draw.randint(5, 200))
        bad = i % 2 == 0
        for _ in range(draw.randint(1, 4) if bad else 0):
            words.insert(draw.randrange(len(words) + 1), draw.choice(BAD) + draw.choice(["", ".", "!"]))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(bad) if draw.random() > 0.1 else int(not bad)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted(spark):
    rows, labels = texts(600, 1)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs, toxicity.learn(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 3 != 0)


def test_held_out_accuracy(fitted):
    docs, model = fitted
    assert set(BAD) <= set(model.telling)
    found = toxicity.toxicity(docs, model).where("doc_id % 3 = 0").collect()
    right = [row.predicted == (row.doc_id % 2 == 0) for row in found]
    assert np.mean(right) > 0.97


def test_scores_by_hand(fitted):
    """Every window compressed anew, without batches or counts."""
    docs, model = fitted
    ordinary, toxic = toxicity._compressor(model.ordinary), toxicity._compressor(model.ordinary + model.toxic)
    given = {row.doc_id: row.text for row in docs.where("doc_id < 100").collect()}
    for row in toxicity.toxicity(docs.where("doc_id < 100"), model).collect():
        gains = [len(ordinary.compress(w + bytes(8))) - len(toxic.compress(w + bytes(8))) for w in toxicity.windows(given[row.doc_id])]
        evidence = sum(max(0, min(gain, 31) - model.threshold) for gain in gains)
        assert (row.windows, row.evidence) == (len(gains), evidence)
        assert row.score == pytest.approx(1 / (1 + (evidence + 1) ** -model.weight * np.exp(-model.offset)))
        assert row.predicted == (row.score >= 0.5)


def test_odd_rows(spark, fitted):
    _, model = fitted
    rows = [(None, None, None, None), (1, "", "en", "s"), (1, "   \n", "en", "s"), (1, "nasty", None, None), (1, "nasty", None, None)]
    rows += [(2, "the " * 300_000 + "foulness wretched nasty", "en", "s"), (3, "no" * 50_000, "xx", "s"), (4, "日本語 \x00 🙂", "ja", "s")]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("score", "predicted", "windows", "evidence", "top_gain", "toxic", "key"):
        docs = docs.withColumn(name, F.lit("clash"))
    found = toxicity.toxicity(docs, model)
    assert found.columns == ["doc_id", "score", "predicted", "windows", "evidence", "top_gain"]
    out = sorted(map(tuple, found.collect()), key=repr)
    assert len(out) == len(rows)
    least = model.probability(np.array(0.0))
    scores = {}
    for doc_id, score, *_ in out:
        scores.setdefault(doc_id, []).append(score)
    assert scores[None] == [least] and sorted(scores[1])[:2] == [least, least]
    assert sorted(scores[1])[2] == sorted(scores[1])[3]
    assert scores[2][0] > 0.5 and all(0 <= score <= 1 for own in scores.values() for score in own)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s"), (2, None, None, None)], SCHEMA)
    no_labels = spark.createDataFrame([], LABELS)
    model = toxicity.learn(docs, no_labels, F.lit(True))
    assert [row.score for row in toxicity.toxicity(docs, model).collect()] == [pytest.approx(0.5)] * 2
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 1, 1), (2, 0, 0), (9, 1, 1)], LABELS)
    empty = spark.createDataFrame([], SCHEMA)
    model = toxicity.learn(docs, odd, F.lit(True))
    assert toxicity.toxicity(empty, model).collect() == []
    assert toxicity.toxicity(empty, toxicity.learn(empty, odd, F.lit(True))).collect() == []


def test_a_label_decides_once(spark):
    """A document is toxic if one of its labels says so; near copies count once."""
    same = "many ordinary words here oddword follow one another " * 3
    rows = [(i, f"{same} {i}", "en", "s") for i in range(40)] + [(100 + i, f"plain text number {i} goes on", "en", "s") for i in range(200)]
    labels = [(i, 1, int(i < 40)) for i in [*range(40), *range(100, 300)]]
    model = toxicity.learn(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS), F.lit(True))
    assert model.telling == []


def test_rarer_words_tell_as_well(spark):
    """Words of a language with a few toxic texts tell them, whatever words of other languages do."""
    rows, labels = texts(600, 2)
    draw = random.Random(3)
    stems = ["zor", "gul", "mip", "tek", "waf", "lon", "sib", "kad", "rux", "pev", "dot", "nuc"]
    rare = ["zorgul" + x for x in stems[:6]]
    for i in range(600, 840):
        words = ["".join(draw.choices(stems, k=3)) for _ in range(30)]
        words += draw.sample(rare, 5) if i % 4 == 0 else []
        rows.append((i, " ".join(draw.sample(words, len(words))), "xx", "s"))
        labels.append((i, 1, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    model = toxicity.learn(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 3 != 0)
    assert set(BAD) | set(rare) <= set(model.telling)
    found = toxicity.toxicity(docs, model).where("doc_id >= 600 AND doc_id % 3 = 0").collect()
    caught = [row.predicted for row in found if row.doc_id % 4 == 0]
    left = [1 - row.predicted for row in found if row.doc_id % 4]
    assert np.mean(caught) > 0.8 and np.mean(left) > 0.8


def test_windows_hold_all_words():
    text = "a bb\nccc  " + "d" * 500 + " é " + "word " * 100
    joined = b"".join(toxicity.windows(text)).replace(b" ", b"").replace(b"\n", b"")
    assert joined == text.replace(" ", "").replace("\n", "").encode()
