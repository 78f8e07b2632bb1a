"""The filter audit against a count of every order by hand."""

import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from telemill.llm import audit

SCHEMA = "doc_id BIGINT, text STRING, lang STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"
COLUMNS = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def failing(rows):
    """Per row the letters of the filters it fails."""
    out = []
    for key, text, _ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ""
        fails += "A" * (len(words) < 100)
        fails += "B" * (100 * len(set(words)) < 80 * len(words))
        fails += "C" * (100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text))
        fails += "D" * bool(re.search(r"[#$%&*|]", text))
        fails += "E" * (key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows))
        out.append(fails)
    return out


def by_hand(rows, labels):
    good = {key for key, quality, _ in labels if quality == 1 and key is not None}
    toxic = {key for key, _, mark in labels if mark == 1 and key is not None}
    docs = [(lang or "", key, fails) for (key, _, lang), fails in zip(rows, failing(rows))]
    counted, shapley = {}, Counter()
    for part in {part for part, _, _ in docs}:
        for order in permutations("ABCDE"):
            left = [(key, fails) for lang, key, fails in docs if lang == part]
            total = sum(1 for _ in left)
            everyone = list(left)
            for step, letter in enumerate(order, 1):
                gone = [(key, fails) for key, fails in left if letter in fails]
                left = [(key, fails) for key, fails in left if letter not in fails]
                fail = sum(letter in fails for _, fails in everyone)
                unique = sum(fails == letter for _, fails in everyone)
                shapley[part, letter] += len(gone)
                counted[part, "".join(order), step] = (
                    len(left), len(gone), fail - len(gone), unique, sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone),
                )
            assert total == len(everyone)
    return sorted((*place, *counts, shapley[place[0], place[1][place[2] - 1]]) for place, counts in counted.items())


def some_rows(n, seed):
    draw = random.Random(seed)
    words = ["alpha", "Beta", "GAMMA", "d#lta", "e", "ümlaut", "日本"]
    rows = []
    for i in range(n):
        size = draw.choice([0, 1, 20, 99, 100, 120, 400])
        text = draw.choice([" ", "\n", "\t ", "\x0b"]).join(draw.choice(words[: draw.randint(1, 7)]) + str(draw.randrange(draw.choice([1, 50, 10**6]))) for _ in range(size))
        rows.append((i, text, draw.choice(["en", "de", None, ""])))
    copies = [(n + i, text, lang) for i, (_, text, lang) in enumerate(draw.choices(rows, k=n // 3))]
    odd = [(None, None, None), (None, None, None), (None, rows[0][1], "en"), (3, rows[5][1], "fr"), (3, rows[5][1], "fr"), (-1, rows[5][1], "fr")]
    odd += [(10**6, "\x00 A\xa0B  ", "en"), (10**6 + 1, " \n\t", "en"), (10**6 + 2, "x " * 200_000, "en")]
    return rows + copies + odd


def test_audit(spark):
    rows = some_rows(150, 1)
    labels = [(i, i % 3 and 1, int(i % 7 == 0)) for i in range(0, 180, 2)] + [(4, 0, 1), (4, 2, 0), (None, 1, 1), (8, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    for name in ("row", "part", "digest", "good", "toxic", "range", "n", "A", "filter", "before", "marked_key"):
        docs = docs.withColumn(name, F.lit("clash"))
    marks = spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("clash"))
    found = audit.filter_audit(docs.repartition(3), marks).select(COLUMNS)
    assert sorted(map(tuple, found.collect())) == by_hand(rows, labels)


def test_ranges_add_up(spark, monkeypatch):
    monkeypatch.setattr(audit, "RANGE_BITS", 3)
    rows = some_rows(60, 2)
    found = audit.filter_audit(spark.createDataFrame(rows, SCHEMA).repartition(2), spark.createDataFrame([], LABELS))
    assert sorted(map(tuple, found.select(COLUMNS).collect())) == by_hand(rows, [])


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert audit.filter_audit(empty, spark.createDataFrame([], LABELS)).collect() == []


@pytest.mark.parametrize("seed", range(20))
def test_merges_of_sorted_lists(seed):
    draw = random.Random(seed)
    lists = [sorted(draw.sample(range(300), draw.choice([0, 1, 5, 40, 250]))) for _ in range(5)]
    assert audit.union(lists) == sorted(set().union(*lists))
    assert audit.difference(lists[0], lists[1]) == sorted(set(lists[0]) - set(lists[1]))
    for target in (-1, 0, 7, 150, 299, 400):
        at = draw.randrange(len(lists[2]) + 1)
        assert audit.gallop(lists[2], target, at) == at + sum(x < target for x in lists[2][at:])
