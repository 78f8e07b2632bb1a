"""Toxic texts by compression: windows that a dictionary of toxic words makes shorter."""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.shared import mapped, pick, staged, whole

#: Labelled documents of each kind that are learned from, about, and windows of the ordinary ones.
LEARNED, WINDOWS = 4000, 60_000
#: Bytes of the dictionary of ordinary windows, and the trainer's segments.
ORDINARY_BYTES = 1 << 16
SEGMENT, PARTS = 64, 6
#: A word tells toxic texts if it is so many times as frequent in them, with a log-likelihood ratio
#: (twice its natural logarithm) of this at least. How telling other words are does not matter: those of a
#: language with few texts, or of one that makes many words of a few stems, are rarer than those of others.
TIMES, RATIO = 8, 15.0
TELLING = 1000
#: Ordinary words that stand beside each telling one, by their beginnings and by their ends, on each side.
BEGIN_ALIKE, END_ALIKE = 4, 2
#: Gains of a window are counted up to GAINS; up to THRESHOLDS are tried as the largest that says nothing.
GAINS, THRESHOLDS = 32, 8

WORDS = re.compile(r"[^\W\d_]+")
#: A window begins with a word and ends with one, after about 60 letters; a longer word is cut.
WINDOW = re.compile(r"\S.{0,56}\S{0,40}", re.DOTALL)
#: The compressor begins no match in the last bytes of what it gets.
REST = b"\0" * 8


def windows(text: str) -> list[bytes]:
    """A text in lower case as windows that together hold every word of it."""
    return [b" %b " % window.encode() for window in WINDOW.findall(text.lower())]


def _compressor(content: bytes) -> zstandard.ZstdCompressor:
    content = content or b" " * 8
    settings = zstandard.ZstdCompressionParameters(
        window_log=18, hash_log=16, chain_log=17, search_log=7, min_match=6, strategy=zstandard.STRATEGY_BTOPT,
        write_checksum=0, write_content_size=0, write_dict_id=0,
    )
    known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    known.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=known, compression_params=settings)


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary of the passages that occur in most samples; where they are too few for the
    trainer, all of them as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=SEGMENT, d=PARTS).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(sorted(set(samples)))[-size:]


def lookalikes(telling: list[str], passages: list[bytes]) -> list[str]:
    """The words of ordinary passages that begin or end most like telling words. Behind the ordinary
    dictionary they make what such words share with others as cheap as in the toxic one, so that
    only whole telling words gain."""
    words = sorted({word for passage in passages for word in WORDS.findall(passage.decode())})
    found: dict[str, None] = {}
    for sort, width in ((lambda word: word, BEGIN_ALIKE), (lambda word: word[::-1], END_ALIKE)):
        ordered = sorted(words, key=sort)
        for word in telling:
            at = bisect_left(ordered, sort(word), key=sort)
            found.update(dict.fromkeys(ordered[max(0, at - width) : at + width]))
    return list(found)


@dataclass
class Model:
    """Two dictionaries, of ordinary text and of toxic words, and what gains mean.

    What windows gain above ``threshold`` is a text's evidence, and ``weight`` and ``offset`` make a
    probability of it.
    """

    ordinary: bytes
    toxic: bytes
    threshold: int = 0
    weight: float = 0.0
    offset: float = 0.0
    telling: list[str] = field(default_factory=list)

    @cached_property
    def _compressors(self) -> tuple[zstandard.ZstdCompressor, zstandard.ZstdCompressor]:
        # The toxic one knows ordinary text as well, so that both do equally well on it.
        return _compressor(self.ordinary), _compressor(self.ordinary + self.toxic)

    def gains(self, text: str) -> np.ndarray:
        """By how many bytes each window is shorter with the toxic dictionary."""
        if not self.toxic:
            return np.zeros(len(windows(text)), np.int64)
        ordinary, toxic = (x.compress for x in self._compressors)
        return np.array([len(ordinary(w + REST)) - len(toxic(w + REST)) for w in windows(text)], np.int64)

    def counted(self, text: str) -> np.ndarray:
        """How many windows have each gain from 0 up."""
        return np.bincount(np.clip(self.gains(text), 0, GAINS - 1), minlength=GAINS)

    def evidence(self, counts: np.ndarray) -> np.ndarray:
        """What windows gain above the threshold, for rows of counts."""
        return counts @ np.maximum(np.arange(GAINS) - self.threshold, 0)

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.weight * np.log1p(evidence) + self.offset)))

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "_compressors"}


def fitted(x: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, float]:
    """Logistic regression of one number: weight and offset, and the log-likelihood. Newton's method,
    with the weight slightly bound to 0."""
    n = len(known)
    share = (known.sum() + 0.5) / (n + 1)
    design, bound = np.column_stack([x, np.ones(n)]), np.diag([0.01, 1e-6])
    weights = np.array([0.0, np.log(share / (1 - share))])

    def probabilities() -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))

    for _ in range(50 if n else 0):
        p = probabilities()
        curve = (design * (p * (1 - p))[:, None]).T @ design + bound
        step = np.linalg.solve(curve, design.T @ (known - p) - bound @ weights)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    p = probabilities()
    return weights, float(np.log(np.where(known > 0, p, 1 - p)).sum())


def calibrated(model: Model, counts: np.ndarray, toxic: np.ndarray) -> Model:
    """The model with the threshold that makes the labels of texts likeliest, given the gains of
    their windows, and its weight and offset; the smallest threshold if several do."""
    best = -np.inf
    for threshold in range(THRESHOLDS + 1):
        tried = replace(model, threshold=threshold)
        (weight, offset), likelihood = fitted(np.log1p(tried.evidence(counts)), toxic.astype(float))
        if likelihood > best + 1e-9 and weight >= 0 or threshold == 0:
            best = likelihood
            chosen = replace(tried, weight=max(0.0, float(weight)), offset=float(offset))
    return chosen


# Learning


def _sampled(rows: DataFrame, toxic: bool) -> DataFrame:
    """Rows of one kind, LEARNED of them about, by a hash of their keys and texts."""
    own = rows.where(F.col("toxic") == toxic)
    share = min(1.0, LEARNED / max(1, own.count()))
    return own.where(F.pmod(F.xxhash64("key", "text"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every distinct word of a text with a hash of its first occurrence's neighbours."""
    for batch in batches:
        for text, toxic in zip(batch.column("text"), batch.column("toxic")):
            words = ["", *WORDS.findall(text.as_py().lower()), ""]
            first: dict[str, str] = {}
            for before, word, after in zip(words, words[1:], words[2:]):
                if word not in first:
                    first[word] = f"{before} {after}"
            hashes = [xxhash.xxh3_64_intdigest(x) >> 1 for x in first.values()]
            columns = [pa.array(list(first), pa.string()), pa.array(hashes, pa.int64()), pa.array([toxic.as_py()] * len(first), pa.bool_())]
            yield pa.record_batch(columns, names=["word", "context", "toxic"])


def telling_words(sample: DataFrame) -> list[str]:
    """The words that tell toxic texts, the least telling first, TELLING at most.

    A word counts once for a text, and once for all texts that have it between the same words
    first, so that a group of near copies does not make its own words telling.
    """
    n = {row.toxic: row.n for row in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if not n.get(True) or not n.get(False):
        return []
    found = mapped(sample.select("text", "toxic"), _contexts, "word string, context long, toxic boolean").distinct()
    counts = found.groupBy("word").agg(
        F.count(F.when(F.col("toxic"), 1)).cast("double").alias("a"), F.count(F.when(~F.col("toxic"), 1)).cast("double").alias("b")
    )
    p = (F.col("a") + F.col("b")) / (n[True] + n[False])

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.ln(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(F.col("a"), p * n[True]) + part(F.col("b"), p * n[False]))
    frequent = F.col("a") / n[True] > TIMES * F.col("b") / n[False]
    best = counts.where(frequent).withColumn("ratio", ratio).where(F.col("ratio") >= RATIO)
    rows = best.orderBy(F.col("ratio").desc(), "word").limit(TELLING).collect()
    return [row.word for row in reversed(rows)]


def _passages(telling: set[str]):
    """Texts as windows without any telling word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text"):
                found = [w for w in windows(text.as_py()) if telling.isdisjoint(WORDS.findall(w.decode()))]
                yield pa.record_batch([pa.array(found, pa.binary())], names=["window"])

    return work


def _some(rows: DataFrame, most: int) -> list[bytes]:
    """Distinct windows of all rows, about so many of them, by a hash, in one order."""
    rows = staged(rows.distinct(), "windows")
    share = min(1.0, most / max(1, rows.count()))
    chosen = rows.where(F.pmod(F.xxhash64("window"), F.lit(1 << 20)) < F.lit(share * (1 << 20)))
    return sorted(bytes(row.window) for row in chosen.collect())  # of a bounded size


def learn(docs: DataFrame, labels: DataFrame, learned: Column, key: str = "doc_id", text: str = "text") -> Model:
    """A model from the documents where ``learned`` holds and that have a ``toxic`` label.

    Of each kind LEARNED documents at most, about, are learned from, whole. Toxic ones hold mostly
    ordinary words too, so the toxic dictionary is the words alone that tell them (``telling_words``),
    and the ordinary one is trained on windows of ordinary documents without any, with words that look
    like telling ones (``lookalikes``) behind it. A document is toxic if one of its labels says so; null
    keys and labels teach nothing, nor does a document that is null.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("marked"))
    marks = marks.agg((F.max("toxic") == 1).alias("toxic"))
    rows = pick(docs.where(learned & F.col(text).isNotNull()), key=F.col(key).cast("long"), text=F.col(text).cast("string"))
    rows = rows.join(marks, rows["key"] == marks["marked"]).select("key", "text", "toxic")
    sample = staged(staged(_sampled(rows, True), "toxic").union(staged(_sampled(rows, False), "ordinary")), "learned")
    telling = telling_words(sample)
    passages = mapped(sample.where("NOT toxic").select("text"), _passages(set(telling)), "window binary")
    known = _some(passages, WINDOWS)
    ordinary, toxic = trained(known, ORDINARY_BYTES), b""
    if telling:
        ordinary += f" {'  '.join(lookalikes(telling, known))} ".encode()
        # Each word once and whole, the most telling one last, where it is cheapest to refer to.
        toxic = f" {'  '.join(telling)} ".encode()
    model = Model(ordinary, toxic, telling=telling)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [shared.value.counted(text.as_py()).tolist() for text in batch.column("text")]
            yield pa.record_batch([batch.column("toxic"), pa.array(counts, pa.list_(pa.int64()))], names=["toxic", "counts"])

    found = mapped(sample.select("text", "toxic"), counted, "toxic boolean, counts array<long>").collect()  # LEARNED rows of a kind
    counts = np.array([row.counts for row in found], np.int64).reshape(-1, GAINS)
    return calibrated(model, counts, np.array([row.toxic for row in found], bool))


def toxicity(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The toxicity of every text: the key, ``score`` (0 to 1), ``predicted`` (1 from a score of 0.5),
    ``windows``, ``evidence`` (bytes gained above the threshold) and ``top_gain`` (of a window).

    A null text is an empty one; it has no window and the least score, like a text without evidence.
    Rows that repeat a key are scored each by itself, equal texts get equal scores, and a very long
    text is followed window by window. Where nothing was learned all scores are the share of toxic
    labels (one half of one row without any). An empty table gives an empty result; other columns
    are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # two dictionaries of a fixed size

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            counts = np.array([model.counted(text.as_py()) for text in batch.column(1)], np.int64).reshape(-1, GAINS)
            evidence = model.evidence(counts)
            score = model.probability(evidence)
            top = np.where(counts > 0, np.arange(GAINS), 0).max(axis=1, initial=0)
            columns = [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(counts.sum(axis=1)), pa.array(evidence), pa.array(top)]
            yield pa.record_batch(columns, names=["doc_id", "score", "predicted", "windows", "evidence", "top_gain"])

    schema = "doc_id long, score double, predicted int, windows long, evidence long, top_gain long"
    found = mapped(pick(docs, doc_id=F.col(key).cast("long"), text=whole(text)), work, schema)
    return found.withColumnRenamed("doc_id", key)
