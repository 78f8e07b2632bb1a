"""Languages of mixed texts: scripts narrow the candidates, Viterbi labels spans of words."""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.shared import mapped, pick, whole

#: Features of a model; parts of words share them by hash, which bounds the model.
FEATURES = 1 << 15
#: Added to the count of each feature.
ADDED = 0.5
#: A language is a candidate for a script that holds this share of its letters.
SCRIPT_SHARE = 0.01
#: What a change of language costs, and a word in a script that a language does not use.
SWITCH, WRONG_SCRIPT = 8.0, 50.0
UNDETERMINED = "und"
#: Words of texts that are labelled together, and their scores in all languages.
WORDS_A_TURN, SCORES_A_TURN = 1 << 20, 1 << 24

# First code points of the Unicode ranges of scripts.
SCRIPTS = (
    (0x0000, "latin"), (0x0250, "other"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"),
    (0x0590, "hebrew"), (0x0600, "arabic"), (0x0700, "other"), (0x0750, "arabic"), (0x0780, "other"),
    (0x0900, "devanagari"), (0x0980, "bengali"), (0x0A00, "gurmukhi"), (0x0A80, "gujarati"), (0x0B00, "odia"),
    (0x0B80, "tamil"), (0x0C00, "telugu"), (0x0C80, "kannada"), (0x0D00, "malayalam"), (0x0D80, "sinhala"),
    (0x0E00, "thai"), (0x0E80, "lao"), (0x0F00, "tibetan"), (0x1000, "myanmar"), (0x10A0, "georgian"),
    (0x1100, "hangul"), (0x1200, "ethiopic"), (0x13A0, "other"), (0x1780, "khmer"), (0x1800, "mongolian"),
    (0x18B0, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x3040, "kana"),
    (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"),
    (0xF900, "han"), (0xFB00, "other"), (0x20000, "han"),
)
STARTS, NAMES = zip(*SCRIPTS)


def _ranges(kinds: str, last: int) -> str:
    """The code points up to ``last`` whose category begins with one of these letters, for a pattern."""
    found, first = [], None
    for point in range(last + 2):
        inside = point <= last and unicodedata.category(chr(point))[0] in kinds
        if inside and first is None:
            first = point
        elif not inside and first is not None:
            found.append(f"\\U{first:08x}-\\U{point - 1:08x}")
            first = None
    return "".join(found)


@cache
def _words(last: int) -> Callable[[str], list[str]]:
    return re.compile(f"[{_ranges('L', last)}][{_ranges('LM', last)}]*").findall


def words_of(text: str) -> list[str]:
    """The words of a text: a letter of any script, then letters and their marks; number signs are none.

    Up to 16 bits the pattern's sets are tables. Of larger code points it knows ranges, which it tries one
    by one for every character that is no letter, so only texts that have such ones are searched for them.
    """
    small = text.isascii() or len(text.encode("utf-16-le", "surrogatepass")) == 2 * len(text)
    return _words(0xFFFF if small else sys.maxunicode)(text)


def script(word: str) -> str:
    """The script of a word's first letter."""
    return NAMES[bisect_right(STARTS, ord(word[0])) - 1]


class _Buckets(dict):
    """The feature of a part of a word; parts are three letters at most, so they are few."""

    def __missing__(self, part: str) -> int:
        if len(self) > 1 << 18:
            self.clear()
        self[part] = found = crc32(part.encode()) % FEATURES
        return found


_buckets = _Buckets()


def features(word: str) -> list[int]:
    """The features of a word: its parts of two and three letters, ends marked."""
    marked = f"^{word}$"
    parts = [marked[i : i + 3] for i in range(len(marked) - 2)]
    parts += [marked[i : i + 2] for i in range(len(marked) - 1)]
    return [_buckets[part] for part in parts]


@dataclass
class Model:
    """Log probabilities of features per language, and the languages of each script."""

    languages: list[str]
    scores: np.ndarray
    candidates: dict[str, np.ndarray]

    def word_scores(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of each word (row) in each language, and whether any uses its script."""
        found = [features(word) for word in words]
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        flat = np.fromiter((x for xs in found for x in xs), np.int64, int(lengths.sum()))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        scores = np.add.reduceat(self.scores[flat], starts, axis=0)
        none = np.zeros(len(self.languages), bool)
        allowed = np.array([self.candidates.get(script(word), none) for word in words])
        scores[~allowed] -= WRONG_SCRIPT
        known = allowed.any(axis=1)
        scores[~known] = 0
        return scores.astype(np.float32), known


def learn(docs: DataFrame, learned: Column, text: str = "text", lang: str = "lang") -> Model:
    """A model from the rows where ``learned`` holds and neither text nor language is null.

    Every task counts features and scripts of the words of each language; the driver gets their
    sums, at most FEATURES rows for a language.
    """
    rows = docs.where(learned & F.col(text).isNotNull() & F.col(lang).isNotNull())
    rows = pick(rows, text=F.col(text), lang=F.col(lang).cast("string"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        scripts: Counter[tuple[str, str]] = Counter()
        for batch in batches:
            words: dict[str, Counter[str]] = {}
            for text, lang in zip(batch.column(0), batch.column(1).to_pylist()):
                words.setdefault(lang, Counter()).update(words_of(text.as_py().lower()))
            for lang, times in words.items():
                total = totals.setdefault(lang, np.zeros(FEATURES, np.int64))
                found = [features(word) for word in times]
                if found:
                    lengths = np.fromiter(map(len, found), np.int64, len(found))
                    n = np.repeat(np.fromiter(times.values(), np.int64, len(times)), lengths)
                    flat = np.fromiter((x for xs in found for x in xs), np.int64, len(n))
                    total += np.bincount(flat, n, FEATURES).astype(np.int64)
                for word, n in times.items():
                    scripts[lang, script(word)] += n * len(word)
        for lang, total in totals.items():
            places = np.flatnonzero(total)
            yield _counts([lang] * len(places), [None] * len(places), places, total[places])
        yield _counts([x for x, _ in scripts], [x for _, x in scripts], [-1] * len(scripts), list(scripts.values()))

    def _counts(langs: list[str], names: list[str | None], places, n) -> pa.RecordBatch:
        columns = [pa.array(langs, pa.string()), pa.array(names, pa.string()), pa.array(places, pa.int64()), pa.array(n, pa.int64())]
        return pa.record_batch(columns, names=["lang", "script", "feature", "n"])

    sums = mapped(rows, counted, "lang string, script string, feature long, n long")
    found = sums.groupBy("lang", "script", "feature").agg(F.sum("n").alias("n")).collect()
    languages = sorted({row["lang"] for row in found})
    counts = np.full((FEATURES, len(languages)), ADDED)
    letters: dict[str, np.ndarray] = {}
    for row in found:
        column = languages.index(row["lang"])
        if row["script"] is None:
            counts[row["feature"], column] += row["n"]
        else:
            letters.setdefault(row["script"], np.zeros(len(languages)))[column] += row["n"]
    total = sum(letters.values(), np.zeros(len(languages)))
    candidates = {name: n >= SCRIPT_SHARE * np.maximum(total, 1) for name, n in letters.items()}
    return Model(languages, np.log(counts / counts.sum(axis=0)), candidates)


def viterbi(scores: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The best language of every word: texts lie one after another in ``scores``, each word has
    a row. A change of language within a text costs SWITCH. All texts are followed at once."""
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]]).astype(np.int64)
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    running = np.searchsorted(-lengths, -np.arange(steps), "left")  # texts longer than each step
    stays, tops = np.zeros(scores.shape, bool), np.zeros(len(scores), np.int16)
    best = np.zeros((len(lengths), scores.shape[1]), np.float32)
    for step, n in enumerate(running.tolist()):
        rows = starts[:n] + step
        if step:
            before = best[:n]
            top = before.argmax(axis=1)
            most = before[np.arange(n), top][:, None] - SWITCH
            stays[rows], tops[rows] = before >= most, top
            best[:n] = np.maximum(before, most) + scores[rows]
        else:
            best[:n] = scores[rows]
    labels = np.zeros(len(scores), np.int16)
    state = best.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        n = running[step]
        rows = starts[:n] + step
        labels[rows] = state[:n]
        if step:
            state[:n] = np.where(stays[rows, state[:n]], state[:n], tops[rows])
    return labels


PREDICTED = pa.schema(
    [
        ("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()),
        ("spans", pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32()), ("lang", pa.string())]))),
    ]
)


def _labelled(model: Model, keys: pa.Array, texts: list[np.ndarray], words: list[str]) -> pa.RecordBatch:
    """Predictions for texts given as numbers of their words."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    names = np.array(model.languages, object)
    flat = np.concatenate([np.zeros(0, np.int64), *texts]).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    if len(flat) and len(names):
        scores, known = model.word_scores(words)
        labels = viterbi(scores[flat], lengths)
        weights = np.fromiter(map(len, words), np.float64, len(words))[flat]
        letters = np.bincount(owner, weights, len(texts))
        share = np.bincount(owner * len(names) + labels, weights * known[flat], len(texts) * len(names)).reshape(len(texts), -1)
        most = share.argmax(axis=1)
        score = share[np.arange(len(texts)), most] / np.maximum(letters, 1)
        predicted = [names[i] if n else UNDETERMINED for i, n in zip(most, lengths)]
        opens = np.flatnonzero(np.concatenate([[True], (labels[1:] != labels[:-1]) | (owner[1:] != owner[:-1])]))
    else:
        score, predicted = np.zeros(len(texts)), [UNDETERMINED] * len(texts)
        opens, labels = np.zeros(0, np.int64), np.zeros(0, np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    closes = np.concatenate([opens[1:], [len(flat)]])[: len(opens)] - 1
    base = begins[owner[opens]] if len(opens) else opens
    spans = pa.StructArray.from_arrays(
        [pa.array(opens - base, pa.int32()), pa.array(closes - base, pa.int32()), pa.array(names[labels[opens]] if len(opens) else [], pa.string())],
        names=["first", "last", "lang"],
    )
    offsets = np.searchsorted(opens, begins)
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans)
    return pa.record_batch([keys, pa.array(predicted, pa.string()), pa.array(score), lists], schema=PREDICTED)


def _predicted(model: Model, keys: pa.Array, column: pa.Array) -> Iterator[pa.RecordBatch]:
    """Predictions for texts (null ones are empty), some at a time, in their order."""
    most, at = min(WORDS_A_TURN, SCORES_A_TURN // max(1, len(model.languages))), 0
    while at < len(keys):
        numbers: dict[str, int] = {}
        texts, size = [], 0
        while at + len(texts) < len(keys) and size < most:
            words = words_of((column[at + len(texts)].as_py() or "").lower())
            texts.append(np.array([numbers.setdefault(word, len(numbers)) for word in words], np.int64))
            size += len(words)
        yield _labelled(model, keys[at : at + len(texts)], texts, list(numbers))
        at += len(texts)


def in_a_language(
    docs: DataFrame, model: Model, least: float = 0.2, text: str = "text"
) -> DataFrame:
    """``docs`` without those of no determined language: no letters, or less than ``least`` of
    them in the language predicted, which a text in known scripts reaches even where it mixes several
    languages. Each row is judged by itself in the pass that reads it, whatever its key; all columns
    stay as they are, and an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES rows of a number a language
    place = docs.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for found in _predicted(shared.value, pa.nulls(batch.num_rows, pa.int64()), batch.column(place)):
                judged = zip(found.column("lang_pred").to_pylist(), found.column("score").to_pylist())
                kept = pa.array([lang != UNDETERMINED and score >= least for lang, score in judged], pa.bool_())
                yield batch.slice(at, len(kept)).filter(kept)
                at += len(kept)

    return mapped(docs, work, docs.schema)


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The language of every text: ``doc_id, lang_pred, score, spans``. Rows that repeat a key are
    labelled each by itself, a very long text word by word; an empty table gives an empty result.

    ``spans`` are runs of words (numbered from 0) of one language; ``lang_pred`` is the language
    of most letters, and ``score`` their share of all. A word in a script that no language of
    the model uses counts for none. ``lang_pred`` is ``und``, with score 0, for a null text, one
    without letters, and for every text if the model has no language. Ties go to the language
    that comes first by name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES rows of a number a language

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _predicted(shared.value, batch.column(0), batch.column(1))

    schema = "doc_id long, lang_pred string, score double, spans array<struct<first: int, last: int, lang: string>>"
    return mapped(pick(docs, doc_id=F.col(key).cast("long"), text=whole(text)), work, schema)
