"""Language-model scores: the probability of a text over all its segmentations into pieces."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from telemill.llm.blocks import block_of, blocks, dictionary, place_of, summed, unpacked
from telemill.llm.shared import mapped, pick, staged, whole

SPACE = "▁"
#: Added to the count of each piece, so that none is impossible.
ADDED = 0.1
BYTES = tuple(f"<0x{byte:02X}>" for byte in range(256))


def tokens(text: str) -> list[bytes]:
    """The words between ASCII white space, with A-Z in lower case."""
    return text.encode().lower().split()


@cache
def vocabulary(path: str) -> tuple[str, ...]:
    """The pieces of a sentencepiece model and the bytes."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    own = (model.id_to_piece(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return (*own, *BYTES)


class Lattice:
    """Log probabilities of words under a unigram model of pieces.

    A word is a piece that begins with the space sign and what follows up to the next such piece.
    Its probability is the sum over all its segmentations, by a forward recursion in logarithms.
    A character that is no piece is the row of its UTF-8 bytes.
    """

    def __init__(self, scores: dict[str, float]) -> None:
        self._scores = scores
        self._longest = max((len(piece) for piece in scores if piece not in BYTES), default=1)

    def _character(self, character: str) -> float:
        return math.fsum(self._scores[BYTES[byte]] for byte in character.encode())

    def word(self, word: str) -> float:
        scores, text = self._scores, SPACE + word
        forward = [0.0]
        for end in range(1, len(text) + 1):
            ways = []
            for start in range(max(0, end - self._longest), end):
                score = scores.get(text[start:end])
                if score is not None:
                    ways.append(forward[start] + score)
            if text[end - 1] not in scores:
                ways.append(forward[end - 1] + self._character(text[end - 1]))
            best = max(ways)
            forward.append(best + math.log(sum([math.exp(x - best) for x in ways])) if len(ways) > 1 else best)
        return forward[-1]


def piece_scores(table: DataFrame, path: str) -> dict[str, float]:
    """Log probabilities of the pieces, from their counts in the words to learn from as the
    vocabulary's own model cuts them. The driver gets a row per piece of the vocabulary."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        counts = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            for words, learned in zip(*(batch.column(i) for i in range(2))):
                words, times = words.as_py(), learned.values.to_numpy()
                words = [x for x, n in zip(words, times.tolist()) if n]
                ids = model.encode(words, num_threads=1) if words else []
                if ids:
                    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                    np.add.at(counts, np.concatenate([np.array(x, np.int64) for x in ids]), np.repeat(times[times > 0], lengths))
        found = np.flatnonzero(counts)
        pieces = pa.array([model.id_to_piece(i) for i in found.tolist()], pa.string())
        yield pa.record_batch([pieces, pa.array(counts[found])], names=["piece", "n"])

    words = table.where("tokens IS NOT NULL").select("tokens", "learned")
    found = mapped(words, counted, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    counts = {row["piece"]: row["n"] for row in found}
    pieces = vocabulary(path)
    total = math.log(sum(counts.get(piece, 0) for piece in pieces) + ADDED * len(pieces))
    return {piece: math.log(counts.get(piece, 0) + ADDED) - total for piece in pieces}


SCORED = pa.schema(
    [
        ("doc_id", pa.int64()), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64()),
    ]
)
LOG2_10 = math.log2(10)


def scored(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text", learn: str = "learn") -> DataFrame:
    """Log10 probabilities of every text, by the lattice and by counts of words.

    Columns: ``doc_id, learn, n_tokens, n_known, train_tokens, base_score, score``. ``learn`` (a
    boolean column) says which documents the counts come from. Tokens are the words of a text and
    its end. ``base_score`` is the sum of log10((c + 0.5) / (N + 0.5 (V + 1))) with c the count
    of the token, N of all and V of distinct tokens learned; ``n_known`` counts tokens with c > 0.
    ``score`` is the marginal over all segmentations of the text into words learned, whole, and
    the pieces of the sentencepiece vocabulary at ``path`` (on every machine). A word that was
    learned has its share of the words as one more way beside those through pieces, which
    together weigh what words seen for the first time weighed when learning (distinct by distinct
    plus all words). A null text is an empty one: its end only. Each distinct word of the corpus
    is scored once; the driver sees the scores of the vocabulary's pieces and totals.
    """
    rows = pick(docs, doc_id=F.col(key).cast("long"), text=whole(text), learn=F.col(learn))
    table = blocks(rows, lambda: tokens)
    ends = table.where("learn").count()
    scores = piece_scores(table, path)
    shared = docs.sparkSession.sparkContext.broadcast(scores)  # as large as the vocabulary

    def worded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice, token, score = Lattice(shared.value), None, 0.0
        for batch in batches:
            found, first = [], []
            for x in batch.column(1).to_pylist():
                first.append(x != token)
                if x != token:
                    token, score = x, lattice.word(x) / math.log(10)
                found.append(score)
            columns = [batch.column(0), batch.column(2), pa.array(found, pa.float64()), pa.array(first, pa.bool_())]
            yield pa.record_batch(columns, names=["at", "n", "score", "first"])

    counted = dictionary(table).select("at", "token", F.sum("learned").over(W.partitionBy("token")).alias("n"))
    values = staged(mapped(counted, worded, "at long, n long, score double, first boolean"), "words")
    learned = table.where("tokens IS NOT NULL").select(F.explode("learned").alias("n")).agg(F.sum("n"))
    words, kinds = learned.first()[0] or 0, values.where("first AND n > 0").count()
    train_tokens = words + ends
    divisor = math.log10(train_tokens + 0.5 * (kinds + (ends > 0) + 1))
    end_base, end_share = math.log10(ends + 0.5) - divisor, (ends + 0.5) / (train_tokens + 1)
    new_share = kinds / (words + kinds) if words else 1.0

    def sums(found: pa.Table, documents: pa.Table) -> pa.Table:
        found = found.sort_by("place")
        n, pieces = found.column("n").to_numpy(), found.column("score").to_numpy()
        base, known = np.log10(n + 0.5) - divisor, (n > 0).astype(np.int64)
        with np.errstate(divide="ignore"):  # a word that was not learned has no way of its own
            whole_word = np.log10(n / max(1, words + kinds))
        ways = np.logaddexp2(whole_word * LOG2_10, (pieces + math.log10(new_share)) * LOG2_10) / LOG2_10
        score = ways + math.log10(1 - end_share)
        columns: dict[str, list] = {"n_tokens": [], "n_known": [], "base_score": [], "score": []}
        for pairs in documents.column("pairs"):
            places, times = unpacked(pairs.as_py())
            columns["n_tokens"].append(int(times.sum()) + 1)
            columns["n_known"].append(int(known[places] @ times) + (ends > 0))
            columns["base_score"].append(float(base[places] @ times) + end_base)
            columns["score"].append(float(score[places] @ times) + math.log10(end_share))
        columns |= {"train_tokens": [train_tokens] * len(documents), "learn": documents.column("learn")}
        return pa.table({"doc_id": documents.column("doc_id")} | columns).select(SCORED.names).cast(SCORED)

    schema = (
        "doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double"
    )
    placed = values.select(block_of(F.col("at")).alias("block"), place_of(F.col("at")).alias("place"), "n", "score")
    return summed(table, placed, sums, schema)
