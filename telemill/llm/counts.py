"""Token counts: pieces are counted once per distinct pre-token of the corpus."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.blocks import PLACE_BITS, blocks, dictionary, packed, summed, unpacked
from telemill.llm.shared import mapped, pick, whole

SPACE = "▁"
#: Counts that go back to their blocks together.
VALUES_A_TURN = 1 << 18
#: Ways to cut a text, the finer first: spaces go with what follows them.
CUTS = (
    r" *[A-Za-z\x80-\U0010ffff]+| *[!-@\[-`{-~]+| +|[\x00-\x1f\x7f]",
    r" *[^ ]+| +",
)


@cache
def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2 as proto

    made = proto.ModelProto()
    with open(path, "rb") as file:
        made.ParseFromString(file.read())
    return made


@cache
def _processor(path: str):
    """The model without the space it puts before a text, for parts of texts."""
    from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2 as proto

    made = proto.ModelProto()
    made.CopyFrom(_model(path))
    made.normalizer_spec.add_dummy_prefix = False
    return SentencePieceProcessor(model_proto=made.SerializeToString())


def pre_tokens(path: str) -> Callable[[str], Sequence[str]]:
    """The function that cuts a text into parts no piece of the vocabulary reaches across.

    Merges happen inside such parts only, so the pieces of a text are those of its parts.
    """
    made = _model(path)
    spec = made.normalizer_spec
    if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
        raise ValueError("only a model that takes texts as they are can be cut")
    pieces = [x.piece.replace(SPACE, " ") for x in made.pieces if x.type in (x.NORMAL, x.USER_DEFINED)]
    for cut in CUTS:
        parts = re.compile(cut).findall
        if all(len(parts(piece)) == 1 for piece in pieces):
            prefix = " " if spec.add_dummy_prefix else ""
            return lambda text: parts(prefix + text.replace(SPACE, " ")) if text else []
    raise ValueError("the vocabulary has pieces across spaces")


def token_counts(
    docs: DataFrame, path: str, limit: int = 4096, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every text, as the sentencepiece model at
    ``path`` (on every machine) counts it, without begin and end.

    Each distinct pre-token of the corpus is counted once; ids are made for it alone. A null text
    is an empty one and has no tokens. Rows that repeat a key are counted each by itself.
    """
    rows = pick(docs, doc_id=F.col(key).cast("long"), text=whole(text), learn=F.lit(False))
    table = blocks(rows, lambda: pre_tokens(path))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, last, kept, size = _processor(path).encode, (None, 0), [], 0
        for batch in batches:
            tokens = batch.column(1).to_pylist()
            distinct = [x for x, before in zip(tokens, [last[0], *tokens]) if x != before]
            found = dict(zip(distinct, map(len, encode(distinct, num_threads=1)))) if distinct else {}
            found.setdefault(*last)
            kept.append((batch.column(0).to_numpy(), np.fromiter((found[x] for x in tokens), np.int64, len(tokens))))
            size += len(tokens)
            if size > VALUES_A_TURN:
                yield by_block(kept)
                kept, size = [], 0
            if tokens:
                last = (tokens[-1], found[tokens[-1]])
        yield by_block(kept)

    def by_block(kept: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        at, n = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*kept) if kept else ((), ())))
        order = np.argsort(at)
        at, n = at[order], n[order]
        numbers, first = np.unique(at >> PLACE_BITS, return_index=True)
        ends = [*first[1:], len(at)]
        pairs = [packed(at[a:b] & ((1 << PLACE_BITS) - 1), n[a:b]) for a, b in zip(first, ends)]
        return pa.record_batch([pa.array(numbers, pa.int64()), pa.array(pairs, pa.binary())], names=["block", "pairs"])

    tokens = dictionary(table).select("at", "token").repartition("token").sortWithinPartitions("token")
    values = mapped(tokens, counted, "block long, pairs binary")

    def sums(found: pa.Table, documents: pa.Table) -> pa.Table:
        parts = [unpacked(pairs.as_py()) for pairs in found.column("pairs")]
        n = np.zeros(1 + max((int(places.max()) for places, _ in parts), default=-1), np.int64)
        for places, counts in parts:
            n[places] = counts
        totals = []
        for pairs in documents.column("pairs"):
            places, times = unpacked(pairs.as_py())
            totals.append(int(n[places] @ times))
        n_tokens = pa.array(totals, pa.int64())
        over = pa.array(np.array(totals, np.int64) > limit)
        return pa.table(
            [documents.column("doc_id"), documents.column("n_bytes"), n_tokens, over],
            names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
        )

    return summed(table, values, sums, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
