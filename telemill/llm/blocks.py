"""Per-document sums over tokens whose values are known only from the whole corpus.

A shuffle of every token of every document would move many times the input. Here a task gathers
documents into blocks of bounded size and writes, per block, a dictionary of its distinct tokens
and, per document, which of them it has and how often. Only the dictionaries are shuffled by
token; each distinct token gets its value there once, and the values go back to their blocks,
where they meet the documents' frequencies. A frequent token is one row per block.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.shared import mapped, reachable, staged

#: A block ends with the document that brings it over one of these.
TOKENS_A_BLOCK = 1 << 20
DOCUMENTS_A_BLOCK = 1 << 14
#: A block's number and a place in its dictionary are one number; a document can bring a block
#: over its bound, by less than this.
PLACE_BITS = 32
#: Tokens in one row of a dictionary.
TOKENS_A_ROW = 1 << 13

BLOCKS = "block long, place int, tokens array<string>, learned array<long>, doc_id long, n_bytes long, learn boolean, pairs binary"
_SCHEMA = pa.schema(
    [
        ("block", pa.int64()), ("place", pa.int32()), ("tokens", pa.list_(pa.string())), ("learned", pa.list_(pa.int64())),
        ("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("learn", pa.bool_()), ("pairs", pa.binary()),
    ]
)


class _Block:
    def __init__(self, number: int) -> None:
        self.number = number
        self.places: dict[str | bytes, int] = {}
        self.learned: Counter[int] = Counter()
        self.documents: list[dict] = []

    def add(self, doc_id: int | None, text: str, learn: bool, tokens: Sequence[str | bytes]) -> None:
        times, places = Counter(tokens), self.places
        found = np.array([places.setdefault(token, len(places)) for token in times], np.uint32)
        counts = np.fromiter(times.values(), np.uint32, len(times))
        if learn:
            self.learned.update(dict(zip(found.tolist(), counts.tolist())))
        order = np.argsort(found)
        pairs = packed(found[order], counts[order])
        self.documents.append(
            {"block": self.number, "doc_id": doc_id, "n_bytes": len(text.encode()), "learn": learn, "pairs": pairs}
        )

    def full(self) -> bool:
        return len(self.places) >= TOKENS_A_BLOCK or len(self.documents) >= DOCUMENTS_A_BLOCK

    def rows(self) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pylist(self.documents, _SCHEMA)
        tokens = [x if isinstance(x, str) else x.decode() for x in self.places]
        for place in range(0, len(tokens), TOKENS_A_ROW):
            part = tokens[place : place + TOKENS_A_ROW]
            learned = [self.learned[i] for i in range(place, place + len(part))]
            row = {"block": self.number, "place": place, "tokens": part, "learned": learned}
            yield pa.RecordBatch.from_pylist([row], _SCHEMA)


def packed(places: np.ndarray, numbers: np.ndarray) -> bytes:
    """Ascending places of a dictionary with a number each, as few bytes."""
    pairs = np.concatenate([np.diff(places.astype("<u4"), prepend=np.uint32(0)), numbers.astype("<u4")])
    # The bytes of one significance lie together, which compresses better.
    return zlib.compress(pairs.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpacked(pairs: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The places and numbers that were packed: for a document, the places of its tokens in its
    block's dictionary and how often each occurs."""
    raw = np.frombuffer(zlib.decompress(pairs), np.uint8).reshape(4, -1).T
    both = np.ascontiguousarray(raw).view("<u4").ravel()
    half = len(both) // 2
    return np.cumsum(both[:half], dtype=np.int64), both[half:].astype(np.int64)


def blocks(docs: DataFrame, tokens_of: Callable[[], Callable[[str], Sequence[str | bytes]]]) -> DataFrame:
    """``docs`` (``doc_id, text, learn``) as a staged table of blocks. ``tokens_of`` makes the
    function that cuts a text; ``learn`` says whose tokens count in ``learned``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, first = tokens_of(), TaskContext.get().partitionId() << 12
        block = _Block(first)
        for batch in batches:
            for doc_id, text, learn in zip(*batch.columns):
                text = text.as_py()
                block.add(doc_id.as_py(), text, learn.as_py(), cut(text))
                if block.full():
                    yield from block.rows()
                    block = _Block(block.number + 1)
        yield from block.rows()

    return staged(mapped(docs.select("doc_id", "text", "learn"), work, BLOCKS), "blocks")


def dictionary(table: DataFrame) -> DataFrame:
    """``at, token, learned``: a row per distinct token of a block, ``at`` being where it is."""
    rows = table.where("tokens IS NOT NULL").select(
        "block", "place", F.posexplode(F.arrays_zip("tokens", "learned")).alias("i", "x")
    )
    at = F.shiftleft("block", PLACE_BITS) + F.col("place") + F.col("i")
    return rows.select(at.alias("at"), F.col("x.tokens").alias("token"), "x.learned")


def block_of(at: Column) -> Column:
    return F.shiftrightunsigned(at, PLACE_BITS)


def place_of(at: Column) -> Column:
    return at.bitwiseAND((1 << PLACE_BITS) - 1).cast("int")


def summed(
    table: DataFrame, values: DataFrame, sums: Callable[[pa.Table, pa.Table], pa.Table], schema: str
) -> DataFrame:
    """Applies ``sums`` to the values and the documents of each block."""
    reachable(table.sparkSession)
    documents = table.where("pairs IS NOT NULL").select("block", "doc_id", "n_bytes", "learn", "pairs")
    return values.groupBy("block").cogroup(documents.groupBy("block")).applyInArrow(sums, schema)
