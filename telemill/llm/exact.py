"""Exact duplicates through a cuckoo filter of live digests."""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import mapped, pick, staged, whole

SLOTS = 4
KICKS = 500


class CuckooIndex:
    """A set of live digests with a value each, which can be inserted, found and deleted.

    The filter holds a 16-bit tag per slot, four slots a bucket, and each digest may lie in two
    buckets. A tag that matches is only a hint: the digest stored in the same slot decides. Where
    no place is found after KICKS moves, the number of buckets is doubled and the filter is built
    again from the stored digests, so nothing is ever dropped.
    """

    def __init__(self, buckets: int = 1024) -> None:
        self._allocate(buckets)

    def _allocate(self, buckets: int) -> None:
        self._mask = buckets - 1
        self._tags = array("H", bytes(2 * SLOTS * buckets))
        self._content: list[tuple[bytes, object] | None] = [None] * (SLOTS * buckets)
        self._size = 0

    def __len__(self) -> int:
        return self._size

    @property
    def buckets(self) -> int:
        return self._mask + 1

    def _places(self, digest: bytes) -> tuple[int, int, int]:
        tag = int.from_bytes(digest[:2], "little") or 1
        first = int.from_bytes(digest[2:10], "little") & self._mask
        return tag, first, self._other(first, tag)

    def _other(self, bucket: int, tag: int) -> int:
        """The second bucket of a tag; from the second it gives the first."""
        return (bucket ^ (tag * 0x9E3779B1)) & self._mask

    def _slot(self, digest: bytes) -> int:
        tag, first, second = self._places(digest)
        for bucket in (first, second):
            for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
                if self._tags[slot] == tag and self._content[slot][0] == digest:
                    return slot
        return -1

    def get(self, digest: bytes) -> object | None:
        slot = self._slot(digest)
        return None if slot < 0 else self._content[slot][1]

    def delete(self, digest: bytes) -> object | None:
        """Takes the digest out and returns its value; None if it is not live."""
        slot = self._slot(digest)
        if slot < 0:
            return None
        value = self._content[slot][1]
        self._tags[slot], self._content[slot] = 0, None
        self._size -= 1
        return value

    def insert(self, digest: bytes, value: object) -> None:
        """Adds a digest that is not live."""
        tag, bucket, second = self._places(digest)
        held = (digest, value)
        if self._put(bucket, tag, held) or self._put(second, tag, held):
            return
        for kick in range(KICKS):
            slot = bucket * SLOTS + kick % SLOTS
            tag, self._tags[slot] = self._tags[slot], tag
            held, self._content[slot] = self._content[slot], held
            bucket = self._other(bucket, tag)
            if self._put(bucket, tag, held):
                return
        live = [*self.items(), held]
        self._allocate(2 * self.buckets)
        for known, content in live:
            self.insert(known, content)

    def _put(self, bucket: int, tag: int, held: tuple[bytes, object]) -> bool:
        for slot in range(bucket * SLOTS, bucket * SLOTS + SLOTS):
            if not self._tags[slot]:
                self._tags[slot], self._content[slot] = tag, held
                self._size += 1
                return True
        return False

    def items(self) -> Iterator[tuple[bytes, object]]:
        return (held for held in self._content if held is not None)


OUT = pa.schema([("digest", pa.binary()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
ROWS_OUT = 65536


def _live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per digest of a partition: the largest id and the number of rows."""
    index = CuckooIndex()
    for batch in batches:
        for digest, doc_id, size in zip(*(batch.column(i).to_pylist() for i in range(3))):
            live = index.get(digest)
            if live is None:
                index.insert(digest, [doc_id, size])
            elif live[0] is None or (doc_id is not None and doc_id > live[0]):
                # The row that was live makes way for this one.
                index.delete(digest)
                index.insert(digest, [doc_id, live[1] + size])
            else:
                live[1] += size
    rows = []
    for digest, (doc_id, size) in index.items():
        rows.append((digest, doc_id, size))
        if len(rows) == ROWS_OUT:
            yield _batch(rows)
            rows = []
    yield _batch(rows)


def _batch(rows: list[tuple[bytes, int | None, int]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((), (), ())
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, OUT)], schema=OUT)


def exact_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Which row of each group of equal texts stays.

    Columns: the key, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``; one row per row of
    ``docs``. Texts are equal when identical; a null text is an empty one. Of equal texts, the
    row with the largest key stays; a null key is smaller than any other. Of rows that repeat
    key and text, one stays. Other columns are ignored, and an empty table gives an empty result.

    Each task keeps an index of the digests it has seen, so a group of copies, however large,
    leaves the task as one row; a second index by digest merges these. Memory is that of the
    distinct digests of a partition.
    """
    rows = pick(docs, doc_id=F.col(key).cast("long"), digest=F.unhex(F.sha2(whole(text), 256)))
    rows = staged(rows, "digests")
    schema = "digest binary, keep_id long, group_size long"
    singles = rows.select("digest", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"))
    live = staged(mapped(mapped(singles, _live, schema).repartition("digest"), _live, schema), "live")
    # Rows that repeat key and text are counted before the join and dealt out after it.
    repeated = rows.groupBy("doc_id", "digest").agg(F.count("*").cast("int").alias("times"))
    joined = staged(repeated, "repeated").join(live, "digest")
    return joined.withColumn("turn", F.explode(F.sequence(F.lit(1), "times"))).select(
        F.col("doc_id").alias(key),
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("turn") == 1)).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
