"""Documents as token pieces, packed best fit decreasing into sequences of one length."""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import mapped, pick, reachable, staged, whole

#: Words and runs of words whose ids a worker remembers, at most.
REMEMBERED = 1_000_000
#: Pieces that are packed together, about: enough that the last open windows do not count.
PIECES_A_GROUP = 2048


class OpenWindows:
    """Windows that still have room, found by the tightest fit.

    A segment tree over the remaining capacity counts the open windows; the smallest capacity
    that holds a piece is found by going up from its leaf and down to the left.
    """

    def __init__(self, window: int) -> None:
        self._leaves = 1 << window.bit_length()
        self._open = [0] * (2 * self._leaves)
        self._ids: list[list[int]] = [[] for _ in range(window + 1)]

    def _count(self, capacity: int, change: int) -> None:
        node = capacity + self._leaves
        while node:
            self._open[node] += change
            node >>= 1

    def add(self, capacity: int, window_id: int) -> None:
        self._ids[capacity].append(window_id)
        self._count(capacity, 1)

    def take(self, length: int) -> tuple[int, int] | None:
        """The capacity and id of the tightest window that holds the length; it is closed."""
        node = length + self._leaves
        while not self._open[node]:
            while node & 1:
                node >>= 1
            if not node:
                return None
            node += 1
        while node < self._leaves:
            node = 2 * node + (not self._open[2 * node])
        capacity = node - self._leaves
        self._count(capacity, -1)
        return capacity, self._ids[capacity].pop()


def best_fit(lengths: list[int], window: int) -> tuple[list[int], list[int]]:
    """For lengths in descending order: the window each goes to, and its offset there."""
    windows, offsets, opened = [], [], 0
    room = OpenWindows(window)
    for length in lengths:
        found = room.take(length)
        if found is None:
            capacity, window_id, opened = window, opened, opened + 1
        else:
            capacity, window_id = found
        windows.append(window_id)
        offsets.append(window - capacity)
        if capacity > length:
            room.add(capacity - length, window_id)
    return windows, offsets


def pack(pieces: DataFrame, window: int = 2048) -> DataFrame:
    """``pieces`` (with ``doc_id``, ``start``, ``length`` of 1 to ``window``) with
    ``sequence_id`` and ``offset`` added, the place of each piece.

    Pieces are dealt at random into groups of about PIECES_A_GROUP, each packed by itself best
    fit decreasing, so the padding hardly depends on the number of groups. They are dealt by what
    they hold and where they lie, so rows of one key and text are spread as well. ``pieces`` are
    rows of a stored table, which lie in the same place whenever they are read. An empty table
    gives an empty result.
    """
    reachable(pieces.sparkSession)
    n_groups = max(1, pieces.count() // PIECES_A_GROUP)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def packed(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group.pop("tm_group").iloc[0])
        group = group.sort_values(["length", "doc_id", "start"], ascending=[False, True, True])
        windows, offsets = best_fit(group["length"].tolist(), window)
        return group.assign(sequence_id=[(number << 24) + w for w in windows], offset=offsets)

    return (
        pieces.withColumn("tm_group", F.pmod(F.xxhash64("doc_id", "start", F.monotonically_increasing_id()), F.lit(n_groups)))
        .groupBy("tm_group")
        .applyInPandas(packed, f"{fields}, sequence_id long, offset long")
    )


def sequences(packed: DataFrame, window: int = 2048, padding: int = 0) -> DataFrame:
    """The packed pieces (with ``ids``) as rows ``sequence_id, ids`` of ``window`` ids each, in
    the order of their offsets and padded at the end."""
    pieces = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("pieces"))
    ids = F.flatten(F.transform("pieces", lambda piece: piece["ids"]))
    return pieces.select("sequence_id", F.slice(F.concat(ids, F.array_repeat(F.lit(padding), window)), 1, window).alias("ids"))


@cache
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


#: Texts of spaces, line feeds, ASCII and Latin-1 letters and signs, without an apostrophe and what
#: special tokens begin with: such a tokenizer lowers them letter by letter and cuts their words
#: into runs of letters, single digits, and runs of the rest.
PLAIN = re.compile(r"[ \n!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*").fullmatch
RUNS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff \n]+").findall


def pieces_of(text: str) -> list[str]:
    """What a text is looked up by: the runs of a plain one, the words of any other."""
    if "<|" not in text and PLAIN(text):
        return RUNS(text.lower())
    return text.replace("\n", " ").split(" ")


class PieceIds(dict):
    """The ids of words and runs as bytes, four little-endian ones each; forgets all when full."""

    def __init__(self, path: str) -> None:
        super().__init__()
        self._tokenizer = _tokenizer(path)

    def learn(self, pieces: set[str]) -> None:
        if len(self) > REMEMBERED:
            self.clear()
        unknown = [piece for piece in pieces if piece not in self]
        found = self._tokenizer.encode_batch_fast(unknown, add_special_tokens=False)
        self.update((piece, array("I", x.ids).tobytes()) for piece, x in zip(unknown, found))


@cache
def _known(path: str) -> PieceIds:
    """What this worker has learned, kept from task to task."""
    return PieceIds(path)


#: Characters of texts whose words are learned together.
CHARACTERS_A_TURN = 1 << 22


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    window: int = 2048,
    key: str = "doc_id",
    text: str = "text",
    keep_ids: bool = False,
) -> DataFrame:
    """Every text as ids of a tokenizer that drops white space, then ``end_id``, cut into full
    windows and a rest.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens``, with ``keep_ids`` also ``ids``. A
    null text is an empty one, which has the end id only. Such a tokenizer gives the words
    between spaces and line feeds the same ids alone as in their text, and the runs of plain ones
    too, so each worker asks it once for each and remembers the answer, up to a bound.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = _known(tokenizer), array("I", [end_id]).tobytes()
        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1)
            at = 0
            while at < len(keys):
                turn, size = [], 0
                while at + len(turn) < len(keys) and (not turn or size < CHARACTERS_A_TURN):
                    text = texts[at + len(turn)].as_py()
                    turn.append(pieces_of(text))
                    size += len(text)
                known.learn(set().union(*turn))
                rows = []
                for doc_id, pieces in zip(keys[at:], turn):
                    ids = memoryview(b"".join(map(known.__getitem__, pieces)) + end)
                    n = len(ids) // 4
                    for start in range(0, n, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        rows.append((doc_id, start, len(piece) // 4, crc32(piece), n) + ((list(piece.cast("I")),) if keep_ids else ()))
                at += len(turn)
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + ["ids"] * keep_ids
    types = [pa.int64()] * 5 + [pa.list_(pa.int64())] * keep_ids
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<long>" * keep_ids
    return mapped(pick(docs, doc_id=F.col(key).cast("long"), text=whole(text)), work, schema)


def packed_documents(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048) -> DataFrame:
    """The token pieces of all documents with their places; see ``token_pieces`` and ``pack``."""
    return pack(staged(token_pieces(docs, tokenizer, end_id, window), "pieces"), window)
