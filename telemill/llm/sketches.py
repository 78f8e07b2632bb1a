"""Fingerprints of documents that can be subtracted: invertible Bloom lookup sketches."""

from __future__ import annotations

import base64
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from telemill.llm.shared import mapped, pick, whole

#: Cells of a fingerprint, in three parts of equal size; each digest goes to one cell of each.
CELLS = 24
PARTS = 3
#: A sketch that cannot be peeled is made again with so many times the cells.
GROWTH = 4
#: A sketch that seems to hold so many digests a cell is not peeled first; one of about 0.8 fails.
HOPELESS = 1.2
#: Cells a digest that the next size has at least.
ROOM = 1.5
#: Buckets of neighbouring documents for each shuffle partition at least, bytes of a bucket about,
#: and characters of a text that order rows of one key among buckets.
BUCKETS, BUCKET_BYTES, PREFIX = 4, 1 << 26, 64

#: Characters of a paragraph that is not cut, and those of the parts of longer ones, which are cut
#: after a character in 32.
LONG, SHORTEST, LONGEST = 64, 16, 128
PLACE_BELOW = np.uint32(1 << 27)
_NEAR = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)

#: Bits of a mixed digest for the place in each part.
PLACE_BITS, PLACE_MASK = 21, np.uint64((1 << 21) - 1)

_FIRST = np.uint64(0xBF58476D1CE4E5B9)
_SECOND = np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = x ^ np.uint64((salt * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= _FIRST
    x ^= x >> np.uint64(27)
    x *= _SECOND
    x ^= x >> np.uint64(31)
    return x


def _places(text: str) -> np.ndarray:
    """A 32-bit number for each character but the first three, of it and the three before."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    mixed = codes[3:] * _NEAR[0] + codes[2:-1] * _NEAR[1] + codes[1:-2] * _NEAR[2] + codes[:-3] * _NEAR[3]
    mixed ^= mixed >> np.uint32(15)
    return mixed * _NEAR[0]


def paragraphs(text: str, start: int = 0) -> list[str]:
    """The lines of a text, those of several sentences cut after each; blank ones count nothing.

    What is longer than ``LONG`` is cut further, where its own characters say so: at least
    ``SHORTEST`` characters on, after the first whose number (of it and the three before) is small,
    or after the last of the smallest number within ``LONGEST``. The cuts after an edit soon are
    those before it, in any script and also where a text repeats itself. With ``start``, which a
    part of the text begins at, only the parts from there on.
    """
    return [x for x, _ in _parts(text, start) if x.strip()]


def _parts(text: str, start: int = 0) -> list[tuple[str, int]]:
    """The parts of a text from ``start`` on, blank ones too, and where each begins."""
    # As long as the text, so places are the same.
    lines = text[start:].replace(". ", ".\n").split("\n")
    found, i, at = [], 0, start
    if max(map(len, lines)) <= LONG:
        for line in lines:
            found.append((line, at))
            at += len(line) + 1
        return found
    seen = max(0, start - 3)
    places = np.concatenate([np.zeros(seen, np.uint32), _places(text[seen:])])
    cuts = (np.flatnonzero(places[seen:] < PLACE_BELOW) + seen + 4).tolist()
    cuts.append(len(text) + LONGEST)
    for line in lines:
        end = at + len(line)
        while end - at > LONG:
            least = at + SHORTEST
            while cuts[i] < least:
                i += 1
            cut = cuts[i]
            if cut > at + LONGEST:
                if end - at <= LONGEST:
                    break
                window = places[least - 4 : at + LONGEST - 3]
                cut = at + LONGEST - int(window[::-1].argmin())
            if cut >= end:
                break
            found.append((text[at:cut], at))
            at = cut
        found.append((text[at:end], at))
        at = end + 1
    return found


def digests(text: str) -> np.ndarray:
    """A 64-bit digest per paragraph or part of a long one; the n-th repetition of one has a digest of its own."""
    return _digests(paragraphs(text), {})


def _digests(parts: list[str], seen: dict[str, int]) -> np.ndarray:
    """Digests of parts that follow those counted in ``seen``."""
    found = []
    for part in parts:
        turn = seen.get(part, 0)
        seen[part] = turn + 1
        found.append(xxhash.xxh3_64_intdigest(part, turn))
    return np.array(found, np.uint64)


@dataclass
class Sketch:
    """Per cell: how many digests it holds, their exclusive or, and that of their check sums."""

    counts: np.ndarray
    keys: np.ndarray
    checks: np.ndarray

    @classmethod
    def of(cls, found: np.ndarray, cells: int = CELLS, checks: np.ndarray | None = None) -> Sketch:
        made = cls(np.zeros(cells, np.int32), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64))
        if len(found):
            made._change(found, np.ones(len(found), np.int32), _mixed(found, 1) if checks is None else checks)
        return made

    def _change(self, found: np.ndarray, by: np.ndarray, checks: np.ndarray) -> None:
        part = len(self.counts) // PARTS
        mixed = _mixed(found, len(self.counts))
        places = []
        for i in range(PARTS):
            # A part too large for its bits is filled from a number of its own.
            wide = _mixed(mixed, i + 2) if part > PLACE_MASK else mixed >> np.uint64(i * PLACE_BITS) & PLACE_MASK
            places.append((wide % np.uint64(part)).astype(np.int64) + i * part)
        places = np.concatenate(places)
        np.add.at(self.counts, places, np.concatenate([by] * PARTS))
        np.bitwise_xor.at(self.keys, places, np.concatenate([found] * PARTS))
        np.bitwise_xor.at(self.checks, places, np.concatenate([checks] * PARTS))

    def copy(self) -> Sketch:
        return Sketch(self.counts.copy(), self.keys.copy(), self.checks.copy())

    def minus(self, other: Sketch) -> Sketch:
        return Sketch(self.counts - other.counts, self.keys ^ other.keys, self.checks ^ other.checks)

    def held(self) -> float:
        """For a difference: about how many digests it holds, from how its counts scatter."""
        counts = self.counts.reshape(PARTS, -1).astype(np.float64)
        n = counts.shape[1]
        return float(counts.var(axis=1).mean() * n * n / max(1, n - 1))

    def peeled(self) -> tuple[np.ndarray, np.ndarray] | None:
        """For a difference: the digests of the left only and of the right only. None if the
        sketch is too small for them. The cells are used up."""
        sides = []
        while True:
            pure = np.flatnonzero((np.abs(self.counts) == 1) & (self.checks == _mixed(self.keys, 1)))
            if not len(pure):
                break
            found, first = np.unique(self.keys[pure], return_index=True)
            signs = self.counts[pure[first]]
            self._change(found, -signs, self.checks[pure[first]])
            sides.append((found, signs))
        if self.counts.any() or self.keys.any():
            return None
        found = np.concatenate([np.zeros(0, np.uint64), *(x for x, _ in sides)])
        signs = np.concatenate([np.zeros(0, np.int32), *(x for _, x in sides)])
        return found[signs > 0], found[signs < 0]

    def text(self) -> str:
        packed = self.counts.astype("<i4").tobytes() + self.keys.astype("<u8").tobytes()
        return base64.b64encode(packed + self.checks.astype("<u4").tobytes()).decode()


class Version:
    """The digests of a text, and its sketches once made."""

    def __init__(self, found: np.ndarray) -> None:
        self.digests = found
        self._checks = _mixed(found, 1)
        self._sketches: dict[int, Sketch] = {}

    def sketch(self, cells: int = CELLS) -> Sketch:
        if cells not in self._sketches:
            self._sketches[cells] = self._made(cells)
        return self._sketches[cells]

    def _made(self, cells: int) -> Sketch:
        return Sketch.of(self.digests, cells, self._checks)


class Text(Version):
    """A whole text: its parts, so that a version with another end needs only that one's."""

    def __init__(self, text: str) -> None:
        self.text = text
        parts = [(x, at) for x, at in _parts(text) if x.strip()]
        self._texts, self._starts = [x for x, _ in parts], [at for _, at in parts]
        super().__init__(_digests(self._texts, {}))

    def ending_in(self, kept: int, end: str) -> Changed:
        """The version that keeps the first characters and then has another end. Cuts look no
        further ahead than the longest part, so the parts that begin so far before the end of what
        is kept are the same; from the last of these on they are cut anew."""
        edited = self.text[:kept] + end
        same = max(0, bisect_right(self._starts, kept - LONGEST - 4) - 1)
        head = self._texts[:same]
        tail = _digests(paragraphs(edited, self._starts[same] if head else 0), dict(Counter(head)))
        return Changed(edited, self, same, tail)


class Changed(Version):
    """A version of a text, whose sketches are those of the text with its end taken out and another
    one put in."""

    def __init__(self, text: str, before: Text, same: int, tail: np.ndarray) -> None:
        self.text = text
        super().__init__(np.concatenate([before.digests[:same], tail]))
        self._before, self._same = before, same

    def _made(self, cells: int) -> Sketch:
        made, same = self._before.sketch(cells).copy(), self._same
        gone, new = self._before.digests[same:], self.digests[same:]
        if len(gone) + len(new):
            by = np.concatenate([np.full(len(gone), -1, np.int32), np.ones(len(new), np.int32)])
            made._change(np.concatenate([gone, new]), by, np.concatenate([self._before._checks[same:], self._checks[same:]]))
        return made


def difference(left: Version, right: Version, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """The digests that one side has and the other has not, by subtracting and peeling sketches,
    larger ones until it succeeds."""
    while True:
        apart = left.sketch(cells).minus(right.sketch(cells))
        held = apart.held()  # any size that can be peeled gives the same digests
        found = apart.peeled() if held < HOPELESS * cells else None
        if found is not None:
            return found
        cells *= GROWTH
        while cells < ROOM * held:
            cells *= GROWTH


def likeness(left: Version, right: Version) -> float:
    """Shared paragraphs (parts of long ones) by all of two versions; 1 for two without any."""
    both = len(left.digests) + len(right.digests)
    apart = sum(map(len, difference(left, right)))
    return (both - apart) / (both + apart) if both else 1.0


ROW = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()),
        ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ]
)
ROWS_OUT = 1024


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` of every text; equal texts have equal fingerprints. A null text is
    an empty one, whose cells are all zero."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [Sketch.of(digests(x.as_py())).text() for x in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(found, pa.string())], names=["doc_id", "fingerprint"])

    return mapped(pick(docs, doc_id=F.col(key).cast("long"), text=whole(text)), work, "doc_id long, fingerprint string")


def _versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket, guests last; each but the guests is compared with the next one."""
    rows, before = [], None
    for batch in batches:
        for bucket, guest, doc_id, text in zip(*(batch.column(name) for name in ("bucket", "guest", "doc_id", "text"))):
            bucket, text = bucket.as_py(), text.as_py()
            found = Text(text)
            if before is not None and before[0] == bucket:
                rows.append(_row(*before[1:], found))
                if len(rows) == ROWS_OUT:
                    yield pa.RecordBatch.from_pylist(rows, ROW)
                    rows = []
            before = None if guest.as_py() else (bucket, doc_id.as_py(), found)
    yield pa.RecordBatch.from_pylist(rows, ROW)


def _row(doc_id: int | None, found: Text, after: Text) -> dict:
    n = len(found.text)
    edited = found.ending_in(n - n // 4, after.text[: n // 4])
    return {
        "doc_id": doc_id,
        "n_chars": n,
        "edited": edited.text,
        "fingerprint": found.sketch().text(),
        "edited_fingerprint": edited.sketch().text(),
        "near_edited": likeness(found, edited),
        "near_next": likeness(found, after),
    }


def edited_versions(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Every document's fingerprint beside that of an edited version and of the next document.

    Columns: ``doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited,
    near_next``. The edited text has its last quarter replaced by the beginning of the next
    document's, by ascending key; after the last comes the first, and a single document follows
    itself. A null text is an empty one, a null key the smallest, and rows that repeat a key
    follow one another by their texts.

    Keys, and the first characters of texts, which split a key of very many rows, are sampled into
    ordered buckets by the bytes there are; the text moves once, to its bucket. The first document
    of each bucket also goes to the bucket before as a guest, so that the last one there has its
    neighbour. An empty table gives an empty result; other columns are ignored.
    """
    smallest = -(1 << 63)
    rows = pick(
        docs, doc_id=F.col(key).cast("long"), place=F.coalesce(F.col(key).cast("long"), F.lit(smallest)), text=whole(text)
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(BUCKETS * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // BUCKET_BYTES))
    order = rows.select("place", F.substring("text", 1, PREFIX).alias("prefix"))
    ranges = order.repartitionByRange(n, "place", "prefix").select(F.struct("place", "prefix").alias("at"), F.spark_partition_id().alias("part"))
    # One key and prefix per bucket reach the driver.
    heads = sorted(tuple(row.least) for row in ranges.groupBy("part").agg(F.min("at").alias("least")).collect())

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            at = list(zip(batch.column("place").to_pylist(), [text[:PREFIX] for text in batch.column("text").to_pylist()]))
            bucket = np.array([bisect_right(heads, x) - 1 for x in at], np.int64)
            yield with_bucket(batch, bucket, False)
            first = np.array([i for i, x in enumerate(at) if heads[bucket[i]] == x], np.int64)
            if len(first):
                yield with_bucket(batch.take(pa.array(first)), (bucket[first] - 1) % len(heads), True)

    def with_bucket(batch: pa.RecordBatch, bucket: np.ndarray, guest: bool) -> pa.RecordBatch:
        columns = [pa.array(bucket, pa.int64()), pa.array([guest] * len(bucket), pa.bool_()), *batch.columns]
        return pa.record_batch(columns, names=["bucket", "guest", *batch.schema.names])

    dealt_rows = mapped(rows, dealt, "bucket long, guest boolean, doc_id long, place long, text string")
    ordered = dealt_rows.repartition(n, "bucket").sortWithinPartitions("bucket", "guest", "place", "text")
    schema = (
        "doc_id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return mapped(ordered, _versions, schema)
