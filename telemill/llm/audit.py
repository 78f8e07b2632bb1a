"""How filters interact: what each order of them removes, from sorted lists of failing rows."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from telemill.llm.shared import mapped, pick, staged, whole

FILTERS = "ABCDE"
#: Row numbers of a range have these lower bits; it bounds a list.
RANGE_BITS = 16

# White space between words, and what a text of symbols holds.
BLANKS, SYMBOLS = r"[\x20\x09-\x0D]+", r"[#$%&*|]"


def gallop(ids: list[int], target: int, at: int) -> int:
    """The first place from ``at`` on whose id is not below ``target``, by doubling steps and a
    bisection of the last one."""
    low, step = at, 1
    while at < len(ids) and ids[at] < target:
        low, at, step = at + 1, at + step, 2 * step
    return bisect_left(ids, target, low, min(at, len(ids)))


def union(lists: list[list[int]]) -> list[int]:
    """The ids in any of the sorted lists, sorted: the list with the smallest head gives all it
    has below the next head."""
    places, out = [(ids, 0) for ids in lists if ids], []
    while len(places) > 1:
        places.sort(key=lambda place: place[0][place[1]])
        (ids, at), (other, start) = places[:2]
        end = gallop(ids, other[start], at)
        out += ids[at:end]
        end += end < len(ids) and ids[end] == other[start]
        places[0] = (ids, end)
        if end == len(ids):
            places.pop(0)
    for ids, at in places:
        out += ids[at:]
    return out


def difference(ids: list[int], other: list[int]) -> list[int]:
    """The ids of the first sorted list that the second does not have."""
    out, at, place = [], 0, 0
    while at < len(ids):
        place = gallop(other, ids[at], place)
        if place == len(other):
            return out + ids[at:]
        end = gallop(ids, other[place], at)
        out += ids[at:end]
        at = end + (end < len(ids) and ids[end] == other[place])
    return out


def members(sets: int) -> list[int]:
    return [i for i in range(len(FILTERS)) if sets >> i & 1]


def range_counts(n: int, failing: list[list[int]], good: list[int], toxic: list[int]) -> Iterator[tuple[int, ...]]:
    """For each filter after each set of others, in one range of rows: ``filter, before, kept,
    removed, failing, good, toxic``."""
    unions = [union([failing[i] for i in members(before)]) for before in range(1 << len(FILTERS))]
    for before, gone in enumerate(unions):
        for i in range(len(FILTERS)):
            if before >> i & 1:
                continue
            removed = difference(failing[i], gone)
            lost = [len(removed) - len(difference(removed, marked)) for marked in (good, toxic)]
            yield i, before, n - len(unions[before | 1 << i]), len(removed), len(failing[i]), *lost


COUNTS = ["kept", "removed", "failing", "good_lost", "toxic_lost"]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["part", "filter", "before", *COUNTS]
    types = [pa.string(), pa.int32(), pa.int32()] + [pa.int64()] * len(COUNTS)
    for batch in batches:
        for part, n, good, toxic, *failing in zip(*(column.to_pylist() for column in batch.columns)):
            rows = [(part, *counts) for counts in range_counts(n, failing, good, toxic)]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


def failures(text: Column) -> dict[str, Column]:
    """The conditions a text fails by itself; ``text`` is not null."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n = F.size(words)
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": n < 100,
        "B": 100 * F.size(F.array_distinct(words)) < 80 * n,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def posting_lists(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """Per part and range of rows: ``n``, the sorted row numbers with ``good`` and ``toxic``
    labels, and those that fail each filter (``A`` to ``E``).

    E looks at the whole table: a row fails it if a row of a smaller key has the same text. A null
    key is neither smaller nor larger than another. Rows that repeat a key are rows of their own;
    a row is good or toxic if any label of its key says so. A range is a run of rows as they lie
    in a staged copy, so a part of any size is many lists of at most 2^RANGE_BITS rows.
    """
    own = failures(F.col("text"))
    rows = pick(docs, key=F.col(key).cast("long"), part=F.coalesce(F.col(part).cast("string"), F.lit("")), text=whole(text))
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"), "key", "part", F.unhex(F.sha2("text", 256)).alias("digest"), *[x.alias(n) for n, x in own.items()]
    )
    rows = staged(rows, "failing")
    keys = rows.groupBy("digest").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    keys = staged(keys.where("first < last").select("digest", "first"), "first-keys")
    marked = labels.where("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").cast("long").alias("marked_key"))
    marked = staged(marked.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")), "marked")
    copies = rows.join(keys, "digest", "left").withColumn("E", F.coalesce(F.col("key") > F.col("first"), F.lit(False)))
    copies = staged(copies.select("row", "key", "part", *FILTERS), "copies")
    judged = copies.join(marked, copies["key"] == marked["marked_key"], "left")

    def listed(where: Column) -> Column:
        return F.sort_array(F.collect_list(F.when(where, F.col("row"))))

    return judged.groupBy("part", F.shiftright("row", RANGE_BITS).alias("range")).agg(
        F.count("*").alias("n"),
        listed(F.col("good")).alias("good"),
        listed(F.col("toxic")).alias("toxic"),
        *[listed(F.col(name)).alias(name) for name in FILTERS],
    )


def orders(docs: DataFrame) -> DataFrame:
    """Every order of the filters, a row per step: the filter and those before it, as bits. Of a
    fixed size."""
    rows = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[i] for i in order)
        for step, i in enumerate(order, 1):
            rows.append((name, step, i, sum(1 << x for x in order[: step - 1])))
    return docs.sparkSession.createDataFrame(rows, "filter_order string, step int, filter int, before int")


def filter_audit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """What each filter removes at each place of each order: a row per ``part, filter_order, step``.

    Counts of rows within the part: ``kept`` after this step, ``removed`` here, ``redundant`` (fail
    this filter, but were removed before), ``unique_fails`` (fail this one only), ``good_lost`` and
    ``toxic_lost`` (removed here, with such a label), ``shapley`` (removed by this filter, summed
    over all orders). A null text is an empty one, a null part the empty string; see
    ``posting_lists`` for keys. A part with no failing rows has rows of zeros; an empty table gives
    an empty result. Columns that are not named are ignored.

    Each range of rows gives the sizes of the differences of a filter's list and the union of those
    before it, for the 80 pairs there are; only these numbers are summed over ranges.
    """
    lists = posting_lists(docs, labels, key, text, part)
    schema = "part string, filter int, before int, " + ", ".join(f"{name} long" for name in COUNTS)
    counted = mapped(lists.select("part", "n", "good", "toxic", *FILTERS), _counted, schema)
    sums = staged(counted.groupBy("part", "filter", "before").agg(*[F.sum(name).alias(name) for name in COUNTS]), "sums")
    n = len(FILTERS)
    times = [factorial(k) * factorial(n - 1 - k) for k in range(n)]
    ways = F.element_at(F.array(*map(F.lit, times)), F.bit_count("before") + 1)
    whole_parts = sums.groupBy("part", "filter").agg(
        F.sum(F.when(F.bit_count("before") == n - 1, F.col("removed"))).alias("unique_fails"),
        F.sum(F.col("removed") * ways).alias("shapley"),
    )
    # 80 rows a part on one side, 600 rows in all on the other.
    placed = sums.join(whole_parts, ["part", "filter"]).join(F.broadcast(orders(docs)), ["filter", "before"])
    redundant = (F.col("failing") - F.col("removed")).alias("redundant")
    return placed.select(
        "part", "filter_order", "step", "kept", "removed", redundant, "unique_fails", "good_lost", "toxic_lost", "shapley"
    )
