"""Shards of nearly equal size: even runs of whole groups under the smallest capacity."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from telemill.llm.shared import pick, staged, whole

OVERHEAD = 16
#: Groups are ordered by a hash of their text and gathered into so many ordered cells.
CELL_BITS = 16
#: Rows of a shard that are numbered together, about.
ROWS_A_CHUNK = 1000


def greedy_cuts(prefix: Sequence[int], held: Sequence[int], capacity: int) -> list[int] | None:
    """Where shards end if each takes what fits its capacity beside what it holds: positions in
    the sizes, one per shard. None if something is left over. ``prefix[i]`` is the sum of the
    first i sizes."""
    ends, at = [], 0
    for own in held:
        at = bisect_right(prefix, prefix[at] + capacity - own) - 1
        ends.append(at)
    return ends if at == len(prefix) - 1 else None


def even_cuts(prefix: Sequence[int], held: Sequence[int], capacity: int) -> list[int]:
    """Where shards end if each comes as near as it can to an even share of what is left. None is
    above the capacity, which must suffice, and none that holds nothing (these come first) stays
    empty while there are sizes for all."""
    n, latest = len(prefix) - 1, [len(prefix) - 1]
    # From latest[k] on, and not from before, the last k shards hold all that is left.
    for own in reversed(held):
        latest.append(bisect_left(prefix, prefix[latest[-1]] - capacity + own))
    ends, at, bare, rest = [], 0, sum(own == 0 for own in held), sum(held)
    for left, own in zip(range(len(held), 0, -1), held):
        low, high = max(at, latest[left - 1]), bisect_right(prefix, prefix[at] + capacity - own) - 1
        if own == 0:
            if n - at >= bare:
                low, high = max(low, at + 1), min(high, n - bare + 1)
            bare -= 1
        goal = prefix[at] + (prefix[-1] - prefix[at] + rest) / left - own
        end = bisect_left(prefix, goal)
        if end > n or end > at and goal - prefix[end - 1] < prefix[end] - goal:
            end -= 1
        at, rest = min(max(end, low), high), rest - own
        ends.append(at)
    return ends


def apart(sizes: Sequence[int], shards: int) -> tuple[list[int], list[int]]:
    """Positions of sizes that begin a shard each: those above an even share of what the larger
    ones leave, which have theirs alone, and those above half a share. Largest first."""
    order = sorted(range(len(sizes)), key=lambda i: -sizes[i])
    left, n = sum(sizes), 0
    while n < len(order) and sizes[order[n]] * (shards - n) > left:
        left -= sizes[order[n]]
        n += 1
    half = [i for i in order[n:shards] if sizes[i] * 2 * (shards - n) > left]
    return order[:n], half


def minimax_cuts(
    sizes: Sequence[int], shards: int, begun: Sequence[int] = ()
) -> tuple[int, list[int]]:
    """The smallest capacity under which the ordered sizes fit the shards, the last of which hold
    what is begun already, and even cuts under it."""
    prefix = [0]
    for size in sizes:
        prefix.append(prefix[-1] + size)
    held = [0] * (shards - len(begun)) + list(begun)
    low = max([0, *sizes, *begun, -(-(prefix[-1] + sum(begun)) // shards)])
    high = max(low, prefix[-1] + max(held))
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(prefix, held, middle) is None:
            low = middle + 1
        else:
            high = middle
    return low, even_cuts(prefix, held, low)


def shards(
    docs: DataFrame, n_shards: int = 40, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Every row with its shard and its place there; law ``bytes``: sizes nearly equal.

    Columns: the key, ``size`` (UTF-8 bytes of the text plus 16), ``text_crc32``, ``law``,
    ``shard``, ``slot`` (0 up, without gaps, in each shard), ``grown_shard`` (null: this law does
    not promise to move little when a shard is added). Equal texts are one group and stay
    together, whatever their number; a null text has no bytes and goes with the empty texts.
    Rows that repeat a key get a slot each. An empty table gives an empty result.

    Groups are ordered by a hash of the text. The driver sees the sizes of 2**CELL_BITS ordered
    cells of whole groups, at any size of the input. Cells above an even share get a shard each;
    so do those above half a share, which is filled up. For the other cells, in order, the smallest
    capacity is searched by bisection and they are cut evenly under it, so a shard is empty only
    where there are fewer cells with rows than shards. These cells are to a shard as ``n_shards``
    to 65,536. Rows get their shard by comparing their cell with the cuts, and are numbered in
    chunks of a shard, so a group of any size is numbered by many tasks.
    """
    rows = pick(
        docs,
        doc_id=F.col(key),
        size=F.octet_length(whole(text)).cast("long") + OVERHEAD,
        text_crc32=F.crc32(whole(text)),
        cell=F.shiftrightunsigned(F.xxhash64(whole(text)), 64 - CELL_BITS),
        spread=F.xxhash64(F.col(key), F.rand(seed=7)),
    )
    rows = staged(rows, "sizes")
    cells = rows.groupBy("cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    found = cells.toPandas()  # at most 2**CELL_BITS rows
    found = sorted(zip(*(found[name].tolist() for name in ("cell", "bytes", "n"))))
    alone, begin = apart([size for _, size, _ in found], n_shards)
    own = [found[i] for i in begin + alone]
    cut, taken = n_shards - len(alone), {x[0] for x in own}
    others = [x for x in found if x[0] not in taken]
    _, ends = minimax_cuts([size for _, size, _ in others], cut, [found[i][1] for i in begin])
    held = [sum(n for _, _, n in others[a:b]) for a, b in zip([0, *ends], ends)] + [0] * len(alone)
    for i, (_, _, n) in enumerate(own, n_shards - len(own)):
        held[i] += n
    chunks = [max(1, -(-n // ROWS_A_CHUNK)) for n in held]
    # Each shard ends before the cell at its cut, so a cell's shard is the number of cuts up to it.
    bounds = [x[0] for x in others] + [1 << CELL_BITS]
    shard = F.size(F.filter(F.array(*(F.lit(bounds[end]) for end in ends)), lambda end: end <= F.col("cell")))
    place = F.array_position(F.array(*(F.lit(x[0]).cast("long") for x in own), F.lit(-1).cast("long")), F.col("cell"))
    shard = F.when(place > 0, place + (n_shards - len(own) - 1)).otherwise(shard).cast("int")
    rows = rows.withColumn("shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        F.pmod("spread", F.array(*map(F.lit, chunks))[F.col("shard")]).alias("chunk"),
    )
    # One row per shard and chunk: small beside the rows, each chunk standing for thousands.
    before = W.partitionBy("shard").orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "chunk").agg(F.count("*").alias("n")).select(
        "shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    inside = F.row_number().over(W.partitionBy("shard", "chunk").orderBy("doc_id", "text_crc32")) - 1
    numbered = rows.withColumn("inside", inside)
    return numbered.join(staged(starts, "starts"), ["shard", "chunk"]).select(
        F.col("doc_id").alias(key),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("start") + F.col("inside")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
