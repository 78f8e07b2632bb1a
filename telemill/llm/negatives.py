"""Hard negatives: the vectors of other labels that score next below an anchor's positives, found
through cover trees over vectors made equal in norm."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from telemill.llm.shared import mapped, reachable, staged

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score is from LEAST to MOST hundredths of its positive's.
LEAST, MOST = 80, 100
#: Vectors of a tree, about; radii shrink by BASE from level to level; a leaf has LEAF vectors at most.
ROWS_A_TREE, BASE, LEAF = 2048, 1.3, 128
#: Anchors, about, that are sent to all tasks at a time, and those that follow a tree together.
ANCHORS_A_PASS, TOGETHER = 8192, 256
#: Scores must fit 64 bits; vectors of a larger squared norm take no part.
SQUARED_NORM = 2.0**62
#: Stands for a null id, which comes before all others.
NO_ID = np.iinfo(np.int64).min
LOWEST = np.iinfo(np.int64).min


@dataclass
class Tree:
    """Vectors in an order in which the own vectors of a node follow each other, and its nodes.

    A node has own vectors ``[first, last)`` and the child nodes ``[first_child, last_child)``; all
    below it are within ``radius`` of its ``center`` after both are made equal in norm, which
    bounds their inner products with a query (whose added component is 0) by the center's, more
    or less the query's norm times the radius. ``low`` and ``high`` bound the labels below.
    """

    ids: np.ndarray
    rows: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    #: center, radius, first, last, first_child, last_child, low, high
    nodes: np.ndarray

    @classmethod
    def build(cls, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> Tree:
        """Level by level: the vectors of a node that lie within the next smaller radius of one of
        them, the node's center first, go to a child; fewer than LEAF of them are the node's own, as
        to look at them costs less than a bound for them saves."""
        plain = vectors.astype(np.float64)
        squared = (plain**2).sum(axis=1)
        added = np.sqrt(np.maximum(squared.max() - squared, 0))
        distances = 2 * (squared.max() - plain @ plain.T - np.outer(added, added))
        distances = np.sqrt(np.maximum(distances, 0))
        # What doubles may have lost; radii are larger by it, and shorter ones are none.
        lost = 1e-6 * (1 + np.sqrt(squared.max()))
        order: list[np.ndarray] = []
        nodes: list[list[float]] = []
        waiting, placed = [np.arange(len(ids))], 0
        while len(nodes) < len(waiting):
            here = waiting[len(nodes)]
            reach = distances[here[0], here].max()
            own, first_child = [], len(waiting)
            if len(here) <= LEAF or reach <= lost:
                own.append(here)
            else:
                rest = here
                while len(rest):
                    near = distances[rest[0], rest] <= reach / BASE
                    (own if near.sum() < LEAF else waiting).append(rest[near])
                    rest = rest[~near]
            own_rows = np.concatenate([np.zeros(0, np.int64), *own])
            order.append(own_rows)
            nodes.append([here[0], reach + lost, placed, placed + len(own_rows), first_child, len(waiting), labels[here].min(), labels[here].max()])
            placed += len(own_rows)
        sequence = np.concatenate(order)
        table = np.array(nodes, np.float64)
        table[:, 0] = np.argsort(sequence)[table[:, 0].astype(np.int64)]
        return cls(ids[sequence], rows[sequence], labels[sequence], vectors[sequence], table)


class Best:
    """The best scores of each list so far, ties by the smaller id."""

    def __init__(self, lists: int, size: int) -> None:
        self.size = size
        self.scores = np.full((lists, size), LOWEST, np.int64)
        self.ids = np.zeros((lists, size), np.int64)
        self.found = np.zeros((lists, size), bool)
        #: What a list still needs; LOWEST while it is not full.
        self.least = np.full(lists, LOWEST, np.int64)

    def add(self, lists: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(lists)
        held = self.found[touched]
        lists = np.concatenate([np.repeat(touched, held.sum(axis=1)), lists])
        scores = np.concatenate([self.scores[touched][held], scores])
        ids = np.concatenate([self.ids[touched][held], ids])
        order = np.lexsort((ids, -scores.astype(np.float64), lists))
        # Doubles may round scores of more than 52 bits; then whole numbers decide.
        if len(scores) and np.abs(scores).max() >= 2**52:
            order = np.array(sorted(range(len(lists)), key=lambda i: (lists[i], -int(scores[i]), ids[i])))
        lists, scores, ids = lists[order], scores[order], ids[order]
        starts = np.searchsorted(lists, lists, "left")
        place = np.arange(len(lists)) - starts
        kept = place < self.size
        self.found[touched] = False
        self.scores[lists[kept], place[kept]] = scores[kept]
        self.ids[lists[kept], place[kept]] = ids[kept]
        self.found[lists[kept], place[kept]] = True
        self.least[touched] = np.where(self.found[touched, -1], self.scores[touched, -1], LOWEST)


class Search:
    """Windows of scores ``[low, high]`` of each anchor, over rows of its label or of others.

    ``descend`` follows a tree best first: each anchor opens the node of the highest bound that one
    of its windows may still need. Anchors that open the same node are served together.
    """

    def __init__(self, vectors: np.ndarray, labels: np.ndarray, rows: np.ndarray, low: np.ndarray, high: np.ndarray, same: bool, size: int) -> None:
        self.vectors, self.labels, self.rows, self.same = vectors, labels, rows, same
        self.low, self.high = low, high  # by anchor and window
        self.plain = vectors.astype(np.float64)
        self.norms = np.sqrt((self.plain**2).sum(axis=1))
        self.best = Best(low.size, size)

    def _needed(self, anchors: np.ndarray) -> np.ndarray:
        """The least score that is still of use, by anchor and window."""
        return np.maximum(self.best.least.reshape(self.low.shape)[anchors], self.low[anchors])

    def _scores(self, anchors: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Inner products as whole numbers: in doubles where these hold them all, else in integers."""
        if self.norms.max(initial=0) * math.sqrt(float((vectors.astype(np.float64) ** 2).sum(axis=1).max(initial=0))) < 2**52:
            return (self.plain[anchors] @ vectors.T.astype(np.float64)).astype(np.int64)
        return self.vectors[anchors] @ vectors.T

    def descend(self, tree: Tree, anchors: np.ndarray) -> None:
        nodes = len(tree.nodes)
        centers = tree.vectors[tree.nodes[:, 0].astype(np.int64)]
        middle = self.plain[anchors] @ centers.T.astype(np.float64)
        reach = self.norms[anchors][:, None] * tree.nodes[:, 1]
        upper, lower = middle + reach, middle - reach
        labels, low, high = self.labels[anchors][:, None], tree.nodes[:, 6], tree.nodes[:, 7]
        fitting = (low <= labels) & (labels <= high) if self.same else (low != labels) | (labels != high)
        waiting = np.zeros((len(anchors), nodes), bool)
        waiting[:, 0] = True
        while True:
            needed = self._needed(anchors)
            useful = np.zeros_like(waiting)
            for window in range(self.low.shape[1]):
                useful |= (upper >= needed[:, window, None]) & (lower <= self.high[anchors, window][:, None])
            waiting &= useful & fitting
            alive = np.flatnonzero(waiting.any(axis=1))
            if not len(alive):
                return
            chosen = np.where(waiting[alive], upper[alive], -np.inf).argmax(axis=1)
            waiting[alive, chosen] = False
            for node in np.unique(chosen):
                who = alive[chosen == node]
                first, last = tree.nodes[node, 4:6].astype(np.int64)
                waiting[who, first:last] = True
                self._verify(tree, node, anchors[who])

    def _verify(self, tree: Tree, node: int, anchors: np.ndarray) -> None:
        """The exact scores of a node's own vectors."""
        own = slice(*tree.nodes[node, 2:4].astype(np.int64))
        ids, labels = tree.ids[own], tree.labels[own]
        if not len(ids):
            return
        scores = self._scores(anchors, tree.vectors[own])
        fitting = (labels[None, :] == self.labels[anchors][:, None]) == self.same
        fitting &= tree.rows[own][None, :] != self.rows[anchors][:, None]
        needed, high = self._needed(anchors), self.high[anchors]
        least = needed.min(axis=1)
        if self.low.shape[1] == 1 and len(ids) > self.best.size:
            # What is below the node's own best few is of no use either.
            inside = np.where(fitting & (scores <= high), scores, LOWEST)
            least = np.maximum(least, np.partition(inside, -self.best.size, axis=1)[:, -self.best.size])
        who, which = np.nonzero(fitting & (scores >= least[:, None]) & (scores <= high.max(axis=1)[:, None]))
        scores, ids = scores[who, which], ids[which]
        for window in range(self.low.shape[1]):
            inside = (scores >= needed[who, window]) & (scores <= high[who, window])
            if inside.any():
                self.best.add(anchors[who[inside]] * self.low.shape[1] + window, scores[inside], ids[inside])


# Tables


def taking_part(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """``id, label, vector`` with whole components of the rows that take part; not those with a null label
    or vector, a null or non-finite component, or a vector whose scores might not fit a long."""
    scaled = F.transform(F.col(vector).cast("array<double>"), lambda x: F.floor(F.lit(float(SCALE)) * x))
    usable = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    squared = F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0), lambda total, x: total + (SCALE * F.abs(x) + 1) * (SCALE * F.abs(x) + 1))
    label_ = F.col(label).cast("long")
    key_ = F.col(key).cast("long")
    kept = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(usable).where(squared < SQUARED_NORM)
    moved = F.when(F.pmod(key_, F.lit(7)) == 0, (label_ + 1) % 10).otherwise(label_)
    return kept.select(key_.alias("id"), moved.alias("label"), scaled.alias("vector"))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Lists of numbers as rows, shorter ones filled up with zeros."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    width = int(lengths.max(initial=0))
    if (lengths == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = flat
    return out


def _wider(matrix: np.ndarray, width: int) -> np.ndarray:
    return np.pad(matrix, ((0, 0), (0, width - matrix.shape[1])))


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(int(NO_ID)).to_numpy()


TREE = "small boolean, ids binary, rows binary, labels binary, vectors binary, nodes binary"


def _planted(group: pa.Table) -> pa.Table:
    """One tree of the rows of a group."""
    group = group.combine_chunks().sort_by([("id", "ascending"), ("row", "ascending")])
    tree = Tree.build(_ids(group["id"].combine_chunks()), group["row"].to_numpy(), group["label"].to_numpy(), _matrix(group["vector"]))
    small = np.abs(tree.vectors).max(initial=0) < 2**15
    parts = {"ids": tree.ids, "rows": tree.rows, "labels": tree.labels, "vectors": tree.vectors.astype(np.int16 if small else np.int64), "nodes": tree.nodes}
    return pa.table({"small": [bool(small)], **{name: [part.tobytes()] for name, part in parts.items()}})


def trees(rows: DataFrame) -> DataFrame:
    """All rows (``row, id, label, vector``) as cover trees of about ROWS_A_TREE vectors, dealt at
    random by their row numbers, so that no label or key makes a tree larger."""
    reachable(rows.sparkSession)
    n = max(1, -(-rows.count() // ROWS_A_TREE))
    dealt = rows.withColumn("tree", F.pmod(F.xxhash64("row"), F.lit(n)))
    return dealt.groupBy("tree").applyInArrow(_planted, TREE)


def _grown(batch: pa.RecordBatch, i: int) -> Tree:
    ids, rows, labels, vectors, nodes = (batch.column(name)[i].as_py() for name in ("ids", "rows", "labels", "vectors", "nodes"))
    ids = np.frombuffer(ids, np.int64)
    vectors = np.frombuffer(vectors, np.int16 if batch.column("small")[i].as_py() else np.int64).astype(np.int64)
    return Tree(
        ids, np.frombuffer(rows, np.int64), np.frombuffer(labels, np.int64),
        vectors.reshape(len(ids), -1), np.frombuffer(nodes, np.float64).reshape(-1, 8),
    )


def _searched(forest: DataFrame, anchors: pa.Table, low: np.ndarray, high: np.ndarray, same: bool, size: int) -> DataFrame:
    """``row, window, score, id``: the best of each window of each anchor in the trees of each task."""
    own = (_matrix(anchors["vector"]), anchors["label"].to_numpy(), anchors["row"].to_numpy(), low, high)
    sent = forest.sparkSession.sparkContext.broadcast(own)  # ANCHORS_A_PASS rows, about

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, labels, rows, low, high = sent.value
        search = None
        for batch in batches:
            for i in range(batch.num_rows):
                tree = _grown(batch, i)
                width = max(vectors.shape[1], tree.vectors.shape[1])
                if search is None or search.vectors.shape[1] != width:
                    known = search.best if search is not None else None
                    search = Search(_wider(vectors, width), labels, rows, low, high, same, size)
                    search.best = known or search.best
                tree.vectors = _wider(tree.vectors, width)
                for start in range(0, len(rows), TOGETHER):
                    search.descend(tree, np.arange(start, min(start + TOGETHER, len(rows))))
        if search is None:
            return
        lists, places = np.nonzero(search.best.found)
        ids = search.best.ids[lists, places]
        windows = low.shape[1]
        yield pa.record_batch(
            [
                pa.array(rows[lists // windows]), pa.array(lists % windows, pa.int32()),
                pa.array(search.best.scores[lists, places]), pa.array(ids, mask=ids == NO_ID),
            ],
            names=["row", "window", "score", "id"],
        )

    return mapped(forest, work, "row long, window int, score long, id long")


def _first(found: DataFrame, size: int) -> DataFrame:
    """The best of each window over all tasks, with their ``rank``."""
    order = Window.partitionBy("row", "window").orderBy(F.col("score").desc(), F.col("id").asc_nulls_first())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)


def hard_negatives(
    vectors: DataFrame, anchor: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label"
) -> DataFrame:
    """For each anchor (rows for whose ``id`` the condition ``anchor`` holds) and each of its positives
    the hardest negatives: ``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products of whole vectors. The positives are the first POSITIVES other rows
    of the anchor's label, the negatives the first NEGATIVES rows of another label whose score is
    from 80 to 100 hundredths of the positive's; higher scores come first, ties by smaller id. A
    positive of a score below 0 has none. Which rows take part, see ``taking_part``; rows that
    repeat an id are rows of their own, a null id comes before all others, and of two vectors the
    shorter is filled up with zeros. An empty table gives an empty result; other columns are ignored.

    All rows lie in cover trees, which are made once. The anchors go through all trees in passes of
    a fixed size, twice: for the positives, then for the negatives of all windows at once. A task
    keeps the best of each window over its trees, and only these rows are shuffled.
    """
    spark = vectors.sparkSession
    rows = staged(taking_part(vectors, key, vector, label).select(F.monotonically_increasing_id().alias("row"), "*"), "vectors")
    forest = staged(trees(rows), "trees")
    chosen = rows.where(anchor)
    passes = max(1, -(-chosen.count() // ANCHORS_A_PASS))
    chosen = staged(chosen.withColumn("pass", F.pmod(F.xxhash64("row"), F.lit(passes))), "anchors")
    parts = []
    for number in range(passes):
        # About ANCHORS_A_PASS rows.
        own = chosen.where(F.col("pass") == number).orderBy("row").toArrow()
        if not own.num_rows:
            continue
        n = own.num_rows
        everything = np.full((n, 1), LOWEST), np.full((n, 1), np.iinfo(np.int64).max)
        positives = _first(_searched(forest, own, *everything, same=True, size=POSITIVES), POSITIVES)
        positives = staged(positives.select("row", F.col("rank").alias("place"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
        # POSITIVES rows an anchor.
        found = positives.select("row", "place", "positive_score").toArrow()
        low, high = np.full((n, POSITIVES), np.iinfo(np.int64).max), np.full((n, POSITIVES), LOWEST)
        at = np.searchsorted(own["row"].to_numpy(), found["row"].to_numpy()), found["place"].to_numpy() - 1
        score = found["positive_score"].to_numpy()
        # The first whole number that is not below the share, in whole numbers throughout.
        low[at] = [-(-LEAST * int(x) // MOST) for x in score]
        high[at] = score
        negatives = _first(_searched(forest, own, low, high, same=False, size=NEGATIVES), NEGATIVES)
        joined = positives.join(negatives, (positives["row"] == negatives["row"]) & (F.col("place") == F.col("window") + 1))
        ids = chosen.select(F.col("row").alias("anchor_row"), F.col("id").alias("anchor_id"))
        joined = joined.join(ids, positives["row"] == ids["anchor_row"]).select(
            "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
        parts.append(staged(joined, "negatives"))
    if not parts:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out
