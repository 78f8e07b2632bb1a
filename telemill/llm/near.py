"""Near duplicates: BagMinHash signatures of word shingles, bands, and exact verification."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from telemill.llm.components import components
from telemill.llm.shared import mapped, pick, staged, temporary, whole

WORDS, SIMILARITY = 5, 0.8
#: Signature components in bands; a pair of similarity 0.8 shares a band with probability 0.997.
BANDS, ROWS = 32, 8
#: Words of texts that are signed together.
WORDS_A_TURN = 1 << 19
REMEMBERED = 400_000
#: Pairs of one document that a task verifies, about.
PAIRS_A_SALT = 500
#: Open documents of a bucket that are held together, and documents they are compared with.
OPEN_A_BLOCK, MEMBERS_A_SALT = 512, 1000
#: Tasks (about 60 bytes each) that are broadcast to fetch texts, and rows (16 bytes each) that are
#: broadcast to filter a table; for more, texts are shuffled.
BROADCAST_TASKS, BROADCAST_ROWS = 200_000, 1_000_000

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_FIRST = np.uint64(0xBF58476D1CE4E5B9)
_SECOND = np.uint64(0x94D049BB133111EB)


def _step(n: int) -> np.uint64:
    """n times the golden ratio, as 64-bit numbers wrap."""
    return np.uint64(n * int(_GOLDEN) & 0xFFFFFFFFFFFFFFFF)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _FIRST
    x = (x ^ (x >> np.uint64(27))) * _SECOND
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def bag(words: list[str], hashes: _WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of five words, as sorted hashes, and how often each occurs. Fewer
    words make one shingle together, no word makes none."""
    found = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    width = min(WORDS, len(words))
    if not width:
        return found, found.astype(np.int64)
    total = np.full(len(found) - width + 1, width, np.uint64)
    for i in range(width):
        total = _mixed(total * _GOLDEN + found[i : i + len(total)])
    return np.unique(total, return_counts=True)


def overlap(one: tuple[np.ndarray, np.ndarray], other: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags; 1 for two empty ones."""
    _, left, right = np.intersect1d(one[0], other[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(one[1][left], other[1][right]).sum())
    union = int(one[1].sum() + other[1].sum()) - shared
    return shared / union if union else 1.0


def signatures(owner: np.ndarray, shingles: np.ndarray, weights: np.ndarray, n: int, size: int) -> np.ndarray:
    """BagMinHash of n bags given as (owner, shingle, weight): a row of ``size`` numbers each.

    Weights are whole. A shingle has a Poisson process over time for each of the weight intervals
    (0, 1], (1, 2], (2, 4], (4, 8], ..., with the interval's width as its rate. A point falls on a
    weight level of its interval and on a component; it counts if the shingle's weight reaches
    the level. A component keeps the earliest time that counts, so two bags agree in it with
    probability of their weighted Jaccard similarity. The processes of a bag are followed only
    until they are later than all its components.
    """
    process = [(owner, shingles, np.zeros(len(owner)), np.ones(len(owner)), weights)]
    low, interval = 1, 1
    while (rest := weights > low).any():
        seeds = shingles[rest] ^ _step(interval)
        process.append((owner[rest], seeds, np.full(rest.sum(), float(low)), np.full(rest.sum(), float(low)), weights[rest]))
        low, interval = 2 * low, interval + 1
    owner, seed, base, width, weight = (np.concatenate(x) for x in zip(*process))
    seed = _mixed(seed)
    earliest = np.full((n, size), np.inf)
    latest = np.full(n, np.inf)
    time, turn = np.zeros(len(owner)), 0
    while len(owner):
        draw = _mixed(seed + _step(2 * turn + 1))
        time = time - np.log((np.float64(1) + (draw >> np.uint64(11))) * 2.0**-53) / width
        alive = time < latest[owner]
        if not alive.all():
            owner, seed, base, width, weight, time = (x[alive] for x in (owner, seed, base, width, weight, time))
        draw = _mixed(seed + _step(2 * turn + 2))
        component = ((draw >> np.uint64(32)) % np.uint64(size)).astype(np.int64)
        level = base + np.floor((draw & np.uint64(0xFFFFFFFF)) * 2.0**-32 * width) + 1
        counts = level <= weight
        np.minimum.at(earliest.reshape(-1), (owner * size + component)[counts], time[counts])
        touched = np.unique(owner)
        latest[touched] = earliest[touched].max(axis=1)
        turn += 1
    return earliest


def band_keys(signed: np.ndarray) -> np.ndarray:
    """A number per row and band; equal ones mean equal components in the same band."""
    parts = signed.view(np.uint64).reshape(len(signed), BANDS, ROWS)
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(signed), 1))
    for row in range(ROWS):
        keys = _mixed(keys * _GOLDEN + parts[:, :, row])
    return keys.view(np.int64)


def _node(words: list[str]) -> bytes:
    return xxhash.xxh3_128_digest(" ".join(words))


SIGNED = "row long, doc_id long, node binary, bands array<long>"
NAMES = ["row", "doc_id", "node", "bands"]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document: its number and key, a digest of its words, and its bands."""
    hashes = _WordHashes()
    for batch in batches:
        rows, keys, texts, at = batch.column(0), batch.column(1), batch.column(2), 0
        while at < len(rows):
            nodes, bags, size = [], [], 0
            while at + len(nodes) < len(rows) and size < WORDS_A_TURN:
                words = texts[at + len(nodes)].as_py().split()
                nodes.append(_node(words))
                bags.append(bag(words, hashes))
                size += len(words)
            n = len(nodes)
            owner = np.repeat(np.arange(n), [len(x) for x, _ in bags])
            signed = signatures(owner, np.concatenate([x for x, _ in bags]), np.concatenate([x for _, x in bags]), n, BANDS * ROWS)
            # A text without words is in no band.
            some = np.array([len(x) > 0 for x, _ in bags])
            places = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))])
            lists = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(band_keys(signed[some]).ravel(), pa.int64()))
            columns = [rows[at : at + n], keys[at : at + n], pa.array(nodes, pa.binary()), lists]
            yield pa.record_batch(columns, names=NAMES)
            at += n


class _Held:
    """Bags held in a task, to compare others with all of them at once."""

    def __init__(self, labels: list[int], bags: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.labels, self.n = labels, len(bags)
        shingles = np.concatenate([x for x, _ in bags])
        order = np.argsort(shingles, kind="stable")
        self._owner = np.repeat(np.arange(self.n), [len(x) for x, _ in bags])[order]
        self._times = np.concatenate([x for _, x in bags])[order]
        self._known, self._first, self._length = np.unique(shingles[order], return_index=True, return_counts=True)
        self._total = np.array([x.sum() for _, x in bags])

    def similarities(self, shingles: np.ndarray, times: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self._known, shingles), len(self._known) - 1)
        met = self._known[at] == shingles
        at, own = at[met], times[met]
        lengths = self._length[at]
        places = np.repeat(self._first[at] - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())
        shared = np.bincount(self._owner[places], np.minimum(self._times[places], np.repeat(own, lengths)), self.n)
        return shared / (self._total + times.sum() - shared)


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ordered by group and salt, those to hold first: the links of the others to them.

    In groups of one head all its similarities are returned. Where classes are wanted, a link
    within a class, as far as this task knows, is neither sought nor returned.
    """
    group, held, waiting, parent = None, None, [], {}

    def root(label: int) -> int:
        while parent.setdefault(label, label) != label:
            parent[label] = label = parent[parent[label]]
        return label

    for batch in batches:
        out: list[tuple[int, int, float]] = []
        columns = (batch.column(name) for name in ("group", "block", "salt", "other", "row", "label", "shingles", "times"))
        for to, block, salt, other, row, label, shingles, times in zip(*columns):
            key, row, label = (to.as_py(), block.as_py(), salt.as_py()), row.as_py(), label.as_py()
            own = (shingles.values.to_numpy().view(np.uint64), times.values.to_numpy())
            if key != group:
                group, held, waiting, parent = key, None, [], {}
            if not other.as_py():
                waiting.append((row, label, own))
                continue
            if held is None:
                if not waiting:
                    raise ValueError(f"the texts to compare with are missing in {key}")
                held = _Held([x for _, x, _ in waiting], [x for _, _, x in waiting])
            found = held.similarities(*own)
            if label is None:
                out.append((waiting[0][0], row, float(found[0])))
                continue
            for i in np.flatnonzero(found >= SIMILARITY).tolist():
                one, two = root(held.labels[i]), root(label)
                if one != two:
                    parent[one] = two
                    out.append((waiting[i][0], row, float(found[i])))
        columns = zip(*out) if out else ((), (), ())
        types = (pa.int64(), pa.int64(), pa.float64())
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types)], names=["head", "member", "similarity"])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bag of each document, once per task it is for."""
    hashes = _WordHashes()
    for batch in batches:
        for text, row, tasks in zip(*(batch.column(name) for name in ("text", "row", "tasks"))):
            shingles, times = bag(text.as_py().split(), hashes)
            n, to = len(tasks), tasks.values
            both = [
                pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(x), pa.int32()), pa.array(np.tile(x, n)))
                for x in (shingles.view(np.int64), times.astype(np.int32))
            ]
            columns = [*map(to.field, ("group", "block", "salt", "other")), pa.array([row.as_py()] * n, pa.int64()), to.field("label"), *both]
            yield pa.record_batch(columns, names=["group", "block", "salt", "other", "row", "label", "shingles", "times"])


def compared(docs: DataFrame, tasks: DataFrame) -> DataFrame:
    """``head, member, similarity`` of what ``tasks`` compare: rows ``group, block, salt`` (who
    meets), ``other`` (whether held, or compared with those held), ``row``, ``label``.

    Only the texts of documents in tasks are fetched, by their row numbers, and each bag is sent
    once per task.
    """
    per_row = tasks.groupBy("row").agg(F.collect_list(F.struct("group", "block", "salt", "other", "label")).alias("tasks"))
    wanted = staged(per_row, "wanted")
    small = (wanted.agg(F.sum(F.size("tasks"))).first()[0] or 0) <= BROADCAST_TASKS
    texts = docs.join(F.broadcast(wanted) if small else wanted, "row").select("text", "row", "tasks")
    schema = (
        "group long, block int, salt int, other boolean, row long, label long, shingles array<long>, times array<int>"
    )
    bags = mapped(texts, _bags, schema)
    ordered = bags.repartition("group", "block", "salt").sortWithinPartitions("group", "block", "salt", "other")
    return mapped(ordered, _compared, "head long, member long, similarity double")


def _star_tasks(spread: DataFrame) -> DataFrame:
    """Each document against the head of its buckets; a head with very many goes to many tasks."""
    pairs = staged(spread.where("row <> head").select("head", "row").distinct(), "pairs")
    n = F.ceil(F.count("*") / PAIRS_A_SALT).cast("int")
    heads = staged(pairs.groupBy("head").agg(n.alias("salts")), "heads")
    salt = F.pmod(F.xxhash64("row"), F.col("salts")).cast("int")
    none = F.lit(None).cast("long")
    members = pairs.join(heads, "head").select(
        F.col("head").alias("group"), F.lit(0).alias("block"), salt.alias("salt"), F.lit(True).alias("other"), "row", none.alias("label")
    )
    salts = F.explode(F.sequence(F.lit(0), F.col("salts") - 1))
    own = heads.select(
        F.col("head").alias("group"), F.lit(0).alias("block"), salts.alias("salt"), F.lit(False).alias("other"), F.col("head").alias("row"), none.alias("label")
    )
    return members.union(own)


def _open_tasks(spread: DataFrame, labels: DataFrame) -> DataFrame:
    """What the stars leave open: in each bucket of more than one component, the documents
    outside the largest, in blocks, against all of the bucket."""
    placed = spread.join(labels, spread["row"] == labels["node"], "left").select(
        "band", "row", F.coalesce("label", "row").alias("label")
    )
    placed = staged(placed, "placed")
    parts = placed.groupBy("band", "label").agg(F.count("*").alias("n"))
    largest = parts.groupBy("band").agg(
        F.max_by("label", F.struct("n", "label")).alias("largest"), F.max("n").alias("most"), F.sum("n").alias("n"), F.count("*").alias("parts")
    )
    largest = largest.where("parts > 1").select(
        "band",
        "largest",
        F.ceil((F.col("n") - F.col("most")) / OPEN_A_BLOCK).cast("int").alias("blocks"),
        F.ceil(F.col("n") / MEMBERS_A_SALT).cast("int").alias("salts"),
    )
    left = staged(placed.join(staged(largest, "largest"), "band"), "open")
    numbers = {name: F.pmod(F.xxhash64("row"), F.col(name)).cast("int") for name in ("blocks", "salts")}
    every = {name: F.explode(F.sequence(F.lit(0), F.col(name) - 1)) for name in ("blocks", "salts")}
    to_hold = left.where("label <> largest").select(
        F.col("band").alias("group"), numbers["blocks"].alias("block"), every["salts"].alias("salt"), F.lit(False).alias("other"), "row", "label"
    )
    others = left.select(
        F.col("band").alias("group"), every["blocks"].alias("block"), numbers["salts"].alias("salt"), F.lit(True).alias("other"), "row", "label"
    )
    return to_hold.union(others)


def _links(found: DataFrame) -> DataFrame:
    similar = found.where(F.col("similarity") >= SIMILARITY)
    return staged(similar.select(F.col("head").alias("a"), F.col("member").alias("b")), "links")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The class of every document: ``doc_id, class_id, class_size, kept``.

    Two texts are linked if the bags of their shingles of five words have a weighted Jaccard
    similarity of 0.8 or more and they share a band of their BagMinHash signatures; a class is
    what links connect. ``class_id`` is its smallest key, whose document is the one that is kept
    (of rows that repeat this key, one). Texts of the same words are of one class, texts without
    words too; a null text is an empty one, a null key smaller than any other.

    Copies are one node. In each bucket every node is first compared with one that shares most
    with others; where that leaves more than one component, what is outside the largest is held
    in blocks and compared with all of the bucket. No link between classes is lost, no bucket is
    capped, and no pairs are listed: the rows that move are those of the buckets. Rows are told
    apart by the numbers they get in a staged copy, so rows of one key, however many, are documents
    of their own. A very long text is one bag in its task. An empty table gives an empty result;
    other columns are ignored.
    """
    docs = pick(docs, row=F.monotonically_increasing_id(), doc_id=F.col(key).cast("long"), text=whole(text))
    return _classes(staged(docs, "documents")).drop("row").withColumnRenamed("doc_id", key)


def _classes(docs: DataFrame) -> DataFrame:
    """``near_duplicates`` of staged rows ``row, doc_id, text``, with the row numbers."""
    signed = staged(mapped(docs.select("row", "doc_id", "text"), _signed, SIGNED), "signed")
    reps = staged(signed.groupBy("node").agg(F.min("row").alias("rep")), "reps")
    joined = signed.join(reps, "node")
    members = staged(joined.select("row", "doc_id", "rep"), "members")
    nodes = staged(joined.where("row = rep").select("row", "bands"), "nodes")

    banded = nodes.select("row", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.count("*").alias("n"))
    shared = staged(banded.join(staged(buckets.where("n > 1"), "buckets"), "band"), "shared")
    # The node that meets most others is near the middle of its class.
    weights = staged(shared.groupBy("row").agg(F.sum("n").alias("weight")), "weights")
    heads = shared.join(weights, "row").groupBy("band").agg(F.max(F.struct("weight", (-F.col("row")).alias("behind"))).alias("best"))
    heads = staged(heads.select("band", (-F.col("best.behind")).alias("head")), "heads")
    spread = staged(shared.select("band", "row").join(heads, "band"), "spread")
    links = _links(compared(docs, _star_tasks(spread)))
    labels = components(links)
    open_tasks = staged(_open_tasks(spread, labels), "tasks")
    if not open_tasks.isEmpty():
        links = links.union(_links(compared(docs, open_tasks)))
        labels = components(links)

    labelled = members.join(labels, members["rep"] == labels["node"], "left").select(
        "row", "doc_id", F.coalesce("label", "rep").alias("label")
    )
    labelled = staged(labelled, "labelled")
    place = F.struct(F.col("doc_id").isNotNull().alias("given"), "doc_id", "row")
    classes = labelled.groupBy("label").agg(F.min(place).alias("first"), F.count("*").alias("class_size"))
    return labelled.join(staged(classes, "classes"), "label").select(
        "row",
        "doc_id",
        F.col("first.doc_id").alias("class_id"),
        "class_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows that are not the kept one of their class (``near_duplicates``), all
    columns as they are. One row of a class stays, also where its rows share a key or have none.

    Rows go by their numbers in a staged copy; the texts are shuffled only where more than
    BROADCAST_ROWS go.
    """
    row, gone_row = temporary(), temporary()
    docs = staged(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = _classes(pick(docs, row=F.col(row), doc_id=F.col(key).cast("long"), text=whole(text)))
    gone = staged(found.where("NOT kept").select(F.col("row").alias(gone_row)), "gone")
    few = gone.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(gone) if few else gone, docs[row] == gone[gone_row], "left_anti").drop(row)
