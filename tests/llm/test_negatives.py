"""Hard negatives against all scores by hand."""

import math
from itertools import count

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemill.llm import negatives

SCHEMA = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT"
COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def by_hand(rows, modulus=100):
    taken = []
    for number, (vec_id, vector, label) in zip(count(), rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        if sum((256 * abs(x) + 1) ** 2 for x in vector) >= 2**62:
            continue
        taken.append((number, vec_id, (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label, whole))

    def place(item):
        score, vec_id = item
        return -score, vec_id is not None, vec_id or 0

    out = []
    for number, vec_id, label, whole in taken:
        if vec_id is None or vec_id % modulus:
            continue
        scored = [(sum(a * b for a, b in zip(whole, other)), i, same == label) for n, i, same, other in taken if n != number]
        positives = sorted([(s, i) for s, i, same in scored if same], key=place)[:5]
        for score, positive in positives:
            fitting = [(s, i) for s, i, same in scored if not same and 80 * score <= 100 * s <= 100 * score]
            for rank, (s, i) in enumerate(sorted(fitting, key=place)[:5], 1):
                out.append((vec_id, positive, rank, i, score, s))
    return sorted(out, key=repr)


def found(spark, rows, modulus=100):
    table = spark.createDataFrame(rows, SCHEMA)
    for name in ("id", "row", "vector", "tree", "small", "pass", "score", "rank", "window", "place"):
        table = table.withColumn(name, F.lit("clash"))
    result = negatives.hard_negatives(table.repartition(3), F.col("id") % modulus == 0)
    return sorted(map(tuple, result.select(COLUMNS).collect()), key=repr)


def random_rows(n, width, seed, spread=1.0, centers=0):
    draw = np.random.default_rng(seed)
    middle = draw.normal(size=(max(1, centers), width))
    rows = []
    for i in range(n):
        vector = draw.normal(size=width) * spread + (middle[i % centers] if centers else 0)
        rows.append((i, [float(np.float32(x)) for x in vector], int(draw.integers(0, 4))))
    return rows


ODD = [
    (None, [0.5, 0.5], 1), (100, None, 1), (200, [0.1], None), (300, [float("nan"), 1.0], 1), (400, [float("inf"), 1.0], 2),
    (500, [None, 1.0], 2), (600, [], 3), (700, [1e30, 1.0], 1), (800, [0.25, -0.25, 0.75], 1), (800, [0.25, -0.25, 0.75], 1),
    (-100, [-1.0] * 9, 0), (900, [0.0] * 8, 2),
]


@pytest.mark.parametrize("trees", [2048, 60])
def test_random_vectors(spark, monkeypatch, trees):
    monkeypatch.setattr(negatives, "ROWS_A_TREE", trees)
    rows = random_rows(400, 8, 1) + ODD
    assert found(spark, rows, 20) == by_hand(rows, 20) != []


def test_clusters_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 8)
    monkeypatch.setattr(negatives, "ANCHORS_A_PASS", 7)
    rows = random_rows(300, 6, 2, spread=0.02, centers=5)
    # Coarse vectors tie often, a third of the rows are copies of one.
    rows += [(1000 + i, [float(round(x, 0)) for x in v], label) for i, v, label in random_rows(200, 4, 3)]
    rows += [(2000 + i, [1.0, 1.0, 0.5, 0.0, 0.0, 0.0], i % 2) for i in range(250)]
    assert found(spark, rows, 25) == by_hand(rows, 25)


def test_large_components(spark):
    rows = [(i, [x * 2.0**18 for x in v], label) for i, v, label in random_rows(120, 5, 4)]
    assert found(spark, rows, 10) == by_hand(rows, 10)


def test_nothing_to_find(spark):
    assert found(spark, [(1, [1.0], 1)]) == []
    assert found(spark, [(100, [1.0], 1)]) == []
    assert found(spark, []) == []


def test_tree_bounds_hold(monkeypatch):
    monkeypatch.setattr(negatives, "LEAF", 8)
    draw = np.random.default_rng(5)
    vectors = np.concatenate([draw.integers(-256, 256, (300, 5)), draw.integers(-9, 9, (500, 5)) + 90, np.full((70, 5), 3)])
    n = len(vectors)
    tree = negatives.Tree.build(np.arange(n), np.arange(n), np.arange(n) % 3, vectors)
    assert sorted(tree.ids.tolist()) == list(range(n))
    assert len(tree.nodes) > 10

    def below(node):
        _, _, first, last, child, end, _, _ = tree.nodes[node].tolist()
        own = list(range(int(first), int(last)))
        return own + [x for c in range(int(child), int(end)) for x in below(c)]

    queries = draw.integers(-256, 256, (40, 5))
    for node, (center, radius, *_, low, high) in enumerate(tree.nodes):
        rows = below(node)
        scores = queries @ tree.vectors[rows].T
        middle = (queries @ tree.vectors[int(center)])[:, None]
        assert (np.abs(scores - middle) <= np.linalg.norm(queries, axis=1)[:, None] * radius).all()
        assert low <= tree.labels[rows].min() and tree.labels[rows].max() <= high


def test_descent_leaves_nodes_unopened(monkeypatch):
    """In clustered vectors most nodes are outside an anchor's windows."""
    monkeypatch.setattr(negatives, "LEAF", 16)
    draw = np.random.default_rng(6)
    vectors = np.concatenate([draw.integers(-3, 3, (200, 8)) + center for center in draw.integers(-256, 256, (10, 8))])
    n = len(vectors)
    tree = negatives.Tree.build(np.arange(n), np.arange(n), np.zeros(n, np.int64), vectors)
    opened = []
    verify = negatives.Search._verify
    monkeypatch.setattr(negatives.Search, "_verify", lambda self, tree, node, anchors: (opened.append(node), verify(self, tree, node, anchors)))
    top = np.full((1, 1), np.iinfo(np.int64).max)
    search = negatives.Search(vectors[:1], np.zeros(1, np.int64), np.zeros(1, np.int64), np.full((1, 1), negatives.LOWEST), top, True, 5)
    search.descend(tree, np.arange(1))
    scores = vectors[1:] @ vectors[0]
    assert search.best.scores[0].tolist() == sorted(scores.tolist(), reverse=True)[:5]
    assert len(opened) < len(tree.nodes) / 3
