"""Exact top-k search and hard-negative mining against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import hard_negatives as mining
from corpusloom.llm import integer_vectors, kd_search
from corpusloom.llm.hard_negatives import hard_negatives
from corpusloom.llm.integer_vectors import BestRows
from corpusloom.llm.kd_search import KdTree, top_k

# Extra columns have names that the operators use themselves.
SCHEMA = "vec_id long, embedding array<float>, label int, id long, score long, vector string, slot int, rank int"


@pytest.fixture
def make_vectors(spark):
    def make(rows, parts=3):
        rows = [(i, v, label, 7, 7, "x", 7, 7) for i, v, label in rows]
        return spark.createDataFrame(rows, SCHEMA).repartition(parts)

    return make


def usable(rows, factor, labelled):
    """Rows that take part as whole numbers: the smallest (vector, label) of each id."""
    held = {}
    for i, v, label in rows:
        if i is None or v is None or (labelled and label is None):
            continue
        if any(x is None or not math.isfinite(x) for x in v):
            continue
        row = ([math.floor(factor * float(np.float32(x))) for x in v], label if labelled else 0)
        held[i] = min(held.get(i, row), row)
    return held


def score(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_top_k(rows, every, k, factor):
    held = usable(rows, factor, False)
    out = []
    for q, (v, _) in held.items():
        if q % every == 0:
            best = sorted((-score(v, w), i) for i, (w, _) in held.items() if i != q)[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return sorted(out)


def brute_negatives(rows, every, factor, n_positives=5, n_negatives=10, low=30, high=90):
    held = usable(rows, factor, True)
    out = []
    for a, (v, label) in held.items():
        if a % every:
            continue
        ranked = sorted((-score(v, w), i, of) for i, (w, of) in held.items() if i != a)
        for minus, p, _ in [row for row in ranked if row[2] == label][:n_positives]:
            s = -minus
            rest = [(n, -m) for m, n, of in ranked if of != label and low * s <= -100 * m <= high * s]
            out += [(a, p, r + 1, n, s, t) for r, (n, t) in enumerate(rest[:n_negatives])]
    return sorted(out)


def made_rows(rng, n, dims=6, ties=False):
    rows = []
    for i in range(n):
        v = [rng.randrange(-2, 3) / 8 if ties else rng.gauss(0, 1) for _ in range(dims)]
        rows.append((i, v, rng.randrange(4)))
    return rows


ODD = [
    (None, [1.0] * 6, 1),
    (900, None, 1),
    (901, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1),
    (902, [float("nan")] + [0.0] * 5, 1),
    (903, [float("inf")] + [0.0] * 5, 1),
    (904, [9.0] * 6, None),
    (910, [], 2),
    (920, [1.0, -1.0], 2),
    (930, [0.0] * 6, 0),
    # One id with equal rows, one with different ones.
    (940, [1.0] * 6, 3),
    (940, [1.0] * 6, 3),
    (950, [1.0] * 6, 3),
    (950, [-1.0] * 6, 2),
]


@pytest.mark.parametrize("ties", [False, True])
def test_top_k_equals_brute_force(make_vectors, monkeypatch, ties):
    # Small shards, leaves and blocks, so that there are several of each.
    monkeypatch.setattr(kd_search, "SHARD_BYTES", 1)
    monkeypatch.setattr(kd_search, "LEAF_ROWS", 40)
    monkeypatch.setattr(kd_search, "query_blocks", lambda v, q: integer_vectors.query_blocks(v, q, 7))
    rows = made_rows(random.Random(ties), 300, ties=ties) + ODD
    found = top_k(make_vectors(rows), F.col("id") % 10 == 0, 20, factor=64).collect()
    assert sorted(tuple(row) for row in found) == brute_top_k(rows, 10, 20, 64)


def test_top_k_of_few_and_of_no_rows(make_vectors):
    rows = [(0, [1.0, 2.0], 0), (10, [1.0, 2.0], 0), (3, [0.5, 0.5], 0)]
    query = F.col("id") % 10 == 0
    found = [tuple(row) for row in top_k(make_vectors(rows), query, 20, factor=2).collect()]
    assert sorted(found) == [(0, 1, 10, 20), (0, 2, 3, 6), (10, 1, 0, 20), (10, 2, 3, 6)]
    assert top_k(make_vectors([]), query, 20).collect() == []
    assert top_k(make_vectors(rows[2:]), query, 20).collect() == []
    empty = top_k(make_vectors([(0, [], 0), (1, [], 0), (2, [], 0)]), query, 1).collect()
    assert [tuple(row) for row in empty] == [(0, 1, 1, 0)]


def test_top_k_refuses_inexact_sums(make_vectors):
    with pytest.raises(ValueError, match="exact"):
        top_k(make_vectors([(0, [1e30], 0)]), F.lit(True), 1).collect()


def test_tree_has_tight_boxes_and_prunes():
    rng = np.random.default_rng(1)
    # Rows in separate clumps: most leaves cannot hold a better row.
    centres = rng.integers(-500, 500, (32, 4))
    rows = (centres[rng.integers(0, 32, 4096)] + rng.integers(-3, 4, (4096, 4))).astype(np.float64)
    tree = KdTree.build(np.arange(4096), rows, leaf_rows=64)
    leaves = 0
    for (first, end), (left, right), low, high in zip(tree.starts, tree.children, tree.low, tree.high):
        part = tree.vectors[first:end]
        assert (part.min(axis=0) == low).all() and (part.max(axis=0) == high).all()
        if left < 0:
            leaves += 1
            assert end - first <= 64
        else:
            (begin, middle), (same, last) = tree.starts[[left, right]]
            assert (begin, last) == (first, end) and middle == same
            assert abs((middle - begin) - (last - middle)) <= 1
    queries = rows[:20]
    best = BestRows(20, 5)
    visits = tree.search(np.arange(20), queries, best)
    assert visits < 20 * leaves / 4
    scores = queries @ rows.T
    scores[np.arange(20), np.arange(20)] = -np.inf
    assert (best.scores == -np.sort(-scores, axis=1)[:, :5]).all()
    # With the k-th score known from elsewhere, fewer leaves are looked at.
    again = BestRows(20, 5, best.scores[:, -1])
    assert tree.search(np.arange(20), queries, again) <= visits
    assert (again.ids == best.ids).all()


@pytest.mark.parametrize("ties", [False, True])
def test_negatives_equal_brute_force(make_vectors, monkeypatch, ties):
    monkeypatch.setattr(mining, "STEP_ROWS", 16)
    monkeypatch.setattr(mining, "BLOCK_ANCHORS", 9)
    rows = made_rows(random.Random(10 + ties), 300, ties=ties) + ODD
    found = hard_negatives(make_vectors(rows), F.col("id") % 10 == 0, F.col("label"), factor=256)
    expected = brute_negatives(rows, 10, 256)
    assert len({row[1] for row in expected}) > 20
    assert sorted(tuple(row) for row in found.collect()) == expected


def test_windows_that_overlap_and_other_limits(make_vectors):
    # Positives of equal and of different scores; negatives on the limits themselves.
    rows = [(0, [10.0], 1), (1, [10.0], 1), (2, [10.0], 1), (3, [5.0], 1), (4, [-1.0], 1), (5, [0.0], 1)]
    rows += [(100 + n, [n / 2], 2) for n in range(1, 25)]
    for low, high in ((30, 90), (0, 100), (50, 50)):
        found = hard_negatives(
            make_vectors(rows), F.col("id") == 0, F.col("label"), 2, 5, 3, low, high
        ).collect()
        expected = [row for row in brute_negatives(rows, 1000, 2, 5, 3, low, high) if row[0] == 0]
        assert sorted(tuple(row) for row in found) == expected


def test_no_negatives(make_vectors):
    anchor = F.col("id") % 10 == 0
    assert hard_negatives(make_vectors([]), anchor, F.col("label")).collect() == []
    alone = [(0, [1.0], 1), (1, [1.0], 1)]
    assert hard_negatives(make_vectors(alone), anchor, F.col("label")).collect() == []
    assert hard_negatives(make_vectors(ODD[:6]), anchor, F.col("label")).collect() == []
