"""Hard negatives against a comparison of every anchor with every row."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm.rtree_search import Block, hard_negatives, interval, tiles, walk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, positives=5, negatives=10, low=30, high=90, every=10):
    good = {(i, lab, tuple(np.floor(256 * np.array(v, np.float32).astype(np.float64)).astype(int).tolist())) for i, v, lab in rows
            if i is not None and lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)}
    out = Counter()
    for a, label, q in good:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, v)), i, lab == label) for i, lab, v in good if i != a and len(v) == len(q))
        for p, pid, _ in [s for s in scored if s[2]][:positives]:
            hard = [s for s in scored if not s[2] and low * -p <= 100 * -s[0] <= high * -p][:negatives]
            out.update((a, pid, r + 1, i, -p, -s) for r, (s, i, _) in enumerate(hard))
    return out


def got(df, **parameters):
    found = hard_negatives(df, F.pmod("vec_id", F.lit(10)) == 0, **parameters).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    return Counter(map(tuple, found.collect()))


def rows_of(seed, n, dim, spread=1.0, labels=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim)) * spread
    v = (centres[rng.integers(0, 6, n)] + rng.normal(size=(n, dim)) * 0.3).astype(np.float32)
    hot = np.where(rng.random(n) < 0.35, 0, rng.integers(0, labels, n))
    return [(i, x.tolist(), int(k)) for i, (x, k) in enumerate(zip(v, hot))]


@pytest.mark.parametrize("limits", [{}, {"slab": 40, "leaf": 7, "block": 9}])
def test_against_all_rows(spark, limits):
    rows = rows_of(1, 500, 6)
    rows += [(600 + i, rows[i][1], rows[i % 3][2]) for i in range(60)]  # equal vectors: ties
    rows += [(700 + i, [0.0] * 6, i % 2) for i in range(30)]
    rows += [(900, None, 1), (910, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (920, [float("nan")] * 6, 1), (930, [float("inf")] * 6, 0),
             (940, [1.0] * 6, None), (None, [1.0] * 6, 1), (950, [1.0, 2.0], 1), (960, [0.5, 1.0], 2), (961, [1.0, 0.5], 1),
             (970, [], 1), (971, [], 1), (972, [], 2), (0, rows[0][1], rows[0][2]), (10, [0.25] * 6, 3)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for name in ("key", "dim", "v", "asks", "tree", "block"):
        df = df.withColumn(name, F.lit("mine"))
    want = brute(rows)
    assert got(df, **limits) == want and len(want) > 500


def test_scores_below_zero_and_windows(spark):
    """Positives below zero have an empty window; one of zero takes scores of zero only."""
    rows = [(0, [1.0, 0.0], 1), (1, [-1.0, 0.5], 1), (2, [0.0, 1.0], 1), (3, [0.0, 2.0], 2), (4, [-0.5, 0.0], 2), (5, [0.5, 3.0], 3)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df) == brute(rows) == Counter([(0, 2, 1, 3, 0, 0)])


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert not got(empty) and not got(spark.createDataFrame([(0, [1.0], 1), (0, [1.0], 1), (3, [1.0], 2)], SCHEMA))
    large = [(i, [3e6 * (1 + i % 3), -2e6 + i], i % 2) for i in range(12)]  # sums beyond what a double holds
    assert got(spark.createDataFrame(large, SCHEMA)) == brute(large)


def test_boxes_hold_their_rows():
    v = np.random.default_rng(3).integers(-99, 99, (700, 5))
    leaves = tiles(v, 64)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(700)) and max(map(len, leaves)) <= 64
    q = np.random.default_rng(4).integers(-99, 99, (8, 5))
    lo, hi = (np.stack([f(v[x], axis=0) for x in leaves]) for f in (np.min, np.max))
    lower, upper = interval(q, lo, hi)
    for i, x in enumerate(leaves):
        scores = q @ v[x].T
        assert (lower[:, i] <= scores.min(axis=1)).all() and (scores.max(axis=1) <= upper[:, i]).all()


def test_boxes_are_passed_over(monkeypatch):
    """Far clusters are not scored: the walk stops at boxes below the k-th score."""
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.integers(0, 20, (300, 3)) + np.array([c, 0, 0]) for c in range(0, 4000, 400)])
    leaves = tiles(v, 50)
    order = np.concatenate(leaves)
    lo, hi = (np.stack([f(v[x], axis=0) for x in leaves]).astype("<i8") for f in (np.min, np.max))
    row = {"dim": 3, "label": 1, "lo": lo.min(axis=0).tolist(), "hi": hi.max(axis=0).tolist(), "leaf_sizes": [len(x) for x in leaves],
           "leaf_lo": lo.tobytes(), "leaf_hi": hi.tobytes(), "ids": order.astype("<i8").tobytes(), "kind": "<i8", "v": v[order].astype("<i8").tobytes()}
    queries = pa.array([{"key": 1, "vec_id": -1, "label": 1, "v": [1, 0, 0], "asks": [{"ask": 0, "low": -(1 << 63), "high": None}]}], pa.struct(
        [("key", pa.int64()), ("vec_id", pa.int64()), ("label", pa.int32()), ("v", pa.list_(pa.int64())), ("asks", pa.list_(pa.struct(
            [("ask", pa.int64()), ("low", pa.int64()), ("high", pa.int64())])))]))
    block = Block(queries, 3, 5, same=True)
    added = []
    monkeypatch.setattr(block, "add", lambda *x: (added.append(len(x[0])), Block.add(block, *x)))
    walk(block, row)
    found = block.found()
    assert found.column("score").to_pylist() == sorted(v[:, 0].tolist(), reverse=True)[:5] and sum(added) < 700
