"""Hard negatives against all products, and the tree's bounds against what they bound."""

import math

import numpy as np
import pytest
from plain import text_of  # noqa: F401
from pyspark.sql import functions as F

from tallyforge.llm import negatives

KINDS = "vec_id long, embedding array<float>, label int"


def plain(rows, every=10, positives=5, count=5):
    """Contract rows over (id, vector, label) by comparing every pair."""
    seen = {
        (i, l, tuple(math.floor(256 * x) for x in v)) for i, v, l in rows
        if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for a, label, q in seen:
        if a is None or a % every:
            continue
        scored = [(-sum(x * y for x, y in zip(q, v, strict=False)), i is None, i or 0, i, l) for i, l, v in seen]
        mine = sorted((s for s in scored if s[4] == label and s[3] != a), key=lambda s: s[:3])[:positives]
        others = sorted((s for s in scored if s[4] != label), key=lambda s: s[:3])
        for p in mine:
            fit = [s for s in others if 80 * -p[0] <= 100 * -s[0] <= 100 * -p[0]][:count]
            out += [(a, p[3], r + 1, s[3], -p[0], -s[0]) for r, s in enumerate(fit)]
    return sorted(out, key=str)


def mined(spark, rows, every=10, **kw):
    df = spark.createDataFrame(rows, KINDS).withColumn("vec", negatives.integer_vector(F.col("embedding")))
    df = df.withColumn("chunk", F.lit("clash")).withColumn("node", F.lit(1.5))
    found = negatives.mine(df, F.col("vec_id") % every == 0, vector="vec", **kw)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def cloud(n, d, seed, centres=6):
    """Clustered vectors, with copies of one of them under many ids."""
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(centres, d))
    x = middle[rng.integers(0, centres, n)] + 0.3 * rng.normal(size=(n, d))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x[n // 2 : n // 2 + n // 4] = x[0]
    return [(i, [float(np.float32(v)) for v in x[i]], int(rng.integers(0, 4))) for i in range(n)]


@pytest.mark.parametrize(("n", "sample"), [(400, 1024), (600, 40)])
def test_against_all_pairs(spark, n, sample):
    rows = cloud(n, 8, n)
    assert mined(spark, rows, sample=sample) == plain(rows)


def test_small_chunks_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 7)
    monkeypatch.setattr(negatives._chunk_nodes, "__defaults__", (50,))
    rows = cloud(500, 6, 9)
    assert mined(spark, rows, sample=30) == plain(rows)


def test_awkward_rows(spark):
    rows = cloud(60, 5, 3)
    rows += rows[:15]  # repeated rows count once
    rows += [
        (None, rows[3][1], 1), (None, rows[3][1], 1), (None, rows[4][1], 2), (70, None, 1), (80, rows[1][1], None), (90, [], 1),
        (100, [float("nan"), 1.0], 1), (110, [float("inf"), 1.0], 1), (120, [None, 1.0], 1), (130, [1.0], 2), (140, rows[2][1], 3),
        (140, rows[5][1], 3), (-10, [-1.0, -1.0, -1.0, -1.0, -1.0], 1), (150, [0.0] * 5, 77), (160, [40.0, -3.5, 1e6, 2.0, 1.0], 0),
    ]
    assert mined(spark, rows) == plain(rows)


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(10, [1.0], 1), (2, [1.0], 2)]) == []
    assert mined(spark, [(10, [], 1), (2, [], 1), (3, [], 0)]) == [(10, 2, 1, 3, 0, 0)]


def test_bounds_hold_and_skip():
    """Every product lies within its node's bounds, and clustered rows leave most nodes unvisited."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16))
    x = np.floor(256 * np.concatenate([c / np.linalg.norm(c) + 0.02 * rng.normal(size=(80, 16)) for c in centres])).astype(np.int64)
    longest = math.sqrt((x.astype(float) ** 2).sum(axis=1).max())
    tree = negatives.fit(list(range(200)), [0] * 200, x[rng.permutation(len(x))[:200]], longest)
    node, path = negatives.descend(tree, x)
    deepest = 1 + max(negatives._depths(tree))
    counts = {}
    for n in np.unique(node):
        own = [path[i] for i in np.flatnonzero(node == n)]
        counts[int(n)] = {f"r{k}": max((p[k] for p in own if len(p) > k), default=None) for k in range(deepest)}
    negatives._measure(tree, counts, deepest)
    assert (tree.below <= negatives.BASE ** (tree.levels + 1) * 5).all()
    q = x[::50]
    bounds = negatives.Bounds(tree, q)
    exact = negatives.products(q, x)
    assert (exact <= bounds.greatest(tree.own)[:, node]).all() and (exact >= bounds.least(tree.own)[:, node]).all()
    fifth = np.sort(exact, axis=1)[:, -5]
    met = bounds.reached(lambda high, low: high >= fifth[:, None])
    assert met.mean() < 0.5
    for i in range(len(q)):
        assert met[i, node[exact[i] >= fifth[i]]].all()


def test_products_are_exact():
    q, x = np.array([[2**30, -3]]), np.array([[2**31, 7], [1, 1]])
    assert negatives.products(q, x).tolist() == [[2**61 - 21, 2**30 - 3]]
    assert negatives.products(np.zeros((2, 0), np.int64), np.zeros((3, 0), np.int64)).shape == (2, 3)
