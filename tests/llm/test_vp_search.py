"""Nearest neighbours against all pairs; the factor against recall and comparisons."""

import math
import random

import numpy as np
import pytest

from barforge.llm import vp_search
from barforge.llm.queries import op11_vp_search
from barforge.llm.vp_search import Cells, ShardTree, gaps, nearest

SCHEMA = "vec_id long, embedding array<float>, label int"


def gap(a, b):
    total = 0.0
    for x, y in zip(a.tolist(), b.tolist(), strict=True):  # sum() would compensate for rounding
        total += (x - y) * (x - y)
    return math.sqrt(total)


def brute(rows, every=100, k=10):
    kept = {(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    kept = [(i, np.array(v, float)) for i, v in sorted(kept)]
    out = []
    for i, q in kept:
        if i % every == 0:
            near = sorted((gap(q, v), j) for j, v in kept if j != i)[:k]
            out += [(i, n + 1, j, d) for n, (d, j) in enumerate(near)]
    return sorted(out)


def got(df):
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in df.collect())


@pytest.fixture
def small(monkeypatch):
    """Shards, leaves and blocks of a few rows, so that small tables have many."""
    for name, n in (("SHARD_ROWS", 30), ("LEAF", 4), ("BLOCK", 3), ("MOST_BLOCKS", 2), ("SAMPLE_ROWS", 100)):
        monkeypatch.setattr(vp_search, name, n)


def test_given_table(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    df = op11_vp_search(spark, "/root/testdata/sf0.01")
    assert df.columns == ["query_id", "rank", "vec_id", "score"] and got(df) == brute(rows)


def test_many_shards_ties_and_copies(spark, small):
    rng = random.Random(2)
    grid = [[float(rng.randrange(-2, 3)) for _ in range(3)] for _ in range(400)]  # ties everywhere
    rows = [(k, v) for k, v in enumerate(grid)] + [(1000 + k, [1.0, 1.0, 1.0]) for k in range(200)]
    rows += [(None, [1.0, 2.0, 3.0]), (20, grid[20]), (20, [9.0, 9.0, 9.0]), (40, None), (60, [1.0, None, 2.0]), (80, [math.nan, 1.0, 1.0]), (100, [math.inf, 1.0, 1.0]), (-10, [0.0, 0.0, -1.0])]
    rng.shuffle(rows)
    table = spark.createDataFrame([(*r, 1) for r in rows], SCHEMA)
    want = brute(rows, 10, 7)
    assert sorted(got(nearest(table, 10, 7))) == want and len({r[0] for r in want}) > 50
    hot = [(k, [3.0, 4.0]) for k in range(500)] + [(k, [float(k), 1.0]) for k in range(500, 540)]
    assert got(nearest(spark.createDataFrame([(*r, 1) for r in hot], SCHEMA), 20, 5)) == brute(hot, 20, 5)


def test_few_rows_empty_and_clashing_columns(spark):
    assert nearest(spark.createDataFrame([], SCHEMA)).collect() == nearest(spark.createDataFrame([(0, [0.0, 0.0], 1), (100, None, 1), (200, [], 2)], SCHEMA)).collect() == []
    assert nearest(spark.createDataFrame([(0, [1.0], 1)], SCHEMA)).collect() == []
    rows = [(0, [1.0, 2.0]), (100, [1.0, 2.5]), (7, [-1.0, 0.0])]
    wide = spark.createDataFrame([(*r, *"123456") for r in [*rows, (8, [1.0, 1.0, 1.0])]], "vec_id long, embedding array<float>, cell string, shard string, vector string, rank string, score string, kind string")
    assert got(nearest(wide)) == brute(rows)


def test_factor_trades_recall_for_comparisons():
    rng = np.random.default_rng(3)
    vectors = rng.normal(0, 1, (40, 8))[rng.integers(0, 40, 4000)] + rng.normal(0, 0.15, (4000, 8))
    tree = ShardTree.unpacked(8, ShardTree.build(np.arange(4000), vectors).packed())
    own = np.arange(0, 4000, 40)
    away = gaps(vectors[own], vectors)
    away[np.arange(len(own)), own] = np.inf
    want = np.argsort(away, axis=1)[:, :10]
    seen = {}
    for factor in (1.0, 1.5, 3.0):
        ids, scores, compared = tree.search(own, vectors[own], np.full(len(own), np.inf), 10, factor)
        recall = np.mean([len(set(a) & set(b)) / 10 for a, b in zip(ids, want, strict=True)])
        assert np.allclose(scores, np.sort(away, axis=1)[:, :10]) or factor > 1
        seen[factor] = (recall, compared)
    assert seen[1.0][0] == 1 and seen[1.5][0] >= 0.9 and seen[3.0][1] < seen[1.5][1] < seen[1.0][1] < 4000 * len(own)


def test_bounds_of_cells_hold():
    rng = np.random.default_rng(5)
    vectors = np.round(rng.normal(0, 1, (3000, 4)), 1)
    cells = Cells.fit(vectors[:300], 5)
    cell, bound = cells.of(vectors), cells.bounds(vectors[:50])
    away = gaps(vectors[:50], vectors)
    assert (bound[:, cell] <= away).all() and (bound[np.arange(50), cell[:50]] <= 0).all() and (bound > 0).mean() > 0.5
