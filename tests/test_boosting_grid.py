"""Boosted trees: one tree against exhaustive search, held-out error, committees, reload."""

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from racelens.operators import boosting as B
from racelens.operators import models as M
from racelens.plans.queries_train import TCtx
from racelens.session import scratch_path

FAST = dict(M.GBT_INTERP, maxIter=30, maxDepth=4, stepSize=0.2)


def test_first_split_is_the_best_one():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 9, (200, 3)).astype(float)
    r = rng.normal(size=200) + (x[:, 1] > 4)
    edges = [np.unique(x[:, f])[1:] for f in range(3)]
    codes = np.column_stack([np.searchsorted(e, x[:, f], "right") for f, e in enumerate(edges)])
    tree = B.grow(codes, edges, r, np.arange(3), 1, 1.0)

    def gain(f, c):
        low = x[:, f] < c
        return sum(r[m].sum() ** 2 / (m.sum() + B.L2) for m in (low, ~low))

    assert (tree["feature"][0], tree["cut"][0]) == max(((f, c) for f in range(3) for c in edges[f]), key=lambda s: gain(*s))
    low = x[:, tree["feature"][0]] < tree["cut"][0]
    assert np.allclose(B.predict(tree, x), np.where(low, r[low].sum() / (low.sum() + 1), r[~low].sum() / ((~low).sum() + 1)))


def test_beats_the_mean_on_rows_it_has_not_seen():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 4))
    y = np.sin(2 * x[:, 0]) + x[:, 1] * x[:, 2] + rng.normal(scale=0.1, size=3000)
    base, trees = B.boost(x[:2000], y[:2000], dict(M.GBT_INTERP, maxDepth=5), [42])
    pred = base + sum(B.predict(t, x[2000:]) for t in trees)
    assert np.abs(y[2000:] - pred).mean() < 0.4 * np.abs(y[2000:] - base).mean()
    again = B.boost(x[:2000], y[:2000], dict(M.GBT_INTERP, maxDepth=5), [42])
    assert again[1][7] == trees[7]


@pytest.mark.parametrize("block_rows,members", [(50_000, 4), (200, 3)])
def test_grid_with_one_block_and_with_committees(spark, monkeypatch, block_rows, members):
    monkeypatch.setattr(B, "BLOCK_ROWS", block_rows)
    run = TCtx(spark, SF_SMALL).interp
    rows = run.boost_rows
    store = scratch_path(spark, "trees")
    B.fit_grid(rows.filter("position <= 2"), FAST).write.parquet(store)
    models = spark.read.schema(B.TREE_SCHEMA).parquet(store)
    sizes = rows.groupBy("position", "block").count().collect()
    assert max(r["count"] for r in sizes) < 1.5 * block_rows
    got = B.score_grid(rows.filter("position <= 2"), models, run.pairs, members)
    pairs = {p.pair_id: p for p in run.pairs}
    found = got.groupBy("pair_id").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"),
                                       F.stddev_pop("y").alias("sd")).collect()
    want = {r["pair_id"]: r["n_complete"] for r in run.counts.filter("trained").collect() if pairs[r["pair_id"]].p_idx <= 2}
    assert {r["pair_id"]: r["n"] for r in found} == want and len(want) == 3
    assert all(r["mae"] < 0.75 * r["sd"] for r in found)
    # the reloaded trees give the same predictions again
    again = B.score_grid(rows.filter("position <= 2"), spark.read.parquet(store), run.pairs, members)
    assert got.join(again.withColumnRenamed("pred", "other"), ["pair_id", "row_key"]).filter("abs(pred - other) > 1e-9").count() == 0


def _plain(x, y, params, seed):
    """The learner row by row of the definition: every tree on the float cuts, predictions of all rows by walking it."""
    rng = np.random.default_rng(seed)
    edges, codes = B.binned(x)
    codes = np.column_stack(codes)
    fitted, trees = np.full(len(y), y.mean()), []
    for _ in range(params["maxIter"]):
        rows = np.flatnonzero(rng.random(len(y)) < params["subsamplingRate"])
        columns = np.sort(rng.choice(x.shape[1], max(1, round(0.8 * x.shape[1])), replace=False))
        if len(rows):
            trees.append(B.grow(codes[rows], edges, (y - fitted)[rows], columns, params["maxDepth"], params["stepSize"]))
            fitted += B.predict(trees[-1], x)
    return y.mean(), trees


@pytest.mark.parametrize("n,kinds", [(1, 3), (2, 1000), (40, 2), (900, 7), (900, 1000)])
def test_look_ups_give_what_walking_the_cuts_gives(n, kinds):
    """rows in and out of the draw, ties, equal rows, single rows; and every tree on values it has not seen."""
    rng = np.random.default_rng(n)
    x = rng.integers(0, kinds, (n, 3)).astype(float)
    y = x[:, 0] + rng.integers(0, 4, n)
    params = dict(M.GBT_INTERP, maxIter=15)
    base, trees = B.boost(x, y, params, [1])
    assert (base, trees) == _plain(x, y, params, [1])
    seen = np.vstack([x, rng.normal(size=(30, 3)) * kinds, np.full((1, 3), np.nan)])
    assert np.array_equal(B.predict_all(trees, seen), sum((B.predict(t, seen) for t in trees), np.zeros(len(seen))))
