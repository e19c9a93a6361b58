"""a pair has one booster of all its rows, whatever their number and however they are dealt out."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from racelens.operators import boosting as B
from racelens.operators import grid as G
from racelens.operators import models as M
from racelens.session import scratch_path

SPLITS = ["km_5", "km_10", "km_15"]
FAST = dict(M.GBT_INTERP, maxIter=6, maxDepth=4, stepSize=0.3)


def _wide(spark, n, seed=0, ids=None):
    rng = np.random.default_rng(seed)
    v = np.cumsum(rng.integers(1, 9, (n, 3)) * 100.0, axis=1)
    lead = rng.integers(1, 4, n)
    rows = [(int(ids[i]) if ids is not None else i, int(rng.integers(18, 30)), "MF"[i % 2], *[float(v[i, k]) if k < lead[i] else None for k in range(3)]) for i in range(n)]
    return spark.createDataFrame(rows, "finisher_id long, age int, gender string, km_5 double, km_10 double, km_15 double")


def _rows(wide):
    counts = {p: wide.filter(" and ".join(f"{s} is not null" for s in SPLITS[:p + 1])).count() for p in (1, 2)}
    return B.position_rows(wide, SPLITS, {p: n for p, n in counts.items() if n})


def _trees(models):
    return sorted((r.position, r.target, r.tree, r.base, tuple(r.feature), tuple(r.cut), tuple(r.left), tuple(r.value)) for r in models.collect())


def test_one_booster_a_pair_however_rows_are_dealt_out(spark, monkeypatch):
    wide, got = _wide(spark, 3000).cache(), []
    for block_rows, task_rows, tasks in ((50_000, 400_000, 1), (100, 700, 7)):
        monkeypatch.setattr(B, "BLOCK_ROWS", block_rows)
        monkeypatch.setattr(B, "TASK_ROWS", task_rows, raising=False)
        rows = _rows(wide.repartition(tasks))
        B.fit_grid(rows, FAST).write.parquet(store := scratch_path(spark, "trees"))
        models = spark.read.schema(B.TREE_SCHEMA).parquet(store)
        pred = B.score_grid(rows, models, G.interp_pairs(SPLITS)).collect()
        got.append((_trees(models), sorted((r.pair_id, r.row_key, r.y, r.pred) for r in pred)))
    assert got[0] == got[1]
    trees, pred = got[0]
    assert [t[:3] for t in trees] == [(p, t, i) for p, t in ((1, 0), (2, 0), (2, 1)) for i in range(6)]
    for p, t in ((1, 0), (2, 0), (2, 1)):
        mean = wide.filter(f"{SPLITS[p]} is not null").agg(F.avg(SPLITS[t])).first()[0]
        assert [x[3] for x in trees if x[:2] == (p, t)] == pytest.approx([mean] * 6, rel=1e-9)


def test_cells_give_the_trees_of_single_rows(spark):
    rows = _rows(_wide(spark, 900))
    found = B.binned_rows(rows)
    got = _trees(B.fit_grid(rows, FAST, found))
    for p in (1, 2):
        own = rows.filter(F.col("position") == p).collect()
        v, keys = np.array([r.v for r in own]), np.array([r.row_key for r in own])
        for t in range(p):
            edges = [e for f, e in enumerate(found.edges[p]) if f != t]
            codes = [np.searchsorted(e, x, "right") for e, x in zip(edges, np.delete(v, t, axis=1).T, strict=True)]
            unit = B._unit(len(own), v[:, :p + 1].max())
            y = np.rint(v[:, t] / unit)
            alone = B._alone(codes, y, np.full(len(y), np.rint(y.mean())))
            alone.bucket = B._bucket(keys).astype(np.int64)
            want = list(B._boosted([alone], edges, B.BUCKETS, FAST, [FAST["seed"], p, t], unit))
            some = [x for x in got if x[:2] == (p, t)]
            assert len(want) == len(some) == 6
            assert [(x[4], x[5], x[6], x[7]) for x in some] == [tuple(tuple(w[k].tolist()) for k in ("feature", "cut", "left")) + (tuple((w["value"] * unit).tolist()),) for w in want]


def test_a_pair_larger_than_the_memory_held(spark, monkeypatch):
    rows = _rows(_wide(spark, 900))
    found = B.binned_rows(rows)
    batches = found.cells.toArrow().to_batches()
    whole = [b.to_pydict() for b in B._fit(iter(batches), found, FAST)]
    monkeypatch.setattr(B, "HELD_BYTES", 4096)
    monkeypatch.setattr(B, "CHUNK_CELLS", 50)
    assert len(whole) == 18
    assert [b.to_pydict() for b in B._fit(iter(batches), found, FAST)] == whole


def test_edges_are_quantiles_of_all_rows(spark):
    rng = np.random.default_rng(3)
    n = 6000
    near = np.nextafter(1.0, 2.0)
    columns = [rng.lognormal(0, 4, n), rng.integers(0, 5, n) * 1.0, np.full(n, 7.0), np.append(rng.normal(size=n - 1), 1e15), rng.choice([1.0, near, -1e15], n)]
    rows = spark.createDataFrame([(1, [float(c[i]) for c in columns]) for i in range(n)], "position int, v array<double>").repartition(5)
    counts, reach, edges = B.bin_edges(rows)
    assert counts == {1: n} and reach == {1: max(columns[0].max(), 7.0)}
    for x, e in zip(columns, edges[1], strict=True):
        assert e.tolist() == np.unique(np.sort(x)[(n - 1) * np.arange(1, B.BINS) // B.BINS]).tolist()


def test_a_key_that_comes_twice_has_one_prediction(spark):
    ids = np.arange(400) // 2
    rows = _rows(_wide(spark, 400, ids=ids))
    models = B.fit_grid(rows, FAST).checkpoint()
    got = B.score_grid(rows, models, G.interp_pairs(SPLITS)).select("pair_id", "row_key").collect()
    want = rows.select("position", "row_key").distinct().collect()
    assert len(got) == len({tuple(r) for r in got}) == sum(r.position for r in want)


def test_no_rows_no_trees(spark):
    rows = B.position_rows(_wide(spark, 5), SPLITS, {})
    found = B.binned_rows(rows)
    models = B.fit_grid(rows, FAST, found)
    assert models.count() == 0
    assert B.score_grid(rows, models, G.interp_pairs(SPLITS), found=found).count() == 0
