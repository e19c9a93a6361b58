"""Rows of the grid packed into blocks: every value comes back, and the evaluation needs no stored wide table."""

import datetime
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from racelens.operators import blocks as BL
from racelens.operators.training import GradedRun, InterpolationRun
from racelens.plans.queries_train import TCtx, q_error_metrics
from racelens.sources import fixtures as X

NAMES = ["km_5", "km_10", "km_15", "km_20"]


def test_blocks_hold_every_value(monkeypatch):
    """Nulls within and behind the leading splits, blocks that end within a batch."""
    monkeypatch.setattr(BL, "BLOCK_ROWS", 7)
    rnd, rows = random.Random(1), []
    for i in range(40):
        v = [1000.0 * i + k if rnd.random() < 0.8 else None for k in range(rnd.randrange(1, 5))]
        rows.append({"fold": i % 5, "lead": next((k for k, x in enumerate(v) if x is None), len(v)), "age": 20.0 + i, "gender": float(i % 2), "v": v})
    schema = pa.schema([("fold", pa.int32()), ("lead", pa.int32()), ("age", pa.float64()), ("gender", pa.float64()), ("v", pa.list_(pa.float64()))])
    batches = [pa.RecordBatch.from_pylist(rows[a:a + 9], schema) for a in range(0, 40, 9)]
    packed = list(BL._pack(iter(batches), 4))
    assert [b.column(0)[0].as_py() for b in packed] == [7] * 5 + [5]
    got = []
    for b in BL.read_blocks(iter(packed), 4):
        assert (np.diff(b.lead) <= 0).all()
        got += [(int(f), int(m), a, g, [None if np.isnan(x) else x for x in v]) for f, m, a, g, v in zip(b.fold, b.lead, b.age.tolist(), b.gender.tolist(), b.v.T.tolist(), strict=True)]
    want = [(r["fold"], r["lead"], r["age"], r["gender"], r["v"] + [None] * (4 - len(r["v"]))) for r in rows]
    assert sorted(map(str, got)) == sorted(map(str, want))


def _wide(spark, gap):
    """Rows without an age and without a finisher; with ``gap`` the second split is empty."""
    rnd = random.Random(4)
    rows = []
    for i in range(600):
        secs = [1000.0 * (k + 1) + rnd.gauss(0, 60) if k < 1 + i % 4 and not (gap and k == 1) else None for k in range(4)]
        rows.append((None if i % 29 == 0 else i, "M" if i % 2 else "female", None if i % 13 == 0 else 20 + i % 40, *secs, 4 if i == 29 else 1 + i % 4))
    return spark.createDataFrame(rows, "finisher_id long, gender string, age int, km_5 double, km_10 double, km_15 double, km_20 double, _legs int")


@pytest.mark.parametrize("gap,guess", [(False, 4), (False, 2), (True, 4)])
def test_graded_run_gives_what_the_run_over_the_table_gives(spark, gap, guess):
    wide = _wide(spark, gap)
    calls = []

    def table(n):
        calls.append(n)
        return wide.select("finisher_id", "gender", "age", *NAMES[:n], "_legs")

    got, want = GradedRun(table, guess), InterpolationRun(wide.filter("finisher_id is not null").withColumn("athlete_id", F.lit("a")).drop("_legs"))
    assert got.splits == want.splits and got.legs == 4 and set(calls[1:]) <= {guess, 4}
    for a, b in ((got.counts, want.counts), (got.evaluation, want.evaluation)):
        a, b = ({r["model_id" if "model_id" in r else "pair_id"]: r.asDict() for r in x.collect()} for x in (a, b))
        assert set(a) == set(b) and a
        for k, row in b.items():
            assert all(x == a[k][c] or abs(x - a[k][c]) < 1e-6 * max(1.0, abs(x)) for c, x in row.items()), (k, row, a[k])


def test_graded_run_without_rows(spark):
    run = GradedRun(lambda n: _wide(spark, False).limit(0).select("finisher_id", "gender", "age", *NAMES[:n], "_legs"), 4)
    assert run.splits == [] and run.legs == 0 and run.evaluation.count() == 0 and run.counts.count() == 0


def _tables(spark, path, longest=6):
    day = datetime.datetime(2001, 1, 1)
    legs = [(i, j) for i in range(200) for j in range(1 + i % 5)] + [(999, j) for j in range(longest)]
    spark.createDataFrame([(i, j, 1, 1, float((i * 7 + j * 3) % 50), float(j % 2), day + datetime.timedelta(days=j // 2)) for i, j in legs],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 7, day, "1-URGENT") for i in range(200)], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(i, "AUTO") for i in range(7)], "c_custkey long, c_mktsegment string").write.parquet(f"{path}/customer.parquet")


@pytest.mark.parametrize("guess", [24, 4])
def test_evaluation_stores_blocks_alone(spark, tmp_path, monkeypatch, guess):
    """The query's figures come without the wide table, which the run over it has to store; the longest order has no finisher."""
    _tables(spark, tmp_path)
    monkeypatch.setattr(X, "GUESS_LEGS", guess)
    c = TCtx(spark, str(tmp_path))
    want = {r["pair_id"]: r for r in c.interp.metrics.collect()}
    X._leg_counts.clear()
    with monkeypatch.context() as m:
        m.setattr(X, "stored_wide", None)
        found = q_error_metrics(spark, str(tmp_path)).collect()
    assert X.known_legs(spark, str(tmp_path)) == 6
    ids = {r["pair_id"]: r["model_id"] for r in c.interp.pair_df.collect()}
    found = {r["model_id"]: r for r in found}
    assert {ids[p] for p in want} == set(found) and len(found) == 10
    for p, r in want.items():
        assert found[ids[p]]["n"] == r["n"] and abs(found[ids[p]]["mae"] - r["mae"]) < 1e-3


def test_price_takes_no_part_in_the_order_of_legs(spark, tmp_path):
    """Legs that differ in the price alone have equal seconds in either order: it is neither shuffled nor sorted."""
    _tables(spark, tmp_path)
    legs = X.race_legs(spark, str(tmp_path))
    assert "l_extendedprice" not in legs._jdf.queryExecution().executedPlan().toString()
    want = X.race_legs_ranged(spark, str(tmp_path)).withColumn("secs", F.round("secs", 6))
    assert sorted(map(str, legs.withColumn("secs", F.round("secs", 6)).collect())) == sorted(map(str, want.collect()))
