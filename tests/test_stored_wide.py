"""The training table is stored from one shuffle of the line items, with all splits of the longest order."""

import datetime

import pytest

from racelens.operators.training import PredictionRun
from racelens.plans.queries_train import TCtx
from racelens.sources import fixtures as X


def _tables(spark, path, longest):
    """Orders of 1 to 5 legs; the longest one, and the legs without a key, belong to no finisher."""
    day = datetime.datetime(2001, 1, 1)
    legs = [(i, j) for i in range(40) for j in range(1 + i % 5)] + [(99, j) for j in range(longest)] + [(None, j) for j in range(3)]
    spark.createDataFrame([(i, j, 1, 1, float(j), 1.0, day + datetime.timedelta(days=j)) for i, j in legs],
                          "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz") \
        .write.parquet(f"{path}/lineitem.parquet")
    spark.createDataFrame([(i, i % 7, day, "1-URGENT") for i in [*range(40), 3]], "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz, o_orderpriority string") \
        .write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(i, "AUTO") for i in range(7)], "c_custkey long, c_mktsegment string").write.parquet(f"{path}/customer.parquet")


@pytest.mark.parametrize("longest,guess", [(6, 24), (6, 4), (2, 24)])
def test_same_rows_as_the_wide_table_without_a_count_before(spark, tmp_path, monkeypatch, longest, guess):
    """No pass over the orders to count legs; orders without a finisher count, twice given ones stay twice."""
    _tables(spark, tmp_path, longest)
    count, sf = X.leg_count, str(tmp_path)
    monkeypatch.setattr(X, "leg_count", None)
    monkeypatch.setattr(X, "GUESS_LEGS", guess)
    columns = ["finisher_id", "athlete_id", "gender", "age"]
    for run in ("a", "b"):      # the second knows the longest order
        got = X.stored_wide(spark, sf, columns, f"{sf}/{run}")
        assert got.columns == [*columns, *[f"km_{5 * k}" for k in range(1, max(longest, 5) + 1)]]
        monkeypatch.setattr(X, "leg_count", count)
        want = X.race_wide(spark, sf).select(got.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect())) and got.count() == 41
    X._leg_counts.clear()
    assert X.leg_count(spark, sf) == max(longest, 5)


def test_training_table_has_no_columns_that_no_run_reads(spark, tmp_path):
    _tables(spark, tmp_path, 6)
    c = TCtx(spark, str(tmp_path))
    assert {"race_id", "event_id", "event_std"}.isdisjoint(c.training.columns) and c.interp.wide is c.training
    assert {"race_id", "event_id"} <= set(c.wide.columns)


def test_evaluation_of_the_prediction_grid_stores_held_out_rows_alone(spark, tmp_path):
    _tables(spark, tmp_path, 6)
    run = PredictionRun(TCtx(spark, str(tmp_path)).training)
    held = run.wide.filter("athlete_id in ('" + "','".join(r[0] for r in run.rows.filter("holdout").select("athlete_id").distinct().collect()) + "')")
    assert run.grid_rows.count() == held.filter("km_5 is not null").count() < run.wide.count()
