"""Physical plans: pruning reaches the scan, the large side is not shuffled."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from racelens.operators import training_table as T
from racelens.plans.context import Ctx
from racelens.session import scratch_path
from racelens.sources import fixtures as X
from racelens.sources import wide as W


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_partition_filters_on_chosen_pairs(spark):
    c = Ctx(spark, SF_SMALL)
    path = W.write_partitioned(c.wide, scratch_path(spark, "wide-test"))
    df = W.read_declared(spark, path, X.wide_split_names(X.leg_count(spark, SF_SMALL)), [("automobile-2000", "1"), ("automobile-2000", "2")])
    p = _plan(df.groupBy("race_id").count())
    assert "PartitionFilters: [" in p and "automobile-2000" in p.split("PartitionFilters: [")[1].split("]")[0]
    assert df.select("race_id").distinct().count() <= 1


def test_column_pruning_and_pushdown(spark):
    df = spark.read.parquet(f"{SF_SMALL}/orders.parquet").filter(F.col("o_custkey") < 10).select("o_orderkey")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_custkey), LessThan(o_custkey,10)]" in p
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in p


def test_result_filter_broadcasts_selection(spark):
    c = Ctx(spark, SF_SMALL)
    rows = T.result_filter(c.wide, c.selection, c.valid, n_requests=100)
    p = _plan(rows)
    assert "BroadcastHashJoin" in p


def test_unbounded_selection_is_not_broadcast(spark):
    c = Ctx(spark, SF_SMALL)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = T.result_filter(c.wide, c.selection, c.valid, n_requests=10_000_000)
        assert "BroadcastHashJoin" not in _plan(rows)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lineitem_shuffled_once_for_wide(spark):
    p = _plan(X.race_wide(spark, SF_SMALL))
    # one exchange keyed by the order key feeds window, pivot and join
    assert p.count("hashpartitioning(l_orderkey") == 1


def test_every_leg_is_in_the_wide_table(spark):
    """Line items in, non-null cells out."""
    wide = X.race_wide(spark, SF_SMALL)
    cells = wide.select([F.count(c).alias(c) for c in wide.columns if c.startswith("km_")]).first()
    assert sum(cells) == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()


def test_hot_race_is_written_by_many_tasks(spark, tmp_path):
    """All rows in one (race, event): the finisher ranges still spread them over files."""
    wide = X.race_wide(spark, SF_SMALL).withColumns({"race_id": F.lit("hot-2000"), "event_id": F.lit("1")})
    W.write_partitioned(wide, str(tmp_path))
    assert len(list((tmp_path / "race_id=hot-2000" / "event_id=1").glob("*.parquet"))) >= 4


def test_ranged_legs_equal_window_legs(spark):
    """The hot-order-safe leg numbering equals the per-order window, also when
    many small ranges make orders span several of them."""
    a = X.race_legs(spark, SF_SMALL)
    for n in (8, 997):
        b = X.race_legs_ranged(spark, SF_SMALL, n_ranges=n)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_no_cartesian_or_python_in_key_plans(spark):
    import __spark_entry__ as E
    q = E.queries()
    for key in ["training_table", "split_plan", "closest_split", "split_equivalent", "error_metrics",
                "training_row_report", "extrapolated_metrics"]:
        p = _plan(q[key](spark, SF_SMALL))
        assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p, key
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key
