"""What one task sorts does not grow with the table."""

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from racelens.operators import training_table as T
from racelens.sources import fixtures as X
from racelens.sources import reuse as R


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_table_is_cut_by_line_items(spark, tmp_path, monkeypatch):
    """the tasks that sort line items grow with their number, and every leg stays."""
    monkeypatch.setattr(X, "TASK_LEGS", 100)
    spark.range(6000).select((F.col("id") % 900).alias("l_orderkey"), F.col("id").cast("int").alias("l_linenumber"), F.col("id").alias("l_partkey"),
                             F.col("id").alias("l_suppkey"), F.lit(1.0).alias("l_quantity"), F.lit(2.0).alias("l_extendedprice"),
                             F.current_timestamp().alias("l_shipdate")).write.parquet(str(tmp_path / "lineitem.parquet"))
    legs = X.race_legs(spark, str(tmp_path))
    assert legs.rdd.getNumPartitions() == 60 and legs.count() == 6000


def test_preview_keeps_the_first_rows_of_each_before_any_sort(spark):
    """nulls first, NaN last, code point order, ties; the only sorts lie above the step that keeps a few rows."""
    rnd = random.Random(3)
    pool = [None, float("nan"), float("inf"), -1.0, 0.5, 2.0, 7.0]
    rows = [(rnd.choice(["a", "b", None]), rnd.choice(["1", "10", "9", "é", "Z", None]), rnd.randrange(3), rnd.choice(pool)) for _ in range(4000)]
    rows += [("c", "x", 1, float("nan")), ("c", "x", 1, float("inf"))]
    df = spark.createDataFrame(rows, "k string, who string, ord int, secs double").repartition(5)
    got = T.preview_each(df, "k", ["who", "ord", "secs"], 4)
    below = _plan(got).split("MapInArrow", 1)[1]
    assert "Sort" not in below and "WindowGroupLimit" not in below
    w = Window.partitionBy("k").orderBy("who", "ord", "secs")
    want = df.withColumn("r", F.row_number().over(w)).filter("r <= 4").drop("r")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_training_table_is_cut_by_rows(spark, tmp_path, monkeypatch):
    """one request of 5,000 long rows goes to as many tasks as its rows need, even with one athlete in all of them."""
    monkeypatch.setattr(T, "TASK_ROWS", 500)
    rows = spark.range(1000).select(F.lit("q").alias("req_key"), F.lit("n").alias("nombre"), F.lit("a").alias("athlete_id"), F.lit("1").alias("event_id"),
                                    F.lit("urgent").alias("event_std"), F.lit("M").alias("gender"), F.lit(30).alias("age"),
                                    F.transform(F.sequence(F.lit(1), F.lit(5)), lambda i: F.struct(i.alias("ord"), F.lit("s").alias("split"),
                                                                                                   (F.col("id") + i).cast("double").alias("secs"))).alias("picked"))
    path = T.write_by_request(rows.coalesce(1), 5000, str(tmp_path / "t"))
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_path")).count().collect()
    assert len(files) >= 8 and sum(r["count"] for r in files) == 5000 and max(r["count"] for r in files) <= 1500


def test_reused_tables_are_written_without_a_sort(spark, tmp_path, monkeypatch):
    """the write takes ranges of addresses, no task sorts its rows."""
    seen = []
    cls = type(spark.range(1).write)
    plain = cls.parquet
    monkeypatch.setattr(cls, "parquet", lambda self, path, *a, **k: (seen.append((path, _plan(self._df))), plain(self, path, *a, **k))[1])
    wanted = spark.createDataFrame([("x", "tx"), ("y", "ty")], "address string, table_name string").checkpoint()
    rows = spark.range(3000).select((F.col("id")).alias("finisher_id"), F.when(F.col("id") % 3 == 0, "y").otherwise("x").alias("address"))
    R.reuse_or_write(spark, str(tmp_path / "b"), wanted, rows)
    (plan,) = [p for path, p in seen if path.endswith("/rows")]
    assert "rangepartitioning(address" in plan and "Sort" not in plan
    back = R.read_tables(spark, str(tmp_path / "b"), "finisher_id long")
    assert {r["address"]: r["count"] for r in back.groupBy("address").count().collect()} == {"x": 2000, "y": 1000}
