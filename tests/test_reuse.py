"""Tables by content address; races and dead jobs."""

from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

from pyspark.sql import functions as F

from conftest import SF_SMALL
from racelens.plans import all_oracle_sql, all_queries
from racelens.session import scratch_path
from racelens.sources import reuse as R

ROWS = "n long"


def _inputs(spark, names):
    wanted = spark.createDataFrame([(f"at-{x}", x) for x in names], "address string, table_name string")
    rows = spark.createDataFrame([(f"at-{x}", i) for x in names for i in range(10)], "address string, n long")
    return wanted, rows


def _counts(spark, base):
    return {r["table_name"]: (r["n"], r["d"]) for r in R.read_tables(spark, base, ROWS).groupBy("table_name").agg(
        F.count("n").alias("n"), F.countDistinct("n").alias("d")).collect()}


def test_missing_ones_are_written_others_reused(spark):
    base = scratch_path(spark, "reuse")
    assert _counts(spark, base) == {}
    assert not any(r["reused"] for r in R.reuse_or_write(spark, base, *_inputs(spark, ["a", "b"])).collect())
    got = {r["table_name"]: r["reused"] for r in R.reuse_or_write(spark, base, *_inputs(spark, ["a", "b", "c"])).collect()}
    assert got == {"a": True, "b": True, "c": False}
    wanted, rows = _inputs(spark, ["none"])
    R.reuse_or_write(spark, base, wanted, rows.limit(0))          # a table without rows is there, too
    assert all(r["reused"] for r in R.reuse_or_write(spark, base, wanted, rows).collect())
    assert _counts(spark, base) == {x: (10, 10) for x in "abc"}


def test_race_and_dead_job(spark, monkeypatch):
    base, gate, look = scratch_path(spark, "reuse-race"), Barrier(2), R.registered

    def both_look_first(spark, at):
        found = look(spark, at)
        gate.wait(60)
        return found
    wanted, rows = _inputs(spark, ["a", "b"])
    with monkeypatch.context() as m, ThreadPoolExecutor(2) as pool:
        m.setattr(R, "registered", both_look_first)
        states = list(pool.map(lambda _: R.reuse_or_write(spark, base, wanted, rows).collect(), range(2)))
    assert not any(r["reused"] for s in states for r in s)        # both wrote
    assert len(R._committed(spark, base)) == 2
    assert _counts(spark, base) == {x: (10, 10) for x in "ab"}    # and each table is read once
    with monkeypatch.context() as m:
        m.setattr(R, "_commit", lambda *_: None)                  # dies before its marker
        R.reuse_or_write(spark, base, *_inputs(spark, ["z"]))
    assert _counts(spark, base) == {x: (10, 10) for x in "ab"}


def test_snapshot_follows_the_files(spark):
    path = scratch_path(spark, "snap")
    spark.range(5).write.parquet(path)
    before = R.snapshot(spark, path)
    assert R.snapshot(spark, path) == before
    spark.range(5).write.mode("append").parquet(path)
    assert R.snapshot(spark, path) != before


def test_query_equals_sql(spark, duck):
    got = all_queries()["reuse_if_exists"](spark, SF_SMALL)
    cols = sorted(got.columns)
    con = duck(SF_SMALL)
    want = con.execute(f"SELECT {', '.join(cols)} FROM ({all_oracle_sql()['reuse_if_exists']})").fetchall()
    assert sorted(map(tuple, got.select(*cols).collect())) == sorted(want) and len(want) > 5
