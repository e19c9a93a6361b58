"""The training table reads every edition under its own spelling, in one pruned scan."""

import re

from conftest import SF_MID
from pyspark.sql import functions as F

from racelens.operators import training_table as T
from racelens.plans.context import Ctx
from racelens.plans.queries import _training_long
from racelens.sources import wide as W


def test_odd_editions_have_values(spark):
    c = Ctx(spark, SF_MID)
    t = _training_long(c).filter("req_key = 'b4-1'")
    by = {r["split"]: r for r in t.groupBy("split").agg(F.count("*").alias("rows"), F.count("secs").alias("n")).collect()}
    assert by["km_5_0"]["n"] == by["km_5_0"]["rows"] > 0
    assert 0 < by["km_40_0"]["n"] < by["km_40_0"]["rows"]
    # the only edition of this request is odd: its values are those of the wide table's rows
    wide = c.wide.join(c.selection.filter("req_key = 'b4-1'").select("race_id", "event_id"), ["race_id", "event_id"])
    assert sorted(r[0] for r in t.filter("split = 'km_10_0' and secs is not null").select("secs").collect()) == \
        sorted(r[0] for r in wide.filter("km_10 is not null").select("km_10").collect())


def test_one_pruned_scan(spark):
    c = Ctx(spark, SF_MID)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _training_long(c)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.split("\n") if "FileScan parquet" in x and "race_id" in x]
    assert len(scans) == 1 and re.search(r"PartitionFilters: \[[^\]]*race_id#\d+ (IN|=)", scans[0])
    read = re.search(r"ReadSchema: struct<([^>]*)", scans[0])[1]
    assert set(re.findall(r"km_[0-9_]+", read)) == set(c.sources) and "km_5_0" in c.sources and "km_45" not in c.sources


def test_projection_of_every_request(spark):
    c = Ctx(spark, SF_MID)
    p = T.training_projection_keyed(c.history_rows, c.selection, c.plan, c.valid, c.sources).collect()
    keys = {r["req_key"] for r in c.selection.select("req_key").collect()}
    assert {r["req_key"] for r in p} == keys and len(keys) > 20
    first = next(r for r in p if r["req_key"] == "b4-0")
    assert first["split_names"] == "km_5,km_20,km_10.00,km_7,km_12.5,half"
    assert all(len(r["split_names"].split(",")) == len(r["split_secs"].split(",")) for r in p)


def test_stored_columns_and_no_selection(spark):
    c = Ctx(spark, SF_MID)
    names = W.stored_splits(spark, c.stored)
    assert {"km_5", "km_5_0", "km_20", "km_20_0"} <= set(names)
    assert W.read_declared(spark, c.stored, ["km_5"], []).count() == 0
    none = T.training_table(W.read_declared(spark, c.stored, [], []), c.selection.limit(0), c.plan, c.valid, [])
    assert none.count() == 0
