"""History selection and split plan on the derived catalog (FIXTURES B4)."""

from pyspark.sql import functions as F

from conftest import SF_MID
from racelens.plans.context import Ctx


def test_plan_of_first_request(spark):
    c = Ctx(spark, SF_MID)
    rows = {r["split"]: r for r in c.plan.filter(F.col("req_key") == "b4-0").collect()}
    expect = {"km_5": ("direct", "km_5", 0.0), "km_20": ("direct", "km_20", 0.0),
              "km_10_00": ("direct", "km_10", 0.0), "km_7": ("interpolate", "km_5", 2.0),
              "km_12_5": ("interpolate", "km_10", 2.5), "half": ("interpolate", "km_20", 1.0975),
              "checkpoint": ("impossible", None, None)}
    assert set(rows) == set(expect)
    for k, (kind, src, diff) in expect.items():
        assert rows[k]["kind"] == kind and rows[k]["source"] == src
        assert (diff is None and rows[k]["diff_km"] is None) or abs(rows[k]["diff_km"] - diff) < 1e-9
    assert rows["km_20"]["alias"] == "km_20" and rows["km_10_00"]["alias"] == "km_10.00"
    assert rows["km_10_00"]["sources"] == ["km_10_00", "km_10", "km_10_0"]


def test_selection_newest_five(spark):
    c = Ctx(spark, SF_MID)
    sel = c.selection.filter(F.col("req_key") == "b4-0").orderBy("rank").collect()
    assert [(r["race_id"], r["event_id"]) for r in sel] == [("automobile-2000", e) for e in "12345"]
    exact = {r["req_key"]: r for r in c.selection.filter(F.col("req_key") == "b4-1").collect()}
    assert exact and {r["race_id"] for r in exact.values()} == {"building-1995"}


def test_failures_and_dedupe(spark):
    c = Ctx(spark, SF_MID)
    keys = {r["req_key"] for r in c.selection.select("req_key").distinct().collect()}
    assert "b4-2" not in keys and "b4-3" not in keys and "b4-4" not in keys   # no edition / unknown / malformed
    dedup = c.plan.filter(F.col("req_key") == "b4-9").select("split").collect()
    assert sorted(r[0] for r in dedup) == ["finish", "half", "km_18_2", "km_5"]
    valid = {r["req_key"] for r in c.valid.collect()}
    assert "b4-10" not in valid and "b4-6" not in valid and "b4-7" not in valid and "b4-5" in valid


def test_training_table_values(spark):
    from racelens.plans.queries import _training_long
    c = Ctx(spark, SF_MID)
    t = _training_long(c).filter(F.col("req_key") == "b4-0")
    by = {r["split"]: r for r in t.groupBy("split").agg(F.count("secs").alias("n"), F.count("*").alias("rows"))
          .collect()}
    assert set(by) == {"km_5", "km_20", "km_10.00", "km_7", "km_12.5", "half"}
    assert by["km_7"]["n"] == 0 and by["half"]["n"] == 0          # interpolated: null until M6
    assert by["km_5"]["n"] == by["km_5"]["rows"] > 0
    assert by["km_20"]["n"] > 0    # the catalog omits 20 km in 2000, the result rows still carry it
