"""Sources and sinks: fallbacks and order-preserving round trips."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from racelens.sources import catalog as C
from racelens.sources import manifests as MF
from racelens.session import scratch_path


def _summary(spark):
    return spark.createDataFrame(
        [("a-2001", 3, 4, 1, 0, 5), ("b-2001", 2, 2, 0, 1, 5)],
        "nombre string, splits long, splits_originales long, splits_interpolados long, splits_imposibles long, "
        "carreras_usadas long")


def test_latest_job_output_branches(spark):
    folder = scratch_path(spark, "job-out")
    MF.write_job_output(MF.job_outputs(_summary(spark), "20260101-000000", "m"), folder, "20260101-000000")
    time.sleep(1.1)
    newer = _summary(spark).withColumn("nombre", F.concat("nombre", F.lit("-x")))
    MF.write_job_output(MF.job_outputs(newer, "20260202-000000", "m"), folder, "20260202-000000")
    exact = MF.latest_job_output(spark, folder, "20260101-000000").collect()
    assert sorted(r["carrera"] for r in exact) == ["a-2001", "b-2001"]
    latest = MF.latest_job_output(spark, folder, "20990101-000000").collect()     # not found: newest file
    assert sorted(r["carrera"] for r in latest) == ["a-2001-x", "b-2001-x"]
    empty_dir = scratch_path(spark, "job-out-empty")
    spark.createDataFrame([], MF.JOB_RECORD_DDL).write.json(empty_dir)
    default = MF.latest_job_output(spark, empty_dir, "20260303-085722", race="r-2020").collect()
    assert len(default) == 1 and default[0]["splits"] == 12 and default[0]["carreras_usadas"] == 1
    assert default[0]["carpeta_modelo"] == "r-2020-20260303-085722"
    assert MF.latest_job_output(spark, folder, None).count() == 0


def test_rewrite_keeps_each_race(spark):
    out = MF.job_outputs(_summary(spark), "19990101-000000", "m")
    fixed = {r["carrera"]: r for r in MF.rewrite_records(out, F.lit("20260303-085722"), "m").collect()}
    assert fixed["a-2001"]["carpeta_modelo"] == "a-2001-20260303-085722"
    assert fixed["b-2001"]["tabla_generada"] == "modelo_b_2001_20260303_085722"
    assert fixed["a-2001"]["data_path"] == "m/modelos/a-2001-20260303-085722/data/"


def test_catalog_document_keeps_order(spark):
    cat = spark.createDataFrame([("z-2000", "1", "urgent", ["km_5"]), ("a-1999", "2", None, ["half", "km_5_0"]),
                                 ("m-2001", "1", "regular", [])],
                                "race_id string, event_id string, event_std string, splits array<string>")
    path = C.write_catalog_document(cat, scratch_path(spark, "cat-doc"))
    back = C.read_catalog_document(spark, path).orderBy("cat_pos").collect()
    assert [r["race_id"] for r in back] == ["a-1999", "m-2001", "z-2000"]        # written sorted by race, event
    assert back[0]["event_std"] is None and back[0]["splits"] == ["half", "km_5_0"]
    assert [r["entry_key"] for r in back] == ["a-1999_2", "m-2001_1", "z-2000_1"]


def test_manifest_read_skips_missing_and_corrupt(spark):
    base = scratch_path(spark, "cands").replace("file:", "")
    spark.createDataFrame([("{broken",)], "value string").coalesce(1).write.text(base + "/p1")
    good = spark.createDataFrame([("r-2020", "ts")], "carrera string, timestamp string")
    good.coalesce(1).write.json(base + "/p2")
    good.withColumn("carrera", F.lit("other")).coalesce(1).write.json(base + "/p3")
    got = MF.manifest_read_first(spark, [base + "/p0", base + "/p1", base + "/p2", base + "/p3"]).collect()
    assert len(got) == 1 and got[0]["carrera"] == "r-2020"
    assert MF.manifest_read_first(spark, [base + "/nothing"]).count() == 0
    assert SF_SMALL


def test_catalog_lines_round_trip(spark):
    from racelens.plans.context import Ctx
    c = Ctx(spark, SF_SMALL)
    path = C.write_catalog_lines(c.catalog, scratch_path(spark, "cat-lines"))
    back = C.read_catalog_lines(spark, path)
    assert back.exceptAll(c.catalog.select(*back.columns)).count() == 0
    assert back.count() == c.catalog.count()


def test_catalog_scan_needs_no_single_document(spark, monkeypatch):
    from racelens.plans import queries_io as IO
    from racelens.plans.context import Ctx
    cat = Ctx(spark, SF_SMALL).catalog
    doc = C.read_catalog_document(spark, C.write_catalog_document(cat, scratch_path(spark, "cat-doc"))).collect()
    few = "spark.sql.adaptive.coalescePartitions.enabled"   # a catalog this small is put into one task otherwise
    was = spark.conf.get(few)
    spark.conf.set(few, "false")
    try:
        path = C.write_catalog_lines(C.positioned(cat, 7), scratch_path(spark, "cat-lines"))
    finally:
        spark.conf.set(few, was)
    lines = C.read_catalog_lines(spark, path, with_position=True)
    assert len(lines.inputFiles()) > 1
    assert [tuple(r) for r in lines.orderBy("cat_pos").select(*doc[0].asDict()).collect()] == [tuple(r) for r in doc]

    def never(*_):
        raise AssertionError("the query writes one document")
    monkeypatch.setattr(C, "write_catalog_document", never)
    assert IO.q_catalog_scan(spark, SF_SMALL).count() == len(doc)
