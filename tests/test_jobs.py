"""The three batch jobs run end to end and write their outputs."""

import os

import pytest

from conftest import SF_SMALL
from racelens import jobs as J
from racelens.session import scratch_path
from racelens.sources import fixtures as X


def test_jobs_end_to_end(spark):
    out = scratch_path(spark, "jobs-test").replace("file:", "")
    wide = X.race_wide(spark, SF_SMALL)
    outcomes = J.training_table_job(spark, wide, X.race_catalog(spark, SF_SMALL), X.raw_requests(spark, SF_SMALL),
                                    X.wide_split_names(X.leg_count(spark, SF_SMALL)), out + "/table", "20260303-085722", strict=False)
    assert outcomes.get("success", 0) > 0 and outcomes.get("failure", 0) > 0
    data = spark.read.parquet(out + "/table/data")
    assert data.count() > 0 and "req_key" in data.columns
    assert spark.read.json(out + "/table/manifests").count() == outcomes["success"]
    stats = J.interpolation_job(spark, wide, out + "/interp")
    assert stats["total_evaluados"] + stats["insuficientes"] == stats["pairs"]
    assert os.path.isdir(out + "/interp/metricas_modelos")
    pstats = J.prediction_job(spark, wide, out + "/pred")
    assert pstats["total_evaluados"] == pstats["aprobados"] + pstats["rechazados"]


def test_strict_batch_fails_on_unknown_kind(spark):
    with pytest.raises(ValueError, match="tipo_modelo"):
        J.training_table_job(spark, X.race_wide(spark, SF_SMALL), X.race_catalog(spark, SF_SMALL),
                             X.raw_requests(spark, SF_SMALL), X.wide_split_names(X.leg_count(spark, SF_SMALL)),
                             scratch_path(spark, "strict").replace("file:", ""), "20260303-085722")
