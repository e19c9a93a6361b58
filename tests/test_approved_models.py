"""A table whose models pass the gate: what is approved is fitted, saved, loaded, applied, extrapolated and reported."""

import random

import pytest
from pyspark.sql import functions as F

from racelens.operators import models as M
from racelens.operators import reports as P
from racelens.operators.training import InterpolationRun
from racelens.session import scratch_path
from racelens.sources import manifests as MF
from racelens.sources.models import load_models, save_models


@pytest.fixture(scope="module")
def run(spark):
    """km_10 is twice km_5 give or take a fixed amount, so its errors hardly vary; km_15 and km_20 wander off with long tails; km_25 has no data."""
    rng = random.Random(3)
    rows = []
    for i in range(600):
        a = 1500.0 + rng.uniform(0, 600)
        b = 2 * a + rng.choice([-40.0, 40.0])
        c = b + rng.lognormvariate(7, 1)
        rows.append((i, str(i % 300), rng.choice("MF"), 20 + i % 40, a, b, c, c + rng.lognormvariate(7, 1), None))
    wide = spark.createDataFrame(rows, "finisher_id long, athlete_id string, gender string, age int, km_5 double, km_10 double, km_15 double, km_20 double, km_25 double")
    return InterpolationRun(wide.checkpoint())


def test_mixed_outcomes_and_final_models(spark, run):
    assert run.splits == ["km_5", "km_10", "km_15", "km_20"]   # the empty split takes no part
    got = {r["model_id"]: r for r in run.evaluation.collect()}
    assert got["km_5_desde_km_10"]["approved"] and not got["km_15_desde_km_20"]["approved"]
    final = run.final_models
    path = save_models(final, scratch_path(spark, "approved"))
    loaded = load_models(spark, path)
    approved = {k for k, r in got.items() if r["approved"]}
    assert {r["model_id"]: r["n_train"] for r in loaded.collect()} == dict.fromkeys(approved, 600)
    before, after = (sorted(map(tuple, run.predict(x).collect())) for x in (final, loaded))
    assert before == after and len(after) == 600 * len(approved)
    errors = [abs(y - p) for i, _, y, p in after if i == got["km_5_desde_km_10"]["pair_id"]]
    assert sum(errors) / len(errors) < 25
    with pytest.raises(FileNotFoundError):
        load_models(spark, path + "-none")


def test_extrapolation_from_approved_sources_only(spark, run):
    plan = spark.createDataFrame([("r", "km_7", "km_5", 5.0, 7.0), ("r", "km_16", "km_15", 15.0, 16.0)],
                                 "req_key string, alias string, source_col string, source_km double, target_km double")
    ev = run.evaluation.select("target", "position", "mae_folds_mean", "mae_folds_std", "score", "improvement", "approved", "n")
    out = {r["model_id"]: r for r in M.extrapolated_metrics(plan, ev).collect()}
    src = {(r["target"], r["position"]): r for r in ev.collect()}
    good, bad = out["km_7_desde_km_10_ext"], out["km_16_desde_km_20_ext"]
    s = src["km_5", "km_10"]
    assert good["trained"] and abs(good["mae"] - s["mae_folds_mean"] * 1.4) < 1e-9 and good["score"] == s["score"] - 10
    assert abs(good["improvement"] - 0.9 * s["improvement"]) < 1e-12 and good["improvement_estimated"] == s["improvement"]
    assert not bad["trained"] and bad["mae"] is None and bad["score"] is None
    preds = run.cv.join(run.pair_df.select("pair_id", "target", "position"), "pair_id").select("target", "position", "row_key", "pred")
    one = M.extrapolate(plan, preds).filter("alias = 'km_7' and position = 'km_10'").agg(F.avg("pred"), F.count("*")).first()
    mean = preds.filter("target = 'km_5' and position = 'km_10'").agg(F.avg("pred")).first()[0]
    assert abs(one[0] - 1.4 * mean) < 1e-6 and one[1] == 600


def test_reports_of_saved_models_are_not_empty(run):
    saved = run.evaluation.filter("approved").select("model_id", F.col("mae_folds_mean").alias("mae"), F.col("mae_folds_std").alias("mae_std"),
                                                     F.col("n").alias("n_samples"), "score")
    n = saved.count()
    assert 0 < n < len(run.pairs)
    assert P.top_models_mae(saved).count() == n and P.top_models_quality(saved).first()["score"] == 100
    assert P.metric_summary(saved).first()["total_muestras"] == 600 * n
    stats = P.validation_stats_interp(run.gates, run.counts).first()
    assert stats["aprobados"] == n and stats["rechazados"] == len(run.pairs) - n
    assert "km_5_desde_km_10" in str(MF.model_index(saved.select("model_id")).first())
