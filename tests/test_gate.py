"""Quality gate on the analysed system's test vectors (exact numbers)."""

# fixed values in this file: the input lists of the analysed system's gate tests
import math

from racelens.operators import evaluate as E


def _gate(spark, y, pred):
    df = spark.createDataFrame([(1, float(a), float(b)) for a, b in zip(y, pred)], "pair_id int, y double, pred double")
    return E.gate(df).first().asDict()


def _levels(spark, errors):
    return _gate(spark, errors, [0.0] * len(errors))


def test_good_model(spark):
    g = _gate(spark, [100, 200, 300, 400, 500], [105, 195, 305, 395, 505])
    assert g["mae_naive"] == 120 and g["mae"] == 5
    assert math.isclose(g["improvement"], 0.958333, abs_tol=1e-6)
    assert g["cv"] == 0 and g["p50"] == 5 and g["p95"] == 5 and g["ratio"] == 1
    assert g["pass_naive"] and g["pass_consistency"] and g["pass_outliers"]
    assert g["score"] == 100 and g["approved"] and g["status"] == "PendingManualApproval"


def test_reversed_model(spark):
    g = _gate(spark, [100, 200, 300, 400, 500], [500, 400, 300, 200, 100])
    assert g["mae"] == 240 and math.isclose(g["improvement"], -1.0)
    assert math.isclose(g["cv"], 0.623610, abs_tol=1e-6) and not g["pass_consistency"]
    assert g["p50"] == 200 and g["p95"] == 400 and g["ratio"] == 2.0 and g["pass_outliers"]
    assert not g["pass_naive"]
    assert g["score"] == 35 and not g["approved"] and g["status"] == "Rejected"


def test_consistent_errors(spark):
    g = _levels(spark, [25, 28, 30, 32, 35, 38, 40, 42, 45, 48])
    assert math.isclose(g["mae"], 36.3) and math.isclose(g["std_error"], 7.197916, abs_tol=1e-6)
    assert math.isclose(g["cv"], 0.198290, abs_tol=1e-6) and g["pass_consistency"]
    assert g["p50"] == 36.5 and math.isclose(g["p95"], 46.65) and math.isclose(g["ratio"], 1.278082, abs_tol=1e-6)
    assert g["pass_outliers"]


def test_inconsistent_errors(spark):
    g = _levels(spark, [5, 10, 15, 20, 25, 30, 35, 200, 250, 300])
    assert math.isclose(g["cv"], 1.214263, abs_tol=1e-6) and not g["pass_consistency"]
    assert math.isclose(g["ratio"], 10.090909, abs_tol=1e-6) and not g["pass_outliers"]


def test_outlier_errors(spark):
    g = _levels(spark, [25, 28, 30, 32, 35, 38, 40, 42, 200, 250])
    assert math.isclose(g["cv"], 1.076062, abs_tol=1e-6) and not g["pass_consistency"]
    assert math.isclose(g["p95"], 227.5) and math.isclose(g["ratio"], 6.232877, abs_tol=1e-6)
    assert not g["pass_outliers"]


def test_constant_target(spark):
    g = _gate(spark, [7, 7, 7], [7, 7, 8])
    assert g["mae_naive"] == 0 and g["improvement"] is None and not g["pass_naive"]
    assert not g["approved"]
