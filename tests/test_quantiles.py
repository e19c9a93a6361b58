"""Bounded-memory exact quantiles equal Spark's exact percentile."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from racelens.operators import quantiles as QQ
from racelens.operators.training import InterpolationRun, PredictionRun
from racelens.sources import fixtures as X

PROBS = [0.1, 0.25, 0.5, 0.9, 0.95, 0.99]


def test_bracket_equals_exact_with_ties_and_tiny_groups(spark):
    rnd = random.Random(7)
    rows = [(0, 3.0)] + [(1, float(x)) for x in (1, 9)] + \
           [(2, float(rnd.choice([5, 5, 5, rnd.randint(0, 40)]))) for _ in range(500)] + \
           [(3, rnd.gauss(0, 1)) for _ in range(5000)]
    df = spark.createDataFrame(rows, "g int, v double")
    a = {r["g"]: r for r in QQ.grouped_quantiles(df, ["g"], "v", PROBS, "exact").collect()}
    b = {r["g"]: r for r in QQ.grouped_quantiles(df, ["g"], "v", PROBS, "bracket", accuracy=500).collect()}
    assert set(a) == set(b)
    for g in a:
        for i in range(len(PROBS)):
            assert abs(a[g][f"q{i}"] - b[g][f"q{i}"]) < 1e-9


def test_gate_and_quantiles_same_in_both_modes(spark):
    wide = X.race_wide(spark, SF_SMALL)
    ex = InterpolationRun(wide, quantile_mode="exact").gates.orderBy("pair_id").collect()
    br = InterpolationRun(wide, quantile_mode="bracket").gates.orderBy("pair_id").collect()
    assert [(r["pair_id"], round(r["p50"], 9), round(r["p95"], 9), r["score"]) for r in ex] == \
           [(r["pair_id"], round(r["p50"], 9), round(r["p95"], 9), r["score"]) for r in br]
    qe = PredictionRun(wide, quantile_mode="exact").quantiles.orderBy("pair_id").collect()
    qb = PredictionRun(wide, quantile_mode="bracket").quantiles.orderBy("pair_id").collect()
    assert [tuple(round(x, 9) for x in r[1:]) for r in qe] == [tuple(round(x, 9) for x in r[1:]) for r in qb]
    assert F is not None


def test_two_measures_in_one_run(spark):
    """Every measure with its own probabilities, beside aggregates; nulls, constant, tiny and value-less groups."""
    rnd = random.Random(11)
    rows = [(0, None, 1.0), (0, None, None)] + [(1, 7.0, float(i)) for i in range(30)] + [(2, -1.5, 4.0)] + \
           [(3, rnd.expovariate(1.0), None if i % 3 else rnd.gauss(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(rows, "g int, a double, b double")
    specs = [("qa", "a", [0.0, 0.5, 0.95, 1.0]), ("qb", "b", [0.1, 0.9])]
    got = QQ.exact_quantiles(df, ["g"], specs, [F.count(F.lit(1)).alias("n"), F.sum("a").alias("total")], accuracy=1000)
    assert got.columns == ["g", "n", "total", "qa", "qb"]
    want = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"), *[F.percentile(c, p).alias(s) for s, c, p in specs])
    want = {r.g: r for r in want.collect()}
    got = {r.g: r for r in got.collect()}
    assert set(got) == set(want)
    for g, w in want.items():
        assert got[g].n == w.n
        for s, _, probs in specs:
            assert [x is None for x in got[g][s]] == [x is None for x in (w[s] or [None] * len(probs))]
            assert all(abs(x - y) < 1e-9 for x, y in zip(got[g][s], w[s] or [], strict=False) if x is not None)


def test_the_grid_is_expanded_once(spark):
    """Metrics and gate read stored predictions; no plan behind them expands pairs again."""
    run = InterpolationRun(X.race_wide(spark, SF_SMALL))
    run.summary
    for df in (run.metrics, run.gates, run.cv_rows):
        assert "Generate" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert run.evaluation._jdf.queryExecution().optimizedPlan().toString().count("Generate") == 0
