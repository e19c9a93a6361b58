"""Evaluation aggregates and the three-level quality gate.

Inputs are prediction rows (pair_id, y, pred). Every statistic is a
``groupBy(pair_id)`` aggregate. The naive predictor needs the pair mean
first: a per-pair table (bounded by the grid size) is broadcast back.
Quantile modes: 'exact' uses Spark's ``percentile`` inline; 'bracket' gives
the same numbers with bounded memory per pair (see ``quantiles``); 'approx'
uses ``percentile_approx``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from racelens.operators.quantiles import exact_quantiles

# --- fixed values of the gate -----------------------------------------------
CV_MAX = 0.5                 # level 2 passes when CV <= 0.5
RATIO_MAX = 3.0              # level 3 passes when p95 / p50 <= 3.0
L1_POINTS, L2_POINTS, L3_POINTS = 40, 30, 30
L1_BONUS = ((0.3, 10), (0.1, 5))      # improvement >  threshold
L2_BONUS = ((0.3, 10), (0.4, 5))      # CV          <  threshold
L3_BONUS = ((2.0, 10), (2.5, 5))      # ratio       <  threshold
SCORE_CAP = 100
REGISTER_MIN_SCORE = 60
STATUS_APPROVED, STATUS_REJECTED = "PendingManualApproval", "Rejected"
REL_EPS = 1e-6               # relative error denominator: y + 1e-6
ERROR_PERCENTILES = (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)
# ----------------------------------------------------------------------------


def _aggregated(df: DataFrame, keys: list[str], aggs: list[Column], specs, mode) -> DataFrame:
    """keys..., the aggregates and per spec (name, column, probabilities) an array of quantiles."""
    if mode == "bracket":
        return exact_quantiles(df, keys, specs, aggs)
    pct = F.percentile if mode == "exact" else F.percentile_approx
    return df.groupBy(*keys).agg(*aggs, *[pct(F.col(c), list(probs)).alias(name) for name, c, probs in specs])


def summaries(pred: DataFrame, keys=("pair_id",), exact="exact") -> DataFrame:
    """What E1 and the gate need, per group, in one run over the errors: ``pred`` is read
    once for the mean and then by the quantile run, so materialise it first."""
    keys = list(keys)
    means = pred.groupBy(*keys).agg(F.avg("y").alias("mean_y"))
    e = F.col("y") - F.col("pred")
    df = pred.join(F.broadcast(means), keys).select(
        *keys, "y", e.alias("e"), F.abs(e).alias("ae"), F.abs(F.col("y") - F.col("mean_y")).alias("ane"),
        (F.abs(e / (F.col("y") + F.lit(REL_EPS))) * 100).alias("rel"))
    mse = F.avg(F.col("e") * F.col("e"))
    aggs = [F.count(F.lit(1)).alias("n"), F.avg("ae").alias("mae"), F.avg("ane").alias("mae_naive"), F.sqrt(mse).alias("rmse"),
            F.when(F.var_pop("y") > 0, 1 - mse / F.var_pop("y")).alias("r2"), F.max("ae").alias("max_error"),
            F.min("ae").alias("min_error"), F.stddev_pop("ae").alias("std_error"), F.avg("rel").alias("mape")]
    return _aggregated(df, keys, aggs, [("errors", "ae", list(ERROR_PERCENTILES)), ("relative", "rel", [0.5, 0.95])], exact)


def metrics_of(s: DataFrame, keys=("pair_id",)) -> DataFrame:
    """E1 from the summaries: n, mae, rmse, r2, max, min, std, percentiles of |e|,
    mape, median and p95 relative error (%)."""
    names = ["q1_error", "median_error", "q3_error", "p90_error", "p95_error", "p99_error"]
    return s.select(*keys, "n", "mae", "rmse", "r2", "max_error", "min_error", "std_error",
                    *[F.col("errors")[i].alias(n) for i, n in enumerate(names)], "mape",
                    F.col("relative")[0].alias("median_rel_error"), F.col("relative")[1].alias("p95_rel_error"))


def gate_of(s: DataFrame, keys=("pair_id",)) -> DataFrame:
    """E3-E6 from the summaries: naive MAE, MAE, improvement, CV, p50, p95, ratio,
    three pass flags, score and approval."""
    p50, p95 = (F.col("errors")[ERROR_PERCENTILES.index(p)].alias(f"p{100 * p:.0f}") for p in (0.5, 0.95))
    return s.select(*keys, "n", "mae_naive", "mae", "std_error", p50, p95).transform(score_levels)


def error_metrics(pred: DataFrame, keys=("pair_id",), exact="exact") -> DataFrame:
    return metrics_of(summaries(pred, keys, exact), keys)


def gate(pred: DataFrame, keys=("pair_id",), exact="exact") -> DataFrame:
    return gate_of(summaries(pred, keys, exact), keys)


def score_levels(a: DataFrame) -> DataFrame:
    """E3-E7 from per-pair summaries (mae_naive, mae, std_error, p50, p95)."""
    l1 = F.col("mae") < F.col("mae_naive")
    improvement = F.when(F.col("mae_naive") > 0, (F.col("mae_naive") - F.col("mae")) / F.col("mae_naive"))
    cv = F.when(F.col("mae") > 0, F.col("std_error") / F.col("mae")).otherwise(F.lit(float("inf")))
    ratio = F.when(F.col("p50") > 0, F.col("p95") / F.col("p50")).otherwise(F.lit(float("inf")))
    a = a.select("*", F.coalesce(l1 & (F.col("mae_naive") > 0), F.lit(False)).alias("pass_naive"),
                 improvement.alias("improvement"), cv.alias("cv"), ratio.alias("ratio"))
    a = a.withColumn("pass_consistency", F.col("cv") <= CV_MAX).withColumn("pass_outliers", F.col("ratio") <= RATIO_MAX)

    def bonus(val: Column, table, greater: bool) -> Column:
        (t1, b1), (t2, b2) = table
        c1, c2 = (val > t1, val > t2) if greater else (val < t1, val < t2)
        return F.when(c1, b1).when(c2, b2).otherwise(0)

    s1 = F.when(F.col("pass_naive"), L1_POINTS + bonus(F.col("improvement"), L1_BONUS, True)).otherwise(0)
    s2 = F.when(F.col("pass_consistency"), L2_POINTS + bonus(F.col("cv"), L2_BONUS, False)).otherwise(0)
    s3 = F.when(F.col("pass_outliers"), L3_POINTS + bonus(F.col("ratio"), L3_BONUS, False)).otherwise(0)
    a = a.withColumn("score", F.least(F.lit(SCORE_CAP), s1 + s2 + s3).cast("int"))
    a = a.withColumn("approved", F.col("pass_naive") & F.col("pass_consistency") & F.col("pass_outliers"))
    return a.withColumn("status", approval_status(F.col("approved"), F.col("score")))


def approval_status(approved: Column, score: Column) -> Column:
    """Registration status."""
    return F.when(approved & (score >= REGISTER_MIN_SCORE), STATUS_APPROVED).otherwise(STATUS_REJECTED)
