"""Estimators on the pair rows.

* naive mean (M1) and the extrapolation of a source model by the distance
  ratio (M6) are column arithmetic after a per-pair aggregate;
* the prediction job's one-feature line is fitted from numerically stable
  centred moments (``var_pop``, ``covar_pop``, ``avg`` per pair);
* least squares on every feature, for all pairs and folds of the
  interpolation job, is in ``operators.least_squares``.

Boosted trees (M2) are in ``operators.boosting``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values (defaults of the analysed trainers) -----------------------
GBT_INTERP = dict(maxIter=100, maxDepth=10, stepSize=0.05, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=42)
QUANTILES = (0.1, 0.5, 0.9)          # empirical 80 % interval from training residuals
EXTRAPOLATION_PENALTY = 10           # quality points taken from an extrapolated model
EXTRAPOLATION_IMPROVEMENT = 0.9      # conservative factor on the improvement
# ----------------------------------------------------------------------------


def _moments(df: DataFrame, keys: list[str], prefix: str = "") -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(prefix + "n"), F.avg("x").alias(prefix + "mx"), F.avg("y").alias(prefix + "my"),
        (F.var_pop("x") * F.count(F.lit(1))).alias(prefix + "sxx"),
        (F.covar_pop("x", "y") * F.count(F.lit(1))).alias(prefix + "sxy"))


def _line(n, mx, my, sxx, sxy):
    slope = F.when(sxx > 0, sxy / sxx).otherwise(F.lit(0.0))
    return slope, my - slope * mx


def ols_fit(rows: DataFrame, keys=("pair_id",)) -> DataFrame:
    """y = intercept + slope * x per key (all rows)."""
    m = _moments(rows, list(keys))
    slope, icpt = _line(F.col("n"), F.col("mx"), F.col("my"), F.col("sxx"), F.col("sxy"))
    return m.select(*keys, "n", slope.alias("slope"), icpt.alias("intercept"))


def fold_mae(cv_rows: DataFrame) -> DataFrame:
    """M4: MAE per fold, then mean and population std over the folds."""
    per = cv_rows.groupBy("pair_id", "fold").agg(F.avg(F.abs(F.col("y") - F.col("pred"))).alias("mae"))
    return per.groupBy("pair_id").agg(F.avg("mae").alias("mae_folds_mean"),
                                      F.stddev_pop("mae").alias("mae_folds_std"),
                                      F.count(F.lit(1)).alias("k"))


def naive_mean(rows: DataFrame) -> DataFrame:
    """M1: mean of the target per pair."""
    return rows.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.avg("y").alias("mean_y"))


def extrapolate(plan: DataFrame, source_preds: DataFrame) -> DataFrame:
    """M6: a target without data is predicted by the model of its nearest source
    split at the same position, times target_km / source_km. ``source_preds``
    has the source model's predictions (target, position, pred), or any of
    their averages, since the rule is linear."""
    factor = F.col("target_km") / F.nullif(F.col("source_km"), F.lit(0.0))
    return (plan.join(source_preds, plan.source_col == source_preds.target).drop("target")
            .withColumn("factor", factor).withColumn("pred", F.col("pred") * F.col("factor")))


def holdout_fit(rows: DataFrame) -> DataFrame:
    """Prediction job fit: the line per pair on the training athletes only."""
    return ols_fit(rows.filter(~F.col("holdout")))


def line_predict(rows: DataFrame, models: DataFrame) -> DataFrame:
    """The line of each pair applied to its rows (models: one row per pair, bounded by the grid)."""
    return (rows.join(F.broadcast(models.select("pair_id", "slope", "intercept")), "pair_id")
            .withColumn("pred", F.col("intercept") + F.col("slope") * F.col("x")))


def holdout_predict(rows: DataFrame) -> DataFrame:
    return line_predict(rows, holdout_fit(rows))


def residual_quantiles(pred_rows: DataFrame, exact="exact", accuracy: int = 100_000) -> DataFrame:
    """M8: q10, q50, q90 of the TRAINING residuals y - pred per pair.

    'exact' / 'bracket': linear interpolation between order statistics
    ('bracket' with bounded memory per pair, reading the rows three times);
    'approx': percentile_approx."""
    from racelens.operators.quantiles import grouped_quantiles
    mode = "exact" if exact is True else ("approx" if exact is False else exact)
    r = pred_rows.filter(~F.col("holdout")).withColumn("res", F.col("y") - F.col("pred"))
    q = grouped_quantiles(r, ["pair_id"], "res", list(QUANTILES), mode, accuracy)
    return q.select("pair_id", F.col("q0").alias("q10"), F.col("q1").alias("q50"), F.col("q2").alias("q90"))


def interval_predict(pred_rows: DataFrame, quantiles: DataFrame) -> DataFrame:
    """M9: lower / median / upper for the held-out rows."""
    return (pred_rows.filter(F.col("holdout")).join(F.broadcast(quantiles), "pair_id")
            .select("pair_id", "row_key", "athlete_id", "y", "pred",
                    (F.col("pred") + F.col("q10")).alias("lower"),
                    (F.col("pred") + F.col("q50")).alias("median"),
                    (F.col("pred") + F.col("q90")).alias("upper")))


def coverage(intervals: DataFrame) -> DataFrame:
    """Percent of held-out rows inside [lower, upper] (inclusive)."""
    inside = F.when((F.col("y") >= F.col("lower")) & (F.col("y") <= F.col("upper")), 1.0).otherwise(0.0)
    return intervals.groupBy("pair_id").agg((F.avg(inside) * 100).alias("coverage"),
                                            F.count(F.lit(1)).alias("n_test"))


def extrapolated_metrics(plan: DataFrame, source_eval: DataFrame) -> DataFrame:
    """M7: a target without data borrows the model of its nearest source split
    at the same position: MAE and its std scale by target_km / source_km,
    quality loses 10 points (floor 0), improvement x 0.9 (original kept). Only
    an approved source gives a model (``trained``); the metrics of all others
    are null."""
    factor = F.col("target_km") / F.nullif(F.col("source_km"), F.lit(0.0))
    j = plan.join(source_eval, plan.source_col == source_eval.target)
    if_approved = lambda c: F.when(F.col("approved"), c)
    return j.select(
        "req_key", F.concat(F.col("alias"), F.lit("_desde_"), F.col("position"), F.lit("_ext")).alias("model_id"),
        F.col("alias").alias("target"), "position", F.col("source_col").alias("source"), factor.alias("factor"),
        F.col("approved").alias("trained"),
        if_approved(F.col("mae_folds_mean") * factor).alias("mae"), if_approved(F.col("mae_folds_std") * factor).alias("mae_std"),
        if_approved(F.greatest(F.col("score") - F.lit(EXTRAPOLATION_PENALTY), F.lit(0))).alias("score"),
        if_approved(F.col("improvement") * F.lit(EXTRAPOLATION_IMPROVEMENT)).alias("improvement"),
        if_approved(F.col("improvement")).alias("improvement_estimated"), if_approved(F.col("n")).alias("n_samples"))
