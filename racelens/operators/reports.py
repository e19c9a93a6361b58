"""Reports (P1-P9): global aggregates, top-k, per-request summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.functions import names as N
from racelens.operators.history import KIND_IMPOSSIBLE, KIND_INTERP

TOP_K = 5


def validation_stats_interp(gates: DataFrame, counts: DataFrame) -> DataFrame:
    """Evaluated, approved, rejected (model rejected by the gate) and,
    separately, pairs with too few rows; rate; score, improvement, CV and
    ratio means; rejections per level. One aggregate over the per-pair
    counts left-joined to the per-pair gates (both grid-sized)."""
    j = counts.join(gates.drop("n"), "pair_id", "left")
    g = j.agg(
        F.count("score").alias("total_evaluados"), F.count_if("approved").alias("aprobados"),
        F.count_if(~F.col("approved")).alias("rechazados"),
        F.count_if(~F.col("trained")).alias("insuficientes"),
        F.avg("score").alias("puntuacion_promedio"), F.min("score").alias("puntuacion_min"),
        F.max("score").alias("puntuacion_max"), F.avg("improvement").alias("mejora_promedio_sobre_naive"),
        F.avg("cv").alias("cv_promedio"), F.avg("ratio").alias("ratio_outliers_promedio"),
        F.count_if(~F.col("pass_naive")).alias("rechazos_por_mejor_que_naive"),
        F.count_if(~F.col("pass_consistency")).alias("rechazos_por_consistencia"),
        F.count_if(~F.col("pass_outliers")).alias("rechazos_por_outliers"))
    rate = F.when(F.col("total_evaluados") > 0, F.col("aprobados") / F.col("total_evaluados")).otherwise(F.lit(0.0))
    return g.select("*", rate.alias("tasa_aprobacion"))


def validation_stats_pred(gates: DataFrame) -> DataFrame:
    """Evaluated, approved, rejected, rate, mean score, improvement, CV."""
    g = gates.agg(F.count(F.lit(1)).alias("total_evaluados"), F.count_if("approved").alias("aprobados"),
                  F.count_if(~F.col("approved")).alias("rechazados"),
                  F.avg("score").alias("calidad_promedio"), F.avg("improvement").alias("mejora_promedio"),
                  F.avg("cv").alias("cv_promedio"))
    rate = F.when(F.col("total_evaluados") > 0, F.col("aprobados") / F.col("total_evaluados")).otherwise(F.lit(0.0))
    return g.select("*", rate.alias("tasa_aprobacion"))


def top_models_mae(models: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k smallest MAE (ties by model id)."""
    return models.orderBy(F.col("mae"), F.col("model_id")).limit(k)


def top_models_quality(models: DataFrame, k: int = TOP_K) -> DataFrame:
    """The k highest scores (ties: smaller MAE, then model id)."""
    return models.orderBy(F.col("score").desc(), F.col("mae"), F.col("model_id")).limit(k)


def metric_summary(saved: DataFrame) -> DataFrame:
    """P5: mean MAE, mean MAE std, total samples of the saved models; 0 when none."""
    return saved.agg(F.coalesce(F.avg("mae"), F.lit(0.0)).alias("mae_promedio"),
                     F.coalesce(F.avg("mae_std"), F.lit(0.0)).alias("mae_std_promedio"),
                     F.coalesce(F.sum("n_samples"), F.lit(0)).cast("long").alias("total_muestras"))


def split_source_report(plan: DataFrame) -> DataFrame:
    """Per request, how each training-table split is sourced: the
    published columns (normalised) looked up in the normalised plan."""
    cols = (plan.filter(F.col("kind") != KIND_IMPOSSIBLE)
            .select("req_key", N.normalise_column_name(F.col("alias")).alias("col")))
    mapping = plan.select("req_key", N.normalise_manifest_name(F.col("original")).alias("col"), "kind")
    j = cols.join(mapping, ["req_key", "col"], "left")
    return (j.select("req_key", F.coalesce("kind", F.lit("unknown")).alias("kind"))
            .groupBy("req_key", "kind").agg(F.count(F.lit(1)).alias("n_splits")))


def grid_totals(n_splits: int, counts: DataFrame, kind: str, models_per_pair: int) -> DataFrame:
    """Expected pairs n(n-1)/2, trained pairs, models."""
    expected = n_splits * (n_splits - 1) // 2
    return counts.agg(F.count_if("trained").alias("trained_pairs")).select(
        F.lit(kind).alias("kind"), F.lit(n_splits).alias("n_splits"), F.lit(expected).alias("expected_pairs"),
        "trained_pairs", (F.col("trained_pairs") * models_per_pair).alias("models"))


def batch_summary(requests: DataFrame, plan: DataFrame, selection: DataFrame) -> DataFrame:
    """Per request: final, original, interpolated and impossible split
    counts and races used."""
    p = plan.groupBy("req_key").agg(
        F.count_if(F.col("kind") != KIND_IMPOSSIBLE).alias("splits"),
        F.count_if(F.col("kind") == KIND_INTERP).alias("splits_interpolados"),
        F.count_if(F.col("kind") == KIND_IMPOSSIBLE).alias("splits_imposibles"))
    s = selection.groupBy("req_key").agg(F.count(F.lit(1)).alias("carreras_usadas"))
    r = requests.select("req_key", "nombre", F.size("splits").alias("splits_originales"))
    return r.join(p, "req_key").join(s, "req_key")
