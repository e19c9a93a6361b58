"""Registered queries of the training side (T, M, E, P keys).

The training table is ``race_wide`` (every finisher, splits km_5..km_40).
Model-derived floats are rounded to 4 decimals in query and oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.functions import names as N
from racelens.operators import evaluate as E
from racelens.operators import grid as G
from racelens.operators import models as M
from racelens.operators import reports as P
from racelens.operators.history import KIND_INTERP as PLAN_INTERP
from racelens.operators.training import GradedRun, InterpolationRun, PredictionRun, boosted_fit_predict_all
from racelens.plans.context import Ctx
from racelens.plans.queries import query
from racelens.session import scratch_path
from racelens.sources import fixtures as X
from racelens.sources.models import load_models, save_models


def r4(c) -> F.Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 4)


class TCtx(Ctx):
    @cached_property
    def training(self) -> DataFrame:
        """What the training runs read of the wide table, stored once per query as columns in the
        shared folder: the grid decisions and the evaluation read some of them several times and
        must not replay the leg window each time."""
        return X.stored_wide(self.spark, self.sf, ["finisher_id", "athlete_id", "gender", "age"], scratch_path(self.spark, "training-rows"))

    @cached_property
    def interp(self) -> InterpolationRun:
        return InterpolationRun(self.training)

    @cached_property
    def graded(self) -> GradedRun:
        """The interpolation run for what reads its evaluation alone: no wide table is stored for it."""
        known = X.known_legs(self.spark, self.sf)
        run = GradedRun(lambda n: X.wide_rows(self.spark, self.sf, ["finisher_id", "gender", "age"], n), known or X.GUESS_LEGS)
        X.known_legs(self.spark, self.sf, run.legs)
        return run

    @cached_property
    def pred(self) -> PredictionRun:
        return PredictionRun(self.training)

    def ids(self, run) -> DataFrame:
        return run.pair_df.select("pair_id", "model_id")


def _with_ids(c: TCtx, run, df: DataFrame) -> DataFrame:
    return df.join(F.broadcast(c.ids(run)), "pair_id").drop("pair_id")


# ---------------------------------------------------------------- T

@query("pair_grid_interp")
def q_pair_grid_interp(spark, sf):
    c = TCtx(spark, sf)
    r = c.interp
    return (r.pair_df.join(r.counts, "pair_id", "left")
            .select("model_id", "target", "position", "n_features",
                    F.coalesce("n_complete", F.lit(0)).cast("long").alias("n_complete")))


@query("pair_grid_pred")
def q_pair_grid_pred(spark, sf):
    c = TCtx(spark, sf)
    r = c.pred
    return (r.pair_df.join(r.counts, "pair_id", "left")
            .select("model_id", F.col("prefix_joined").alias("prefix"), F.col("target").alias("future"),
                    "n_features", F.coalesce("n_complete", F.lit(0)).cast("long").alias("n_complete")))


@query("feature_sets")
def q_feature_sets(spark, sf):
    c = TCtx(spark, sf)
    return c.interp.pair_df.unionByName(c.pred.pair_df).select("model_id", "kind", "features")


@query("complete_cases")
def q_complete_cases(spark, sf):
    c = TCtx(spark, sf)
    return (_with_ids(c, c.interp, c.interp.counts)
            .unionByName(_with_ids(c, c.pred, c.pred.counts)).select("model_id", "n_complete"))


@query("min_samples")
def q_min_samples(spark, sf):
    c = TCtx(spark, sf)
    return (_with_ids(c, c.interp, c.interp.counts)
            .unionByName(_with_ids(c, c.pred, c.pred.counts)).select("model_id", "n_complete", "trained"))


@query("empty_splits")
def q_empty_splits(spark, sf):
    c = TCtx(spark, sf)
    return c.interp.value_counts.select("split", "ord", "n_values", (F.col("n_values") > 0).alias("has_data"))


@query("athlete_holdout")
def q_athlete_holdout(spark, sf):
    c = TCtx(spark, sf)
    sizes = c.pred.sizes.filter("trained")
    return _with_ids(c, c.pred, sizes.select("pair_id", "n_train", "n_test", "n_athletes_train", "n_athletes_test"))


@query("kfold")
def q_kfold(spark, sf):
    c = TCtx(spark, sf)
    agg = c.interp.trained.groupBy("pair_id", "fold").agg(F.count(F.lit(1)).alias("n_rows"))
    return _with_ids(c, c.interp, agg)


# ---------------------------------------------------------------- M

@query("naive_mean")
def q_naive_mean(spark, sf):
    c = TCtx(spark, sf)
    m = M.naive_mean(c.interp.trained)
    return _with_ids(c, c.interp, m.select("pair_id", "n", r4("mean_y").alias("mean_y")))


@query("cv_predict")
def q_cv_predict(spark, sf):
    c = TCtx(spark, sf)
    cv = c.interp.cv
    agg = cv.groupBy("pair_id", "fold").agg(
        F.count(F.lit(1)).alias("n_pred"), F.first("n_train").alias("n_train"),
        (F.size(F.first("beta")) - 1).cast("int").alias("n_features"),
        F.first(F.get("beta", F.lit(1))).alias("age_weight"), F.avg("pred").alias("mean_pred"))
    return _with_ids(c, c.interp, agg.select("pair_id", "fold", "n_pred", "n_train", "n_features",
                                             r4("age_weight").alias("age_weight"), r4("mean_pred").alias("mean_pred")))


@query("fold_mae")
def q_fold_mae(spark, sf):
    c = TCtx(spark, sf)
    f = c.interp.folds
    return _with_ids(c, c.interp, f.select("pair_id", r4("mae_folds_mean").alias("mae_folds_mean"),
                                           r4("mae_folds_std").alias("mae_folds_std"), "k"))


def _extrapolated(c: TCtx, splits: list[str]) -> DataFrame:
    """Interpolated splits of every request with the wide-table column at their source distance."""
    cols = c.spark.createDataFrame([(s, G.N_km(s)) for s in splits], "source_col string, col_km double")
    return (c.plan.filter(F.col("kind") == PLAN_INTERP)
            .join(F.broadcast(cols), F.round("source_km", 3) == F.round("col_km", 3))
            .select("req_key", "alias", "source_col", "source_km", "target_km"))


@query("extrapolate")
def q_extrapolate(spark, sf):
    """M6: the source model's out-of-fold predictions times the distance ratio, averaged per position."""
    c = TCtx(spark, sf)
    means = c.interp.cv.groupBy("pair_id").agg(F.count(F.lit(1)).alias("n"), F.avg("pred").alias("pred"))
    preds = c.interp.pair_df.select("pair_id", "target", "position").join(means, "pair_id").drop("pair_id")
    out = M.extrapolate(_extrapolated(c, c.interp.splits), preds)
    return out.select("req_key", F.concat("alias", F.lit("_desde_"), "position", F.lit("_ext")).alias("model_id"),
                      F.col("source_col").alias("source"), r4("factor").alias("factor"), "n", r4("pred").alias("mean_pred"))


def _interp_eval(c: TCtx) -> DataFrame:
    return c.graded.evaluation


@query("extrapolated_metrics")
def q_extrapolated_metrics(spark, sf):
    """Interpolated splits of every request borrow the evaluated model of the
    wide-table column at their source distance, at every later position; a
    rejected source gives no model."""
    c = TCtx(spark, sf)
    ev = _interp_eval(c).select("target", "position", "mae_folds_mean", "mae_folds_std", "score", "improvement",
                                "approved", "n")
    out = M.extrapolated_metrics(_extrapolated(c, c.graded.splits), ev)
    return out.select("req_key", "model_id", "source", r4("factor").alias("factor"), "trained", r4("mae").alias("mae"),
                      r4("mae_std").alias("mae_std"), "score", r4("improvement").alias("improvement"),
                      r4("improvement_estimated").alias("improvement_estimated"), "n_samples")


@query("residual_quantiles")
def q_residual_quantiles(spark, sf):
    c = TCtx(spark, sf)
    q = c.pred.quantiles
    return _with_ids(c, c.pred, q.select("pair_id", r4("q10").alias("q10"), r4("q50").alias("q50"),
                                         r4("q90").alias("q90")))


@query("interval_predict")
def q_interval_predict(spark, sf):
    c = TCtx(spark, sf)
    i = c.pred.intervals
    return _with_ids(c, c.pred, i.select("pair_id", "row_key", "y", r4("pred").alias("pred"),
                                         r4("lower").alias("lower"), r4("median").alias("median"),
                                         r4("upper").alias("upper")))


@query("coverage")
def q_coverage(spark, sf):
    c = TCtx(spark, sf)
    return _with_ids(c, c.pred, c.pred.coverage.select("pair_id", r4("coverage").alias("coverage"), "n_test"))


@query("batch_predict")
def q_batch_predict(spark, sf):
    """The prediction grid's models, which are kept for every pair, saved, loaded and applied as a join."""
    c = TCtx(spark, sf)
    store = save_models(M.holdout_fit(c.pred.trained), scratch_path(spark, "pred-models"))
    p = M.line_predict(c.pred.trained, load_models(spark, store))
    return _with_ids(c, c.pred, p.select("pair_id", "row_key", r4("pred").alias("pred")))


@query("fit_if_approved")
def q_fit_if_approved(spark, sf):
    """M5: the final models of the pairs whose gate passed are saved; what the loaded store holds, per pair."""
    c = TCtx(spark, sf)
    store = save_models(c.graded.final_models, scratch_path(spark, "interp-models"))
    kept = load_models(spark, store).select("pair_id", "n_train", (F.size("beta") - 1).cast("int").alias("n_features"))
    g = c.graded.gates.select("pair_id", "approved").join(kept, "pair_id", "left")
    return _with_ids(c, c.graded, g.select("pair_id", "approved", F.when(F.col("n_train").isNotNull(), "fit_final").otherwise("skip").alias("action"),
                                           "n_train", "n_features"))


@query("fit_boosted")
def q_fit_boosted(spark, sf):
    """M2: boosted trees with the interpolation trainer's parameters (100
    trees, depth 10, rate 0.05, subsample 0.8, column share 0.8, seed 42),
    fitted on every pair that meets min_samples, stored, and applied to their
    rows (rows-only check; the tree learner differs from the analysed one)."""
    c = TCtx(spark, sf)
    found = boosted_fit_predict_all(c.interp, M.GBT_INTERP, scratch_path(spark, "boosted"))
    return found.select("pair_id", F.col("row_key").alias("finisher_id"), "y", "pred")


# ---------------------------------------------------------------- E

@query("error_metrics")
def q_error_metrics(spark, sf):
    c = TCtx(spark, sf)
    m = c.graded.metrics
    cols = [x for x in m.columns if x not in ("pair_id", "n")]
    return _with_ids(c, c.graded, m.select("pair_id", "n", *[r4(x).alias(x) for x in cols]))


@query("metric_provenance")
def q_metric_provenance(spark, sf):
    """Every model's metric with the source that each request's plan gives its
    target; the distance gap for interpolated ones. A target in no plan keeps its row."""
    c = TCtx(spark, sf)
    ev = _interp_eval(c).select("model_id", "target", "mae")
    plan = c.plan.filter(F.col("kind") != "impossible").select("req_key", "alias", "kind", "source", "diff_km")
    return (ev.join(plan, ev["target"] == plan["alias"], "left")
            .select("req_key", "model_id", "target", F.col("source").alias("split_origen"),
                    F.col("kind").alias("tipo_origen"),
                    F.when(F.col("kind") == PLAN_INTERP, r4("diff_km")).alias("diferencia_distancia"),
                    r4("mae").alias("mae")))


@query("gate_naive")
def q_gate_naive(spark, sf):
    c = TCtx(spark, sf)
    g = c.graded.gates
    return _with_ids(c, c.graded, g.select("pair_id", r4("mae_naive").alias("mae_naive"), r4("mae").alias("mae"),
                                           r4("improvement").alias("improvement"), "pass_naive"))


@query("gate_consistency")
def q_gate_consistency(spark, sf):
    c = TCtx(spark, sf)
    g = c.graded.gates
    return _with_ids(c, c.graded, g.select("pair_id", r4("std_error").alias("std_error"), r4("cv").alias("cv"),
                                           "pass_consistency"))


@query("gate_outliers")
def q_gate_outliers(spark, sf):
    c = TCtx(spark, sf)
    g = c.graded.gates
    return _with_ids(c, c.graded, g.select("pair_id", r4("p50").alias("p50"), r4("p95").alias("p95"),
                                           r4("ratio").alias("ratio"), "pass_outliers"))


@query("quality_score")
def q_quality_score(spark, sf):
    c = TCtx(spark, sf)
    g = c.graded.gates
    return _with_ids(c, c.graded, g.select("pair_id", "pass_naive", "pass_consistency", "pass_outliers",
                                           "score", "approved"))


@query("approval_status")
def q_approval_status(spark, sf):
    c = TCtx(spark, sf)
    return _with_ids(c, c.graded, c.graded.gates.select("pair_id", "score", "approved", "status"))


# ---------------------------------------------------------------- P

def _saved(c: TCtx) -> DataFrame:
    """Models that would be saved: approved interpolation models."""
    return _interp_eval(c).filter("approved").select(
        "model_id", F.col("mae_folds_mean").alias("mae"), F.col("mae_folds_std").alias("mae_std"),
        F.col("n").alias("n_samples"), "score")


@query("validation_stats_interp")
def q_validation_stats_interp(spark, sf):
    c = TCtx(spark, sf)
    s = P.validation_stats_interp(c.graded.gates, c.graded.counts)
    return s.select(*[r4(x).alias(x) if x in ("puntuacion_promedio", "mejora_promedio_sobre_naive", "cv_promedio",
                                              "ratio_outliers_promedio", "tasa_aprobacion") else F.col(x)
                      for x in s.columns])


@query("validation_stats_pred")
def q_validation_stats_pred(spark, sf):
    c = TCtx(spark, sf)
    s = P.validation_stats_pred(c.pred.gates)
    return s.select(*[r4(x).alias(x) if x in ("calidad_promedio", "mejora_promedio", "cv_promedio",
                                              "tasa_aprobacion") else F.col(x) for x in s.columns])


@query("top_models_mae")
def q_top_models_mae(spark, sf):
    c = TCtx(spark, sf)
    t = P.top_models_mae(_saved(c))
    return t.select("model_id", r4("mae").alias("mae"), "score")


@query("top_models_quality")
def q_top_models_quality(spark, sf):
    c = TCtx(spark, sf)
    t = P.top_models_quality(_saved(c))
    return t.select("model_id", r4("mae").alias("mae"), "score")


@query("metric_summary")
def q_metric_summary(spark, sf):
    c = TCtx(spark, sf)
    s = P.metric_summary(_saved(c))
    return s.select(r4("mae_promedio").alias("mae_promedio"), r4("mae_std_promedio").alias("mae_std_promedio"),
                    "total_muestras")


@query("split_source_report")
def q_split_source_report(spark, sf):
    return P.split_source_report(Ctx(spark, sf).plan)


@query("training_row_report")
def q_training_row_report(spark, sf):
    c = TCtx(spark, sf)
    r = c.pred.report
    return r.select("input_splits", "output_split", r4("mae_test").alias("mae_test"),
                    r4("cobertura_test").alias("cobertura_test"), r4("q10").alias("q10_train"),
                    r4("q50").alias("q50_train"), r4("q90").alias("q90_train"), "n_samples_train", "n_samples_test",
                    "n_atletas_train", "n_atletas_test", "validacion_aprobado", "calidad")


@query("grid_totals")
def q_grid_totals(spark, sf):
    c = TCtx(spark, sf)
    a = P.grid_totals(len(c.interp.splits), c.interp.counts, G.KIND_INTERP, 1)
    b = P.grid_totals(len(c.pred.splits), c.pred.counts, G.KIND_PRED, 3)
    return a.unionByName(b)


@query("batch_summary")
def q_batch_summary(spark, sf):
    c = Ctx(spark, sf)
    return P.batch_summary(c.valid, c.plan, c.selection)
