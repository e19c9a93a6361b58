"""The two training jobs as lazy plans over the whole grid.

``InterpolationRun``: every (target, later position) pair, K-fold
out-of-fold predictions, error metrics, gate.
``PredictionRun``: every (prefix, future) pair, athlete hold-out, residual
quantiles on the training athletes, interval coverage and gate on the
held-out athletes.

The interpolation estimator is least squares on every feature of T3, solved
for all pairs and folds from Gram matrices (``operators.least_squares``); the
prediction estimator is the one-pass line on the last prefix split. Boosted
trees are fitted for the whole grid by ``operators.boosting``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from racelens.operators import blocks as BL
from racelens.operators import boosting as B
from racelens.operators import evaluate as E
from racelens.operators import grid as G
from racelens.operators import grid_errors as GE
from racelens.operators import least_squares as LS
from racelens.operators import models as M


class _Run:
    kind = ""

    def __init__(self, wide: DataFrame, mode: str = "strict", min_samples: int = G.MIN_SAMPLES,
                 quantile_mode: str = "bracket"):
        """quantile_mode: 'bracket' (exact, bounded memory per pair), 'exact'
        (Spark percentile, to compare with) or 'approx'."""
        self.wide, self.mode, self.min_samples, self.quantile_mode = wide, mode, min_samples, quantile_mode
        self.spark = wide.sparkSession

    @cached_property
    def exact(self) -> str:
        return self.quantile_mode

    @cached_property
    def detected(self) -> list[str]:
        return G.ordered_splits(self.wide.columns, self.mode)

    @cached_property
    def value_counts(self) -> DataFrame:
        return G.split_value_counts(self.wide, self.detected)

    @cached_property
    def splits(self) -> list[str]:
        """Detected, ordered splits that have data (empty ones would empty every
        pair they take part in)."""
        return G.non_empty_splits(self.wide, self.detected)

    @cached_property
    def pairs(self) -> list[G.Pair]:
        raise NotImplementedError

    @cached_property
    def pair_df(self) -> DataFrame:
        return G.pair_frame(self.spark, self.pairs)

    @cached_property
    def rows(self) -> DataFrame:
        return G.pair_rows(self.wide, self.splits, self.pairs)

    @cached_property
    def counts(self) -> DataFrame:
        """Complete rows of every pair, counted without expanding the grid."""
        raise NotImplementedError

    @cached_property
    def grid_rows(self) -> DataFrame:
        """Rows that can be complete cases."""
        return BL.leading_rows(self.wide, self.splits)

    @cached_property
    def blocks(self) -> DataFrame:
        """They packed, stored once: what evaluates the whole grid reads these."""
        return BL.stored(BL.packed(self.grid_rows, len(self.splits)))

    @cached_property
    def trained(self) -> DataFrame:
        """Rows of the pairs with enough of them (the pair table is bounded by the grid, n(n-1)/2 rows)."""
        return self.rows.join(F.broadcast(self.counts.filter("trained").select("pair_id")), "pair_id", "left_semi")


class InterpolationRun(_Run):
    kind = G.KIND_INTERP

    @cached_property
    def pairs(self) -> list[G.Pair]:
        return G.interp_pairs(self.splits)

    @cached_property
    def counts(self) -> DataFrame:
        return G.interp_counts(self.wide, self.splits, self.pair_df, self.min_samples)

    @cached_property
    def boost_rows(self) -> DataFrame:
        """Rows of every trained position for the boosters, read from the wide table each time."""
        found = {r.pair_id: r.n_complete for r in self.counts.filter("trained").collect()}   # a row per pair
        counts = {p.p_idx: found[p.pair_id] for p in self.pairs if p.pair_id in found}
        return B.position_rows(self.wide, self.splits, counts)

    @cached_property
    def centre(self) -> tuple[float, float]:
        return LS.centres(self.wide, self.splits)

    @cached_property
    def rows(self) -> DataFrame:
        """Pair rows with the feature vector of T3 (``z``) and the split before the target (``base``)."""
        def features(v, t, p):
            legs = F.zip_with(v, F.concat(F.array(F.lit(0.0)), v), lambda b, a: b - a)
            base = F.coalesce(F.get(v, t - 1), F.lit(0.0))
            return [LS.pair_features(legs, F.col("age"), F.col("gender"), t, p, self.centre).alias("z"), base.alias("base")]
        return G.pair_rows(self.wide, self.splits, self.pairs, extra=features)

    @cached_property
    def fold_models(self) -> DataFrame:
        """M3 models of every pair and fold, checkpointed: a grid-sized table that several plans join."""
        return LS.models_of(self.blocks, len(self.splits), self.pairs, self.centre).checkpoint()

    @cached_property
    def cv(self) -> DataFrame:
        return LS.cv_predict(self.trained, self.fold_models, self.centre)

    @cached_property
    def final_models(self) -> DataFrame:
        """M5: models of all complete rows, of the approved pairs alone."""
        approved = self.gates.filter("approved").select("pair_id")
        final = self.fold_models.filter(F.col("fold") == LS.FINAL).join(approved, "pair_id", "left_semi")
        return (final.join(self.pair_df.select("pair_id", "model_id", "target", "position"), "pair_id")
                .select("pair_id", "model_id", "target", "position", F.col("n_train"), "beta"))

    def predict(self, models: DataFrame) -> DataFrame:
        """(pair_id, row_key, y, pred) of all complete rows of the pairs that have a model."""
        found = LS.predict(self.trained, models.select("pair_id", "beta"), self.centre, ["pair_id"])
        return found.select("pair_id", "row_key", "y", "pred")

    @cached_property
    def cv_rows(self) -> DataFrame:
        """Out-of-fold predictions, narrow, checkpointed: the grid is expanded once and every later pass reads them."""
        return self.cv.select("pair_id", "fold", "y", "pred").checkpoint()

    @cached_property
    def errors(self) -> tuple[DataFrame, DataFrame]:
        """Error summaries and fold MAE of every pair, without expanding the grid. Weights are collected: a row per pair and fold."""
        models = self.fold_models.filter(F.col("fold") != LS.FINAL).join(self.counts.filter("trained").select("pair_id"), "pair_id", "left_semi")
        weights = {(r["pair_id"], r["fold"]): np.array(r["beta"]) for r in models.select("pair_id", "fold", "beta").collect()}
        return GE.summaries(self.blocks, len(self.splits), GE.least_squares_score(self.pairs, weights, self.centre, G.N_FOLDS))

    @cached_property
    def fold_errors(self) -> DataFrame:
        return self.errors[1] if self.exact == "bracket" else M.fold_mae(self.cv_rows)

    @cached_property
    def summary(self) -> DataFrame:
        """Error summaries of every pair (metrics and gate read them)."""
        return self.errors[0] if self.exact == "bracket" else E.summaries(self.cv_rows, exact=self.exact).checkpoint()

    @cached_property
    def metrics(self) -> DataFrame:
        return E.metrics_of(self.summary)

    @cached_property
    def gates(self) -> DataFrame:
        return E.gate_of(self.summary)

    @cached_property
    def folds(self) -> DataFrame:
        return M.fold_mae(self.cv)

    @cached_property
    def evaluation(self) -> DataFrame:
        """One row per trained pair: ids, fold MAE, gate and metrics."""
        p = self.pair_df.select("pair_id", "model_id", "target", "position", "target_km", "position_km",
                                "n_features")
        g = self.gates.select("pair_id", "mae_naive", "improvement", "cv", "p50", "p95", "ratio",
                              "pass_naive", "pass_consistency", "pass_outliers", "score", "approved", "status")
        m = self.metrics.select("pair_id", "n", "mae", "rmse", "r2")
        return (p.join(m, "pair_id").join(self.fold_errors, "pair_id").join(g, "pair_id"))


class GradedRun(InterpolationRun):
    """The evaluation alone: rows go from the table into packed blocks in one job, without a stored table between.

    ``table(n)`` gives the rows with ``n`` splits and, under ``_legs``, how many the data has for them; rows without a
    ``finisher_id`` count for that alone. Where ``guess`` splits are too few, or one before the last has no value, the
    job is done again with the right ones."""

    def __init__(self, table: Callable[[int], DataFrame], guess: int):
        super().__init__(table(guess))
        self.table, self.guess = table, guess

    @cached_property
    def _found(self) -> tuple[DataFrame, list[str], int, tuple[float, float]]:
        """Blocks, splits with data, legs of the longest row, mean first split and age."""
        n, names = self.guess, None
        while True:
            rows = self.table(n)
            detected = G.ordered_splits(rows.columns, self.mode)
            taken, seen = names or detected, Observation()
            own = F.col("finisher_id").isNotNull()
            rows = rows.observe(seen, F.max("_legs").alias("legs"), F.avg(F.when(own, F.col("age").cast("double"))).alias("age"),
                                F.avg(F.when(own, F.col(f"`{taken[0]}`").cast("double"))).alias("first"),
                                *[F.count(F.when(own, F.col(f"`{s}`"))).alias(f"n{i}") for i, s in enumerate(detected)])
            blocks = BL.stored(BL.packed(BL.leading_rows(rows.filter("finisher_id is not null"), taken), len(taken)))
            got = seen.get
            legs, have = got.get("legs") or 0, [s for i, s in enumerate(detected) if got.get(f"n{i}")]
            if legs <= n and have == taken[: len(have)]:
                return blocks, have, legs, (float(got.get("first") or 0.0), float(got.get("age") or 0.0))
            n, names = max(n, legs), have if legs <= n else None

    @cached_property
    def blocks(self) -> DataFrame:
        return self._found[0]

    @cached_property
    def splits(self) -> list[str]:
        return self._found[1]

    @cached_property
    def legs(self) -> int:
        return self._found[2]

    @cached_property
    def centre(self) -> tuple[float, float]:
        return self._found[3]

    @cached_property
    def counts(self) -> DataFrame:
        return G.counts_of(BL.leading_counts(self.blocks), self.pair_df, self.min_samples)


class PredictionRun(_Run):
    kind = G.KIND_PRED

    @cached_property
    def pairs(self) -> list[G.Pair]:
        return G.pred_pairs(self.splits)

    @cached_property
    def sizes(self) -> DataFrame:
        """Rows and athletes of every pair, held out and not."""
        return G.holdout_counts(self.wide, self.splits, self.pair_df, self.min_samples)

    @cached_property
    def counts(self) -> DataFrame:
        return self.sizes.select("pair_id", "n_complete", "trained")

    @cached_property
    def grid_rows(self) -> DataFrame:
        """The held-out rows alone: the evaluation reads no others."""
        return BL.leading_rows(self.wide.filter(G.is_holdout(F.col("athlete_id"))), self.splits)

    @cached_property
    def predictions(self) -> DataFrame:
        """Predictions of all rows, narrow, checkpointed: quantiles, intervals and gate read them."""
        return M.holdout_predict(self.trained).select("pair_id", "row_key", "athlete_id", "holdout", "y", "pred").checkpoint()

    @cached_property
    def quantiles(self) -> DataFrame:
        return M.residual_quantiles(self.predictions, exact=self.exact)

    @cached_property
    def intervals(self) -> DataFrame:
        return M.interval_predict(self.predictions, self.quantiles)

    @cached_property
    def coverage(self) -> DataFrame:
        return M.coverage(self.intervals)

    @cached_property
    def summary(self) -> DataFrame:
        """Error summaries of the held-out rows of every pair."""
        if self.exact == "bracket":
            fits = M.holdout_fit(self.trained).select("pair_id", "slope", "intercept").collect()     # a row per pair
            lines = {r["pair_id"]: (r["slope"], r["intercept"]) for r in fits}
            return GE.summaries(self.blocks, len(self.splits), GE.line_score(self.pairs, lines))[0]
        return E.summaries(self.predictions.filter(F.col("holdout")), exact=self.exact).checkpoint()

    @cached_property
    def gates(self) -> DataFrame:
        return E.gate_of(self.summary)

    @cached_property
    def report(self) -> DataFrame:
        """One row per trained pair."""
        sizes = self.sizes.filter("trained").select(
            "pair_id", F.col("n_train").alias("n_samples_train"), F.col("n_test").alias("n_samples_test"),
            F.col("n_athletes_train").alias("n_atletas_train"), F.col("n_athletes_test").alias("n_atletas_test"))
        p = self.pair_df.select("pair_id", F.col("prefix_joined").alias("input_splits"),
                                F.col("target").alias("output_split"))
        g = self.gates.select("pair_id", F.col("mae").alias("mae_test"), F.col("approved").alias("validacion_aprobado"),
                              F.col("score").alias("calidad"))
        return (p.join(sizes, "pair_id").join(self.quantiles, "pair_id", "left")
                .join(self.coverage.select("pair_id", F.col("coverage").alias("cobertura_test")), "pair_id", "left")
                .join(g, "pair_id", "left"))


def boosted_fit_predict_all(run: InterpolationRun, params: dict, store: str) -> DataFrame:
    """M2 + M11: boosters of every pair with at least ``min_samples`` rows, written to
    ``store`` and read back; the predictions of the rows they were fitted on."""
    rows = run.boost_rows
    cells = B.binned_rows(rows)     # fit and scoring read them
    B.fit_grid(rows, params, cells).write.parquet(store)
    models = run.spark.read.schema(B.TREE_SCHEMA).parquet(store)
    return B.score_grid(rows, models, run.pairs, found=cells)
