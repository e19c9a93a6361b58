"""End-to-end batch jobs (the three jobs of the analysed system).

* ``training_table_job``: requests -> history -> plan -> training table,
  manifests and job output, all written below ``out_dir``;
* ``interpolation_job``: grid, K-fold evaluation, gate, metric files,
  summary, model index;
* ``prediction_job``: grid, hold-out evaluation, quantiles, coverage, report.

Small intermediate tables (plan, selection) and the pair rows are cut from
their lineage with reliable ``checkpoint()`` in the shared checkpoint folder;
results are written with Spark's writers (no driver-side loops over data).

usage: python -m racelens.jobs SF_DIR OUT_DIR [table|interp|pred|all]
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.operators import history as H
from racelens.operators import reports as P
from racelens.operators import requests as Q
from racelens.operators import training_table as T
from racelens.operators.training import InterpolationRun, PredictionRun
from racelens.session import ensure_checkpoint_dir, scratch_path
from racelens.sources import fixtures as X
from racelens.sources import manifests as MF
from racelens.sources import wide as W


def training_table_job(spark: SparkSession, wide: DataFrame, catalog: DataFrame, raw_requests: DataFrame,
                       split_columns: list[str], out_dir: str, run_ts: str, strict: bool = True) -> dict:
    """strict: an unknown model kind fails the whole batch (the analysed
    system's rule); non-strict drops the invalid requests (C2 lists them)."""
    ensure_checkpoint_dir(spark)
    requests = Q.request_normalise(raw_requests)
    if strict:
        Q.assert_valid_batch(requests)                  # C2: one aggregate, raises on a bad batch
    valid = Q.valid_requests(requests).checkpoint()
    cands = H.history_candidates(valid, catalog)
    universe = H.split_universe(cands)
    plan = H.split_plan(valid.join(cands.select("req_key").distinct(), "req_key", "left_semi"), universe)
    plan = plan.checkpoint()
    selection = H.latest_editions(cands, plan).checkpoint()
    prune = [(r[0], r[1]) for r in selection.select("race_id", "event_id").distinct().collect()]  # catalog metadata
    table = T.training_table(wide, selection, plan, valid, split_columns, prune_pairs=prune)
    table.write.mode("overwrite").option("compression", "snappy").partitionBy("req_key").parquet(f"{out_dir}/data")
    names = Q.run_names(valid, F.lit(run_ts)).select("req_key", "result_table")
    rec = MF.manifest_records(valid, plan, selection, names, T.schema_fingerprint(plan), F.lit(run_ts))
    MF.write_manifests(rec, f"{out_dir}/manifests")
    summary = P.batch_summary(valid, plan, selection)
    MF.write_job_output(MF.job_outputs(summary, run_ts, out_dir), f"{out_dir}/debug", run_ts)
    outcomes = Q.batch_outcomes(valid, selection).groupBy("outcome").count().collect()
    return {r["outcome"]: r["count"] for r in outcomes}


def interpolation_job(spark: SparkSession, wide: DataFrame, out_dir: str, quantile_mode: str = "bracket") -> dict:
    ensure_checkpoint_dir(spark)
    run = InterpolationRun(wide.checkpoint(), quantile_mode=quantile_mode)
    ev = run.evaluation.checkpoint()
    MF.write_csv(ev.select("model_id", "target", "position", F.col("mae_folds_mean").alias("mae"),
                           F.col("mae_folds_std").alias("mae_std"), F.col("n").alias("n_samples"), "score",
                           "approved"), f"{out_dir}/metricas_modelos")
    MF.write_metrics_json(MF.metrics_records(ev), f"{out_dir}/metrics")
    saved = ev.filter("approved").select("model_id")
    MF.model_index(saved).write.mode("overwrite").json(f"{out_dir}/modelos_disponibles")
    stats = P.validation_stats_interp(run.gates, run.counts).first().asDict()
    return {"splits": run.splits, "pairs": len(run.pairs), **stats}


def prediction_job(spark: SparkSession, wide: DataFrame, out_dir: str, quantile_mode: str = "bracket") -> dict:
    ensure_checkpoint_dir(spark)
    run = PredictionRun(wide.checkpoint(), quantile_mode=quantile_mode)
    report = run.report.checkpoint()
    MF.write_csv(report, f"{out_dir}/metricas_prediccion")
    stats = P.validation_stats_pred(run.gates).first().asDict()
    return {"splits": run.splits, "pairs": len(run.pairs), **stats}


def main(argv: list[str]) -> int:
    from racelens.session import get_spark
    sf_dir, out_dir = argv[1], argv[2]
    which = argv[3] if len(argv) > 3 else "all"
    from racelens.session import input_size, shuffle_partitions_for
    spark = get_spark()
    size = input_size(spark, [f"{sf_dir}/{t}.parquet" for t in ("lineitem", "orders", "customer")])
    # cluster sizing: ~256 MB per scan split and shuffle partition (AQE coalesces)
    spark.conf.set("spark.sql.shuffle.partitions",
                   str(shuffle_partitions_for(size, spark.sparkContext.defaultParallelism)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(256 * 1024 * 1024))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(256 * 1024 * 1024))
    wide = X.race_wide(spark, sf_dir)
    if which in ("table", "all"):
        stored = W.write_partitioned(wide.checkpoint(), scratch_path(spark, "wide"))
        names = W.stored_splits(spark, stored)   # every spelling of every edition
        print(training_table_job(spark, W.read_declared(spark, stored, names), X.race_catalog(spark, sf_dir),
                                 X.raw_requests(spark, sf_dir), names, f"{out_dir}/table", "20260303-085722",
                                 strict=False))   # the fixture batch holds one invalid request on purpose
    if which in ("interp", "all"):
        print(interpolation_job(spark, wide, f"{out_dir}/interp"))
    if which in ("pred", "all"):
        print(prediction_job(spark, wide, f"{out_dir}/pred"))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
