"""Registered queries of sources and sinks (S keys) plus the model-id key.

Each builder writes what it needs below the shared checkpoint folder
(``spark.checkpoint.dir``), then returns a lazy read of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racelens.operators import reports as P
from racelens.operators import requests as Q
from racelens.operators import training_table as T
from racelens.operators.history import KIND_IMPOSSIBLE
from racelens.operators.models import GBT_INTERP
from racelens.plans.context import Ctx, r6
from racelens.plans.queries import query
from racelens.plans.queries_train import TCtx, r4
from racelens.session import scratch_path
from racelens.sources import catalog as C
from racelens.sources import fixtures as X
from racelens.sources import manifests as MF
from racelens.sources import reuse as R
from racelens.sources import wide as W

RUN_TS = "20260303-085722"
MODEL_BASE = "models"


@query("catalog_scan")
def q_catalog_scan(spark, sf):
    c = Ctx(spark, sf)
    path = C.write_catalog_lines(C.positioned(c.catalog), scratch_path(spark, "catalog"))
    cat = C.read_catalog_lines(spark, path, with_position=True)
    return cat.select("cat_pos", "entry_key", "race_id", "event_id", "event_std",
                      F.array_join("splits", ",").alias("splits"))


def _cells(df: DataFrame, ids: list[str], splits: list[str]) -> DataFrame:
    """The cells of a wide table that are not null as rows (split, secs); a row without any keeps one of nulls."""
    cells = F.array(*[F.struct(F.lit(s).alias("split"), F.col(s).alias("secs")) for s in splits])
    full = F.filter(cells, lambda x: x["secs"].isNotNull())
    return df.select(*ids, F.inline_outer(full))


@query("wide_scan")
def q_wide_scan(spark, sf):
    c = Ctx(spark, sf)
    # as stored: editions of odd years have their own spelling, which reads as null here
    df = W.read_declared(spark, c.stored, c.splits)
    return _cells(df, ["finisher_id", "athlete_id", "race_id", "event_id", "event_std", "gender", "age"], c.splits)


@query("column_def_parse")
def q_column_def_parse(spark, sf):
    c = Ctx(spark, sf)
    std = F.array(F.lit("athlete_id"), F.lit('"event_std" string'), F.lit('"gender"'), F.lit('"age" int'))
    defs = (c.plan.filter(F.col("kind") != KIND_IMPOSSIBLE)
            .groupBy("req_key").agg(F.array_sort(F.collect_list(F.struct("ord", "split"))).alias("s"))
            .select("req_key", F.concat(std, F.transform("s", lambda x: F.concat(F.lit('"'), x["split"],
                                                                                   F.lit('" double'))))
                    .alias("defs")))
    ex = defs.select("req_key", F.posexplode("defs").alias("pos", "definition"))
    return W.parse_column_defs(ex)


@query("partition_select")
def q_partition_select(spark, sf):
    """Only the directories of chosen (race, event) pairs are read."""
    c = Ctx(spark, sf)
    df = W.read_declared(spark, c.stored, ["km_5"], c.chosen_pairs)
    return df.groupBy("race_id", "event_id").agg(F.count(F.lit(1)).alias("n_rows"),
                                                 F.count("km_5").alias("n_km_5"))


@query("reuse_if_exists")
def q_reuse_if_exists(spark, sf):
    """The source table of every split set, with the editions that its requests chose, is written once, then reused."""
    c = Ctx(spark, sf)
    # name and columns of a set; the same set is the same table, whichever request asks
    sets = T.schema_fingerprint(c.plan).join(
        c.plan.filter(F.col("kind") != KIND_IMPOSSIBLE).groupBy("req_key")
        .agg(F.array_sort(F.collect_set("split")).alias("columns")), "req_key")
    editions = sets.join(c.selection.select("req_key", "race_id", "event_id"), "req_key").groupBy("source_table", "columns").agg(
        F.array_sort(F.collect_set(F.struct("race_id", "event_id"))).alias("editions"))
    state = R.snapshot(spark, c.stored)
    names = F.concat("columns", F.transform("editions", lambda e: F.concat_ws("/", e["race_id"], e["event_id"])))
    sets = editions.select(R.address(F.col("source_table"), names, state).alias("address"),
                           F.col("source_table").alias("table_name"), "editions").checkpoint()
    chosen = sets.select("address", F.inline("editions"))
    base = scratch_path(spark, "source-tables")
    rows = W.read_declared(spark, c.stored, [], c.chosen_pairs).select("finisher_id", "race_id", "event_id")
    rows = rows.join(F.broadcast(chosen), ["race_id", "event_id"])     # at most five editions per request
    first = R.reuse_or_write(spark, base, sets, rows)
    second = R.reuse_or_write(spark, base, sets, rows)
    flags = first.select("address", F.col("reused").alias("reused_first")).join(
        second.select("address", F.col("reused").alias("reused_second")), "address")
    back = R.read_tables(spark, base, "finisher_id long, race_id string, event_id string")
    counts = back.groupBy("address", "table_name", "race_id").agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(flags, "address").select("table_name", "reused_first", "reused_second", "race_id", "n_rows")


@query("training_table_write")
def q_training_table_write(spark, sf):
    c = Ctx(spark, sf)
    rows = T.training_rows(c.history_rows, c.selection, c.plan, c.valid, c.sources)
    size = T.training_size(c.history_rows, c.selection, c.plan)
    path = T.write_by_request(rows, size, scratch_path(spark, "training"))
    back = spark.read.parquet(path)
    return back.select("req_key", "nombre", "athlete_id", "event_id", "event_std", "gender", "age", "ord", "split",
                       "secs")


def _manifests(c: Ctx) -> DataFrame:
    names = Q.run_names(c.valid, F.lit(RUN_TS)).select("req_key", "result_table")
    sources = T.schema_fingerprint(c.plan)
    rec = MF.manifest_records(c.valid, c.plan, c.selection, names, sources, F.lit(RUN_TS))
    path = MF.write_manifests(rec, scratch_path(c.spark, "manifests"))
    return MF.read_manifests(c.spark, path)


@query("manifest_write")
def q_manifest_write(spark, sf):
    m = _manifests(Ctx(spark, sf))
    return m.select("req_key", "carrera", "timestamp", F.size("splits_originales").alias("n_originales"),
                    F.array_join("splits_finales", ",").alias("splits_finales"),
                    F.array_join("analisis.splits_directos", ",").alias("splits_directos"),
                    F.size("analisis.splits_interpolables").alias("n_interpolables"),
                    F.array_join("analisis.splits_imposibles", ",").alias("splits_imposibles"),
                    F.size("analisis.mapping").alias("n_mapping"), "tabla_fuente", "tabla_generada",
                    "carreras_usadas")


@query("manifest_read")
def q_manifest_read(spark, sf):
    """Candidates in priority order: a missing place, a corrupt file, then
    two good manifests; the first readable one wins."""
    c = Ctx(spark, sf)
    names = Q.run_names(c.valid, F.lit(RUN_TS)).select("req_key", "result_table")
    rec = MF.manifest_records(c.valid, c.plan, c.selection, names, T.schema_fingerprint(c.plan), F.lit(RUN_TS))
    base = scratch_path(spark, "candidates")
    for i, key in enumerate(["b4-1", "b4-0"]):
        rec.filter(F.col("req_key") == key).select("m.*").coalesce(1).write.json(f"{base}/place{i + 2}")
    spark.createDataFrame([("{not json",)], "value string").coalesce(1).write.text(f"{base}/place1")
    cands = [f"{base}/place0", f"{base}/place1", f"{base}/place2", f"{base}/place3"]
    m = MF.manifest_read_first(spark, cands)
    return m.select("carrera", "timestamp", F.array_join("splits_finales", ",").alias("splits_finales"),
                    "carreras_usadas")


def _job_output_dir(c: Ctx) -> tuple[str, DataFrame]:
    summary = P.batch_summary(c.valid, c.plan, c.selection)
    folder = scratch_path(c.spark, "job-output")
    out = MF.job_outputs(summary, RUN_TS, MODEL_BASE)
    MF.write_job_output(out, folder, RUN_TS)
    return folder, summary


@query("latest_manifest")
def q_latest_manifest(spark, sf):
    """Exact stamp found -> that output; the records are exploded."""
    c = Ctx(spark, sf)
    folder, _ = _job_output_dir(c)
    return MF.latest_job_output(spark, folder, RUN_TS)


@query("manifest_rewrite")
def q_manifest_rewrite(spark, sf):
    """Every record re-derives folder, path and table from its own race."""
    c = Ctx(spark, sf)
    summary = P.batch_summary(c.valid, c.plan, c.selection)
    out = MF.job_outputs(summary, "19990101-000000", MODEL_BASE)
    fixed = MF.rewrite_records(out, F.lit(RUN_TS), MODEL_BASE)
    return fixed.select("carrera", "carpeta_modelo", "data_path", "tabla_generada", "splits", "carreras_usadas")


@query("recursive_load")
def q_recursive_load(spark, sf):
    c = Ctx(spark, sf)
    df = W.recursive_load(spark, c.stored)
    cols = c.splits + [n + "_0" for n in c.splits]
    return _cells(df, ["finisher_id", "athlete_id", "event_std", "gender", "age"], cols)


def _eval_table(c: TCtx) -> DataFrame:
    e = c.graded.evaluation
    return e.select("model_id", "target", "position", r4("mae_folds_mean").alias("mae"),
                    r4("mae_folds_std").alias("mae_std"), F.col("n").alias("n_samples"), "score", "approved")


@query("metrics_csv")
def q_metrics_csv(spark, sf):
    c = TCtx(spark, sf)
    df = _eval_table(c)
    path = MF.write_csv(df, scratch_path(spark, "metrics-csv"))
    return MF.read_csv(spark, path, "model_id string, target string, position string, mae double, mae_std double, "
                                    "n_samples long, score int, approved boolean")


@query("metrics_json")
def q_metrics_json(spark, sf):
    c = TCtx(spark, sf)
    path = MF.write_metrics_json(MF.metrics_records(c.graded.evaluation), scratch_path(spark, "metrics-json"))
    back = spark.read.schema(
        "regression_metrics struct<mae:struct<value:double,standard_deviation:double>,r2:struct<value:double>,"
        "n_samples:struct<value:long>>, validation_metrics struct<calidad:int,aprobado:boolean,"
        "mejora_sobre_naive:double,cv_error:double,outliers_ratio:double>, model_id string").json(path)
    return back.select("model_id", r4("regression_metrics.mae.value").alias("mae"),
                       r4("regression_metrics.mae.standard_deviation").alias("mae_std"),
                       r4("regression_metrics.r2.value").alias("r2"),
                       F.col("regression_metrics.n_samples.value").alias("n_samples"),
                       F.col("validation_metrics.calidad").alias("calidad"),
                       F.col("validation_metrics.aprobado").alias("aprobado"),
                       r4("validation_metrics.mejora_sobre_naive").alias("mejora_sobre_naive"),
                       r4("validation_metrics.cv_error").alias("cv_error"),
                       r4("validation_metrics.outliers_ratio").alias("outliers_ratio"))


def _pred_quantile_ids(c: TCtx) -> DataFrame:
    ids = c.pred.pair_df.join(c.pred.counts.filter("trained"), "pair_id").select(
        "prefix_joined", "target", F.explode(F.array(F.lit("10"), F.lit("50"), F.lit("90"))).alias("q"))
    from racelens.functions.names import pred_model_id
    return ids.select(pred_model_id(F.col("prefix_joined"), F.col("target"), F.col("q")).alias("model_id"))


@query("model_ids")
def q_model_ids(spark, sf):
    """interpolation ids and per-quantile prediction ids of trained pairs."""
    c = TCtx(spark, sf)
    interp = c.interp.pair_df.join(c.interp.counts.filter("trained"), "pair_id").select(
        "model_id", F.lit("interpolacion").alias("kind"))
    return interp.unionByName(_pred_quantile_ids(c).withColumn("kind", F.lit("prediccion")))


@query("model_index")
def q_model_index(spark, sf):
    """Index of saved models: the approved interpolation models (the
    interpolation job's list) and the prediction files, which that trainer
    writes for every evaluated pair (three quantiles each)."""
    c = TCtx(spark, sf)
    interp = MF.model_index(c.interp.evaluation.filter("approved").select("model_id"))
    pred = MF.model_index(_pred_quantile_ids(c)).withColumnRenamed("modelos_disponibles", "modelos_prediccion")
    # both sides are one-row aggregates bounded by the grid; the second is read as a scalar
    return interp.select("modelos_disponibles",
                         F.lit(pred.first()["modelos_prediccion"]).alias("modelos_prediccion"))


@query("run_summary_write")
def q_run_summary_write(spark, sf):
    c = TCtx(spark, sf)
    saved = c.graded.evaluation.filter("approved").select(
        F.col("mae_folds_mean").alias("mae"), F.col("mae_folds_std").alias("mae_std"), F.col("n").alias("n_samples"))
    summ = P.metric_summary(saved)
    stats = P.validation_stats_interp(c.graded.gates, c.graded.counts)
    n = len(c.graded.splits)
    one = stats.select(
        F.lit("race_wide").alias("carrera"), F.lit(RUN_TS).alias("timestamp"),
        F.lit(n * (n - 1) // 2).alias("total_modelos_teoricos"), F.col("aprobados").alias("modelos_guardados"),
        F.lit(",".join(c.graded.splits)).alias("splits"),
        F.struct(*[F.lit(v).alias(k) for k, v in GBT_INTERP.items()]).alias("hiperparametros"),
        F.struct("total_evaluados", "aprobados", "rechazados", "insuficientes", "tasa_aprobacion",
                 "puntuacion_promedio").alias("validaciones"))
    s = summ.first()
    one = one.withColumn("metricas_resumen", F.struct(F.lit(s["mae_promedio"]).alias("mae_promedio"),
                                                      F.lit(s["mae_std_promedio"]).alias("mae_std_promedio"),
                                                      F.lit(s["total_muestras"]).alias("total_muestras")))
    path = scratch_path(spark, "run-summary")
    one.coalesce(1).write.mode("overwrite").json(path)
    back = spark.read.schema(one.schema).json(path)
    return back.select("carrera", "timestamp", "total_modelos_teoricos", "modelos_guardados", "splits",
                       F.col("hiperparametros.maxIter").alias("n_estimators"),
                       F.col("hiperparametros.maxDepth").alias("max_depth"),
                       r6("metricas_resumen.mae_promedio").alias("mae_promedio"),
                       F.col("metricas_resumen.total_muestras").alias("total_muestras"),
                       F.col("validaciones.total_evaluados").alias("total_evaluados"),
                       F.col("validaciones.aprobados").alias("aprobados"),
                       F.col("validaciones.insuficientes").alias("insuficientes"),
                       r4("validaciones.tasa_aprobacion").alias("tasa_aprobacion"))
