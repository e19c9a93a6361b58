"""Run manifests and metric files.

Every record is built as a Spark struct and written with Spark's writers;
reading back uses ``spark.read.json``/``csv`` with declared schemas. The
records are per request or per model, so a write is parallel over them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.operators.history import KIND_DIRECT, KIND_IMPOSSIBLE, KIND_INTERP

# --- fixed values -----------------------------------------------------------
DEFAULT_SPLIT_COUNT = 12      # default record when no manifest can be found
DEFAULT_RACES_USED = 1
# ----------------------------------------------------------------------------


def manifest_records(requests: DataFrame, plan: DataFrame, selection: DataFrame, names: DataFrame,
                     sources: DataFrame, run_ts) -> DataFrame:
    """One run record per request with history (nested struct)."""
    p = plan.groupBy("req_key").agg(
        F.array_sort(F.collect_list(F.struct("ord", "split", "kind", "source", "source_km", "target_km",
                                             "diff_km"))).alias("rows"))
    items = F.col("rows")
    final = F.transform(F.filter(items, lambda r: r["kind"] != KIND_IMPOSSIBLE), lambda r: r["split"])
    analysis = F.struct(
        F.transform(F.filter(items, lambda r: r["kind"] == KIND_DIRECT), lambda r: r["split"]).alias("splits_directos"),
        F.transform(F.filter(items, lambda r: r["kind"] == KIND_INTERP), lambda r: F.struct(
            r["split"].alias("split_objetivo"), r["source"].alias("split_origen"),
            r["target_km"].alias("distancia_objetivo"), r["source_km"].alias("distancia_origen"),
            r["diff_km"].alias("diferencia"))).alias("splits_interpolables"),
        F.transform(F.filter(items, lambda r: r["kind"] == KIND_IMPOSSIBLE), lambda r: r["split"]).alias("splits_imposibles"),
        F.map_from_entries(F.transform(F.filter(items, lambda r: r["kind"] != KIND_IMPOSSIBLE), lambda r: F.struct(
            r["split"], F.struct(r["kind"].alias("tipo"), r["source"].alias("origen"),
                                 F.when(r["kind"] == KIND_DIRECT, r["target_km"]).otherwise(r["source_km"])
                                 .alias("distancia"))))).alias("mapping"))
    s = selection.groupBy("req_key").agg(F.array_sort(F.collect_list(F.struct("rank", "race_id", "event_id")))
                                         .alias("used"))
    r = requests.select("req_key", "nombre", "splits")
    j = r.join(p, "req_key").join(s, "req_key").join(names, "req_key").join(sources, "req_key")
    return j.select(
        "req_key",
        F.struct(F.col("nombre").alias("carrera"), run_ts.alias("timestamp"),
                 F.col("splits").alias("splits_originales"),
                 F.transform("splits", lambda x: F.replace(x, F.lit("."), F.lit("_"))).alias("splits_normalizados"),
                 final.alias("splits_finales"), analysis.alias("analisis"),
                 F.col("source_table").alias("tabla_fuente"), F.col("result_table").alias("tabla_generada"),
                 F.transform("used", lambda u: F.struct(u["race_id"].alias("race_id"), u["event_id"].alias("event_id")))
                 .alias("carreras_utilizadas"),
                 F.size("used").alias("carreras_usadas")).alias("m"))


def write_manifests(records: DataFrame, path: str) -> str:
    """One JSON line per request record, folder per request."""
    records.select(F.col("req_key"), "m.*").write.mode("overwrite").partitionBy("req_key").json(path)
    return path


MANIFEST_SCHEMA = (
    "carrera string, timestamp string, splits_originales array<string>, splits_normalizados array<string>, "
    "splits_finales array<string>, analisis struct<splits_directos:array<string>, "
    "splits_interpolables:array<struct<split_objetivo:string,split_origen:string,distancia_objetivo:double,"
    "distancia_origen:double,diferencia:double>>, splits_imposibles:array<string>, "
    "mapping:map<string,struct<tipo:string,origen:string,distancia:double>>>, tabla_fuente string, "
    "tabla_generada string, carreras_utilizadas array<struct<race_id:string,event_id:string>>, "
    "carreras_usadas int")


def read_manifests(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST_SCHEMA + ", req_key string").json(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that its address names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def manifest_read_first(spark: SparkSession, candidates: list[str]) -> DataFrame:
    """The first readable manifest among candidate places (priority order).

    All candidates are read in one job; unreadable files are skipped; the
    winner is ``min_by(record, priority)``."""
    existing = [p for p in candidates if path_exists(spark, p)]
    if not existing:
        return spark.createDataFrame([], MANIFEST_SCHEMA)
    df = (spark.read.schema(MANIFEST_SCHEMA + ", _corrupt_record string")
          .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record")
          .json(existing).withColumn("_file", F.col("_metadata.file_path")))
    df = df.filter(F.col("_corrupt_record").isNull() & F.col("carrera").isNotNull())
    prio = F.coalesce(*[F.when(F.col("_file").contains(p.split(":", 1)[-1].rstrip("/") + "/"), F.lit(i)) for i, p in enumerate(existing)],
                      F.lit(len(existing)))
    best = df.select(F.struct(*[F.col(c) for c in MANIFEST_SCHEMA_COLS]).alias("m"), prio.alias("prio")) \
        .agg(F.min_by("m", "prio").alias("m"))
    return best.select("m.*").filter(F.col("carrera").isNotNull())


MANIFEST_SCHEMA_COLS = [c.strip().split(" ")[0] for c in
                        ["carrera", "timestamp", "splits_originales", "splits_normalizados", "splits_finales",
                         "analisis", "tabla_fuente", "tabla_generada", "carreras_utilizadas", "carreras_usadas"]]


JOB_RECORD_DDL = ("carrera string, carpeta_modelo string, data_path string, tabla_generada string, splits int, "
                  "splits_originales int, splits_interpolados int, splits_imposibles int, carreras_usadas int")


def job_outputs(summary: DataFrame, run_ts: str, base: str) -> DataFrame:
    """The job output of one run, one record per trained request (from P9).

    Stored as JSON Lines, one record per line, so nothing gathers the batch
    into a single value."""
    folder = F.concat_ws("-", "nombre", F.lit(run_ts))
    return summary.select(
        F.col("nombre").alias("carrera"), folder.alias("carpeta_modelo"),
        F.concat(F.lit(base), F.lit("/modelos/"), folder, F.lit("/data/")).alias("data_path"),
        F.replace(F.concat(F.lit("modelo_"), F.regexp_replace("nombre", r"[^a-zA-Z0-9_-]", "_"),
                           F.lit("_"), F.lit(run_ts)), F.lit("-"), F.lit("_")).alias("tabla_generada"),
        *[F.col(c).cast("int").alias(c) for c in ("splits", "splits_originales", "splits_interpolados",
                                                  "splits_imposibles", "carreras_usadas")])


def write_job_output(outputs: DataFrame, folder: str, run_ts: str) -> str:
    path = f"{folder}/salida_step_{run_ts.replace('-', '_')}"
    outputs.write.mode("overwrite").json(path)
    return path


def latest_job_output(spark: SparkSession, folder: str, generated_at: str | None, race: str = "desconocida",
                      base: str = "models") -> DataFrame:
    """The records of the output for ``generated_at``; else of the most
    recently modified output (true maximum over all files); else one default
    record. The chosen file is a scalar picked by one aggregate."""
    empty = spark.createDataFrame([], JOB_RECORD_DDL)
    if not generated_at:
        return empty
    folder_name = f"{race}-{generated_at}"
    default = spark.createDataFrame([(race, folder_name, f"{base}/modelos/{folder_name}/data/",
                                      f"modelo_{race.replace('-', '_')}_{generated_at.replace('-', '_')}",
                                      DEFAULT_SPLIT_COUNT, None, None, None, DEFAULT_RACES_USED)], JOB_RECORD_DDL)
    if not path_exists(spark, folder):
        return default
    df = (spark.read.schema(JOB_RECORD_DDL).option("recursiveFileLookup", "true").json(folder)
          .select("*", F.col("_metadata.file_path").alias("path"),
                  F.col("_metadata.file_modification_time").alias("mtime")))
    wanted = f"salida_step_{generated_at.replace('-', '_')}"
    run_dir = F.regexp_extract("path", r"(salida_step_[^/]+)", 1)
    best = df.agg(F.max_by(run_dir, F.struct(run_dir.contains(wanted), F.col("mtime"))).alias("d")).first()
    if best is None or best["d"] is None:
        return default
    found = df.filter(run_dir == best["d"]).drop("path", "mtime")
    # another run's output stands in: its records get this run's folder, data path and table name
    return found if wanted in best["d"] else rewrite_records(found, F.lit(generated_at), base)


def rewrite_records(outputs: DataFrame, generated_at, base: str = "models") -> DataFrame:
    """Re-derive folder, data path and table name of every record from its
    own race and the run stamp."""
    folder = F.concat(F.col("carrera"), F.lit("-"), generated_at)
    return outputs.withColumns({
        "carpeta_modelo": folder,
        "data_path": F.concat(F.lit(base), F.lit("/modelos/"), folder, F.lit("/data/")),
        "tabla_generada": F.concat(F.lit("modelo_"), F.replace(F.col("carrera"), F.lit("-"), F.lit("_")),
                                   F.lit("_"), F.replace(generated_at, F.lit("-"), F.lit("_")))})


def metrics_records(evaluation: DataFrame) -> DataFrame:
    """One nested record per model (regression + validation metrics)."""
    return evaluation.select(
        "model_id",
        F.struct(F.struct(F.col("mae_folds_mean").alias("value"), F.col("mae_folds_std").alias("standard_deviation"))
                 .alias("mae"), F.struct(F.col("r2").alias("value")).alias("r2"),
                 F.struct(F.col("n").alias("value")).alias("n_samples")).alias("regression_metrics"),
        F.struct(F.col("score").alias("calidad"), F.col("approved").alias("aprobado"),
                 F.col("improvement").alias("mejora_sobre_naive"), F.col("cv").alias("cv_error"),
                 F.col("ratio").alias("outliers_ratio")).alias("validation_metrics"))


def write_metrics_json(records: DataFrame, path: str) -> str:
    records.write.mode("overwrite").partitionBy("model_id").json(path)
    return path


def write_csv(df: DataFrame, path: str) -> str:
    """CSV with a header line."""
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)


def model_index(ids: DataFrame) -> DataFrame:
    """JSON list of model ids, sorted (bounded by the grid x quantiles)."""
    return ids.agg(F.to_json(F.array_sort(F.collect_list("model_id"))).alias("modelos_disponibles"))


def save_if_absent(spark: SparkSession, df: DataFrame, table: str, path: str) -> bool:
    """Register ``table`` at ``path`` unless it exists; True when reused."""
    if spark.catalog.tableExists(table):
        return True
    df.write.mode("ignore").option("path", path).saveAsTable(table)
    return False
