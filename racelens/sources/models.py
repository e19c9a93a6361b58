"""Model store: fitted models as Parquet rows, committed by a manifest that is written last.

A reader takes only what the manifest vouches for, so a store that a failed or
a running job has left half-written is not read.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from racelens.session import path_exists


def save_models(models: DataFrame, path: str) -> str:
    """Writes the models (one row each) and then the manifest with their number and columns."""
    models.write.parquet(f"{path}/models")
    spark = models.sparkSession
    kept = spark.read.schema(models.schema).parquet(f"{path}/models")
    kept.agg(F.count(F.lit(1)).alias("n_models")).withColumn("columns", F.lit(models.schema.json())) \
        .coalesce(1).write.json(f"{path}/manifest")
    return path


def load_models(spark: SparkSession, path: str) -> DataFrame:
    """The models of a committed store, under the schema they were saved with."""
    if not path_exists(spark, f"{path}/manifest/_SUCCESS"):
        raise FileNotFoundError(f"no committed models in {path}")
    record = spark.read.json(f"{path}/manifest").first()   # one row
    return spark.read.schema(StructType.fromJson(json.loads(record["columns"]))).parquet(f"{path}/models")
