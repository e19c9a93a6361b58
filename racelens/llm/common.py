"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.session import scratch_path


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write `df` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that ran on it.
    """
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shared_by(spark: SparkSession, df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """`shared`, in buckets by `key`: a join on it with rows in as many partitions moves none of these.

    Such files are read through a table of the session; its entry goes at once, the files stay.
    """
    path = scratch_path(spark, name)
    table = path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(table)
    found = spark.table(table)
    spark.sql(f"DROP TABLE {table}")
    return found


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """One large-star or small-star step over edges (u, v) with u > v."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select(F.col("u").alias("k"), F.least("u", "m").alias("m"))
        out = both.where("v > u").join(low, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        low = edges.groupBy(F.col("u").alias("k")).agg(F.min("v").alias("m"))
        near = edges.join(low, F.col("u") == F.col("k"))
        out = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def components(spark: SparkSession, edges: DataFrame, name: str = "components") -> DataFrame:
    """Connected components of the edges (a long, b long).

    Returns (id, component): every vertex that an edge names and the smallest
    vertex of its component. Alternates large-star and small-star steps, so a
    round costs joins and grouped minima over the edges, and the number of
    rounds grows with the logarithm of the component sizes. Every round is
    written to the shared folder; only a count and a checksum reach the driver.
    """
    cur = edges.where("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    cur = shared(spark, cur, f"{name}-edges")
    seen = None
    while True:
        # a decimal sum cannot overflow and does not depend on the order of rows
        stamp = tuple(cur.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if stamp == seen or stamp[0] == 0:
            break
        seen = stamp
        cur = shared(spark, _stars(_stars(cur, True), False), f"{name}-round")
    roots = cur.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return cur.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
