"""Reuse of materialised tables by content address.

A table is named by what it holds: its split set, its columns and the state of
the files it comes from. Whoever needs a table that is not there yet writes it,
all missing ones in one job, into a folder of its own and puts a marker in it
at the end. Only marked folders are read. Two jobs that race both write; as
equal addresses mean equal rows, readers take the first marked folder of each
address and never both. A job that dies leaves an unmarked folder, which
nobody reads. No rename or lock is needed, so this holds on object stores too.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.sources.wide import listing

MARKER = "COMMITTED"
RECORD_DDL = "address string, table_name string, attempt string"


def snapshot(spark: SparkSession, path: str) -> str:
    """State of the files below a folder: their number and a checksum of names, sizes and times (no content is read)."""
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    found = listing(spark, path).agg(F.count(F.lit(1)).alias("n"), F.sum(one).alias("h")).first()
    return f"{found['n']}:{found['h']}"


def address(table_name, columns, state: str) -> F.Column:
    """Content address of a table: name of the split set, columns, and state of the source."""
    return F.substring(F.sha2(F.concat_ws("|", table_name, F.array_join(columns, ","), F.lit(state)), 256), 1, 24)


def _committed(spark: SparkSession, base: str) -> list[str]:
    """Names of the marked folders, in the order in which they were begun."""
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(f"{base}/*/{MARKER}")
    found = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(place)
    return sorted(f.getPath().getParent().getName() for f in found or [])


def _commit(spark: SparkSession, folder: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{MARKER}")
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, False).close()


def registered(spark: SparkSession, base: str) -> DataFrame:
    """(address, table_name, attempt) of every table that is there, each once."""
    done = _committed(spark, base)
    if not done:
        return spark.createDataFrame([], RECORD_DDL)
    every = spark.read.schema(RECORD_DDL).parquet(*[f"{base}/{a}/records" for a in done])
    return every.groupBy("address").agg(F.min_by("table_name", "attempt").alias("table_name"), F.min("attempt").alias("attempt"))


def reuse_or_write(spark: SparkSession, base: str, wanted: DataFrame, rows: DataFrame) -> DataFrame:
    """Writes the tables of ``wanted`` (address, table_name) that are not there yet.

    ``rows`` holds the rows of all tables with their address; only those of
    missing tables are written. Returns ``wanted`` with ``reused``."""
    wanted = wanted.select("address", "table_name").distinct()
    have = registered(spark, base).select("address", F.lit(True).alias("reused"))
    state = wanted.join(have, "address", "left").withColumn("reused", F.coalesce("reused", F.lit(False))).checkpoint()
    missing = state.filter(~F.col("reused"))
    if not missing.isEmpty():
        attempt = f"{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        folder = f"{base}/{attempt}"
        # ranges of addresses: footers tell which files hold a table, and a large one is cut into several; no task sorts
        (rows.join(F.broadcast(missing.select("address")), "address", "left_semi")     # a row per table
         .repartitionByRange("address", F.xxhash64(*[c for c in rows.columns if c != "address"])).write.parquet(f"{folder}/rows"))
        missing.select("address", "table_name", F.lit(attempt).alias("attempt")).write.parquet(f"{folder}/records")
        _commit(spark, folder)
    return state


def read_tables(spark: SparkSession, base: str, schema: str) -> DataFrame:
    """Rows of every registered table with ``address``, from the first marked folder of each."""
    done, out = _committed(spark, base), spark.createDataFrame([], f"address string, attempt string, {schema}")
    if done:
        every = spark.read.schema(f"address string, {schema}").parquet(*[f"{base}/{a}/rows" for a in done])
        # the folder's name tells the attempt
        out = every.withColumn("attempt", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -3))
    return out.join(registered(spark, base), ["address", "attempt"]).drop("attempt")
