"""Catalog document (S1): ``{"carreras": {key: {race_id, event_id, event_std?, splits[]}}}``.

The document format is one JSON object, so a single task writes and a single
reader task parses it; it is an export for catalogs that fit one value.
``posexplode`` of the parsed map keeps document order, which the history
selection uses to break ties. A JSON-Lines catalog (one entry per line) is
written and read in parallel; ``positioned`` gives its entries their document
order as a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

ENTRY_SCHEMA = "struct<race_id:string,event_id:string,event_std:string,splits:array<string>>"
DOC_SCHEMA = f"struct<carreras:map<string,{ENTRY_SCHEMA}>>"
ENTRY_DDL = "race_id string, event_id string, event_std string, splits array<string>"
POSITION_DDL = "cat_pos int, entry_key string"


def write_catalog_document(catalog: DataFrame, path: str) -> str:
    """Write the catalog as ONE document, entries sorted by race and event."""
    entry = F.concat(F.lit('"'), F.concat_ws("_", "race_id", "event_id"), F.lit('": '),
                     F.to_json(F.struct("race_id", "event_id", "event_std", "splits")))
    doc = (catalog.select("race_id", "event_id", entry.alias("e"))
           .agg(F.array_sort(F.collect_list(F.struct("race_id", "event_id", "e"))).alias("entries"))
           .select(F.concat(F.lit('{"carreras": {'),
                            F.array_join(F.transform("entries", lambda x: x["e"]), ", "),
                            F.lit("}}")).alias("value")))
    doc.coalesce(1).write.mode("overwrite").text(path)
    return path


def read_catalog_document(spark: SparkSession, path: str) -> DataFrame:
    """Parse the document, one row per entry with its document position."""
    raw = spark.read.text(path, wholetext=True)
    parsed = raw.select(F.from_json("value", DOC_SCHEMA).alias("d"))
    return (parsed.select(F.posexplode("d.carreras").alias("cat_pos", "entry_key", "e"))
            .select("cat_pos", "entry_key", "e.race_id", "e.event_id", "e.event_std", "e.splits"))


def positioned(catalog: DataFrame, parts: int | None = None) -> DataFrame:
    """The catalog with each entry's document position and key.

    Entries are cut into contiguous ranges, checkpointed once because range
    bounds are sampled, and numbered within; only one count per range is summed
    in order.
    """
    by = ["race_id", "event_id"]
    cut = catalog.repartitionByRange(parts, *by) if parts else catalog.repartitionByRange(*by)
    cut = cut.withColumn("_part", F.spark_partition_id()).checkpoint()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = cut.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy("_part").orderBy(*by)) - 1
    return (cut.withColumn("_nth", nth).join(F.broadcast(starts), "_part")
            .select((F.col("_start") + F.col("_nth")).cast("int").alias("cat_pos"),
                    F.concat_ws("_", *by).alias("entry_key"), *catalog.columns))


def write_catalog_lines(catalog: DataFrame, path: str) -> str:
    """Catalog as JSON Lines, one entry per line, written by every task; with
    the position columns where it has them."""
    extra = [x for x in ("cat_pos", "entry_key") if x in catalog.columns]
    catalog.select(*extra, "race_id", "event_id", "event_std", "splits").write.mode("overwrite").json(path)
    return path


def read_catalog_lines(spark: SparkSession, path: str, with_position: bool = False) -> DataFrame:
    """Catalog as JSON Lines (one entry per line), read in parallel."""
    return spark.read.schema(f"{POSITION_DDL}, {ENTRY_DDL}" if with_position else ENTRY_DDL).json(path)
