"""Wide results table on disk.

The wide table is Parquet partitioned by ``race_id``/``event_id``. A request
declares its columns (S3 parses the definitions); a declared split that a
file lacks reads as null (by-name Parquet resolution). Chosen (race, event)
pairs become a literal predicate, which Spark turns into ``PartitionFilters``
(static pruning: only the chosen directories are listed and read).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as fs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racelens.session import scratch_path

STANDARD_COLUMNS = [("finisher_id", "bigint"), ("athlete_id", "string"), ("event_std", "string"),
                    ("gender", "string"), ("age", "int")]
PARTITION_COLUMNS = [("race_id", "string"), ("event_id", "string")]
DEF_PATTERN = r'^\s*"?([^"\s]+)"?\s*([A-Za-z0-9_<>,()]*)\s*$'
MAX_RECORDS_PER_FILE = 5_000_000
PROBE_ROWS = 65_536


def parse_column_defs(defs: DataFrame, col: str = "definition") -> DataFrame:
    """S3: '"name" type' -> (name, type); the type defaults to string."""
    name = F.regexp_extract(F.col(col), DEF_PATTERN, 1)
    typ = F.regexp_extract(F.col(col), DEF_PATTERN, 2)
    return defs.select("*", name.alias("name"),
                       F.when(typ == "", F.lit("string")).otherwise(F.lower(typ)).alias("type"))


def ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in columns)


def write_partitioned(wide: DataFrame, path: str, odd_year_suffix: str = "_0") -> str:
    """Write the wide table partitioned by race and event; odd years store
    their splits under the '_0' spelling (editions differ in naming).

    Rows are range-partitioned and sorted by race, event and finisher, so every
    task writes a contiguous run of directories with one open file at a time,
    and a hot (race, event) is cut by finisher into several ranges."""
    splits = [c for c in wide.columns if c.startswith("km_")]
    year = F.element_at(F.split("race_id", "-"), -1).try_cast("int")
    even = wide.filter(year % 2 == 0)
    odd = wide.filter(year % 2 == 1).select(
        *[F.col(c).alias(c + odd_year_suffix) if c in splits else F.col(c) for c in wide.columns])
    n = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for part in (even, odd):
        (part.repartitionByRange(n, "race_id", "event_id", "finisher_id").sortWithinPartitions("race_id", "event_id")
         .write.mode("append")
         .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE).option("compression", "snappy")
         .partitionBy("race_id", "event_id").parquet(path))
    return path


def read_declared(spark: SparkSession, path: str, split_columns: list[str],
                  pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """S2 (+S4): read with a declared schema; optionally prune to chosen pairs."""
    schema = ddl(STANDARD_COLUMNS + [(s, "double") for s in split_columns] + PARTITION_COLUMNS)
    # only partition directories: a manifest or junk next to them is not data
    df = (spark.read.schema(schema).option("basePath", path)
          .parquet(f"{path}/race_id=*"))
    if pairs is not None:
        from racelens.operators.training_table import literal_pair_filter
        cond = literal_pair_filter(pairs)
        df = df.filter(cond if cond is not None else F.lit(False))
    return df


def stored_splits(spark: SparkSession, path: str) -> list[str]:
    """Split columns that any stored edition has, in every spelling (from the files' footers)."""
    names = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(f"{path}/race_id=*").columns
    known = {n for n, _ in STANDARD_COLUMNS + PARTITION_COLUMNS}
    return [n for n in names if n not in known]


def listing(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modificationTime) of every file below a folder that is not empty; no content is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            .select("path", "length", "modificationTime"))


def _open(path: str):
    """Opens a file under the address that Hadoop gives it."""
    scheme, _, rest = path.partition(":")
    if scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/"))
    host, _, place = rest.lstrip("/").partition("/")
    system, root = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_file(f"{root.rstrip('/')}/{place}")


def _probe(batches: Iterator[pa.RecordBatch], deep: bool) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for path, length in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n, reason = None, None
            with _open(path) as f:
                try:
                    file = pq.ParquetFile(f, page_checksum_verification=True)
                    n = file.metadata.num_rows
                    if deep and sum(len(x) for x in file.iter_batches(batch_size=PROBE_ROWS)) != n:
                        reason = "row groups hold another number of rows than the footer says"
                except (pa.ArrowException, OSError) as e:
                    n, reason = None, f"{type(e).__name__}: {e}"[:300]
            rows.append((path, length, n, reason))
        c = list(zip(*rows, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c[0], pa.string()), pa.array(c[1], pa.int64()),
                                          pa.array(c[2], pa.int64()), pa.array(c[3], pa.string())],
                                         names=["path", "length", "n_rows", "reason"])


def probe(spark: SparkSession, path: str, deep: bool = True) -> DataFrame:
    """(path, length, n_rows, reason) of every file below ``path``; reason is null where it can be read whole.

    Footers, and with ``deep`` every row group with its page checksums, are read
    by the tasks, a batch of rows at a time."""
    files = listing(spark, path).select("path", "length")
    return files.mapInArrow(lambda b: _probe(b, deep), "path string, length long, n_rows long, reason string")


def recursive_load(spark: SparkSession, path: str, quarantine: str | None = None, deep: bool = True) -> DataFrame:
    """Every sound Parquet file below ``path``, columns merged by name.

    Files that cannot be read whole (the JSON manifest, junk, damaged data) are
    left out as a whole and listed with the reason below ``quarantine``; a file
    that is damaged after the probe fails the load. Partition directories give
    no columns in this mode. Fails when no file is sound."""
    report = quarantine or scratch_path(spark, "probe")
    probe(spark, path, deep).write.parquet(report)
    found = spark.read.schema("path string, length long, n_rows long, reason string").parquet(report)
    # the names of the files, as Spark's own listing holds them
    sound = [r["path"] for r in found.filter(F.col("reason").isNull()).select("path").toLocalIterator()]
    if not sound:
        raise FileNotFoundError(f"no readable Parquet file below {path}")
    literal = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p in sound]
    return spark.read.option("recursiveFileLookup", "true").option("mergeSchema", "true").parquet(*literal)
