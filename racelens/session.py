"""Session construction and the shared scratch folder.

Intermediate files (catalog documents, partitioned wide tables, manifests)
are written below the folder that the cluster names in
``spark.checkpoint.dir``. A local folder is created only when the session
runs in local mode and no checkpoint folder is configured (tests, bench).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # partition sizing: 256 MB scan splits and shuffle targets keep a task's
    # working set well inside executor memory; AQE coalesces small ones

    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "racelens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library expects."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shuffle_partitions_for(input_bytes: int, total_cores: int, target_bytes: int = 256 * 1024 * 1024) -> int:
    """Initial shuffle partitions for a cluster run: enough for ~256 MB per
    partition of the input (AQE coalesces what turns out small), never fewer
    than two waves of tasks over the cores."""
    return max(2 * total_cores, -(-input_bytes // target_bytes))


def input_size(spark: SparkSession, paths: list[str]) -> int:
    """Total bytes below the given paths (file listing only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    total = 0
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        total += path.getFileSystem(conf).getContentSummary(path).getLength()
    return total


def path_exists(spark: SparkSession, path: str) -> bool:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(found)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    local = tempfile.mkdtemp(prefix="racelens-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "racelens", f"{name}-{uuid.uuid4().hex[:12]}")
