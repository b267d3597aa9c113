"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library assumes. UTC makes date bucketing identical to the SQL
# oracle; ANSI stays on (the default in Spark 4), so the code uses try_* and
# explicit guards instead of relying on silent NULLs.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # Rule tables (row validation, level maps) build large CASE trees; the
    # optimizer's constraint inference over them grows combinatorially.
    "spark.sql.constraintPropagation.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # checkpoint files of unreachable DataFrames are deleted by the cleaner
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "riskspark", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster the submitter owns the session instead."""
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only
    when it is unset (local tests) a fresh scratch folder is created.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = tempfile.mkdtemp(prefix="riskspark-ckpt-", dir=os.environ.get("RISKSPARK_SCRATCH", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the checkpoint folder, deleted when the application ends."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    made = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = made.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(made)  # only what exists can be marked
    system.deleteOnExit(made)
    return path


def apply_session_defaults(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on (time zone) on a caller's session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.constraintPropagation.enabled", "false")
    return spark
