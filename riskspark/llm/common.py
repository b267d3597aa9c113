"""Small helpers of the text operators: inputs, checkpoints, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import riskspark
from riskspark.session import ensure_checkpoint_dir

#: Rows up to which a table of ids or digests (at most 40 bytes a row, so 20 MB) is broadcast.
BROADCAST_ROWS = 500_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to the shared checkpoint folder and read back: its
    lineage is cut, a lost executor loses nothing of it, and its size is that of the
    files (``DataFrame.checkpoint`` hands on the plan's estimate, which joins in a
    loop multiply without end). ``released`` deletes the files; what is left goes
    when the application ends."""
    spark = df.sparkSession
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/text-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    path, fs = _path(spark, folder)
    fs.deleteOnExit(path)
    out = spark.read.schema(df.schema).parquet(folder)
    out.written_to = folder
    return out


def released(*frames: DataFrame) -> None:
    """Delete the files of ``checkpointed`` frames that nothing reads any more."""
    for df in frames:
        path, fs = _path(df.sparkSession, df.written_to)
        fs.delete(path, True)


def _path(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def narrow(df: DataFrame, rows: int) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are few, else as it is
    (Spark then shuffles both sides of the join)."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the Python workers this package (once per application), so that a
    task's functions load wherever the driver was started from."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(riskspark.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="riskspark-py-")) / "riskspark.zip"  # served to executors by the driver
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(top.rglob("*.py")):
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)
