"""Tables bucketed on their join key.

A prediction log and its outcomes are joined on ``application_id`` again and
again. Stored with the same number of buckets on that column, sorted inside
them, both sides are read bucket by bucket and the join needs no exchange: the
shuffle is paid once, when rows come in. The number of buckets is a property
of the pair of tables: choose it so that a bucket fits a task at the size the
log will have (about 1 GB: 100 TB are some 100,000 buckets).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, name: str, key: str, n_buckets: int, path: str | None = None,
                   mode: str = "overwrite") -> DataFrame:
    """Store ``df`` as table ``name``, bucketed and sorted on ``key`` (as a
    string, so that equal ids fall in equal buckets on both sides); rows are
    dealt to their bucket first, so that each write adds one file a bucket.

    A NULL key stays in the table. ``mode="append"`` adds rows; the sort then
    holds in each file only, which costs the join a local sort, no exchange.
    """
    rows = df.withColumn(key, F.col(key).cast("string")).repartition(n_buckets, key)
    writer = rows.write.mode(mode).format("parquet").bucketBy(n_buckets, key).sortBy(key)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def join_bucketed(spark: SparkSession, log: str, outcomes: str, key: str = "application_id") -> DataFrame:
    """Logged predictions with their outcome, bucket by bucket. NULL ids are
    dropped, repeated outcome ids fan out."""
    preds = spark.table(log).filter(F.col(key).isNotNull())
    return preds.join(spark.table(outcomes).hint("merge"), key)
