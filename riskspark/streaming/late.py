"""A sink that loses no row: on time, late, or delivered again.

Spark's stateful operators drop rows behind the watermark without a word. This
``foreachBatch`` sink keeps the same bound (largest event time of the batches
before, less the delay) in its own folder and writes every row of a batch to
one of three tables:

* ``rows``: on time, the first with its id within the bound;
* ``late``: behind the bound (``reason`` late), or without a time (no_time);
* ``repeats``: (application_id, n), deliveries beyond the first.

So rows in = rows + late + sum of ``n``, at any time. Each batch writes the
folders of its id, and reads only those of smaller ids, so a batch delivered
again after a restart changes nothing. Rows without an id are never repeats.
Of rows with one id in one batch the earliest is kept (ties: the smallest by
all columns).

Ids are compared with those of rows not older than the bound, which is the
part of the log that such a sink can be asked to remember; an older repeat is
behind the bound itself, and so late. Repeats are counted by an aggregate, so
one id sent millions of times is no hot task.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = ("rows", "late", "repeats")


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    full = T.StructType(schema.fields + [T.StructField("batch", T.LongType())])
    try:
        return spark.read.schema(full).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def _schemas(schema: T.StructType) -> dict[str, T.StructType]:
    return {"rows": schema, "late": T.StructType(schema.fields + [T.StructField("reason", T.StringType())]),
            "repeats": T.StructType([T.StructField("application_id", T.StringType()), T.StructField("n", T.LongType())])}


def read_late(spark: SparkSession, path: str, schema: T.StructType) -> dict[str, DataFrame]:
    """The three tables of all batches so far."""
    return {t: _stored(spark, f"{path}/{t}", s).drop("batch") for t, s in _schemas(schema).items()}


def split_batch(batch: DataFrame, batch_id: int, path: str, ts: str = "ts", delay: str = "1 day") -> None:
    """Write one batch's rows to the three tables and its largest time to ``bound``."""
    spark = batch.sparkSession
    bounds = _stored(spark, f"{path}/bound", T.StructType([T.StructField("high", T.TimestampType())]))
    bound = bounds.filter(F.col("batch") < batch_id).agg((F.max("high") - F.expr(f"interval {delay}")).alias("b")).first()["b"]
    batch = batch.persist()
    try:
        at = F.col(ts)
        behind = F.lit(False) if bound is None else at < F.lit(bound)
        reason = F.when(at.isNull(), "no_time").when(behind, "late")
        marked = batch.withColumn("reason", reason)
        marked.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")

        timely = marked.filter(F.col("reason").isNull()).drop("reason")
        names = timely.columns
        first = F.min(F.struct(ts, *[c for c in names if c != ts]))
        once = (timely.filter(F.col("application_id").isNotNull())
                .groupBy(F.col("application_id").cast("string").alias("_id")).agg(first.alias("_row"), F.count(F.lit(1)).alias("_n")))
        seen = _stored(spark, f"{path}/rows", batch.schema).filter(F.col("batch") < batch_id)
        if bound is not None:
            seen = seen.filter(at >= F.lit(bound))
        seen = seen.filter(F.col("application_id").isNotNull()).select(F.col("application_id").cast("string").alias("_id")).distinct()
        once = once.join(seen.withColumn("_seen", F.lit(1)), "_id", "left")
        new = once.filter(F.col("_seen").isNull()).select(*[F.col("_row")[c].alias(c) for c in names])
        new = new.unionByName(timely.filter(F.col("application_id").isNull()))
        new.write.mode("overwrite").parquet(f"{path}/rows/batch={batch_id}")
        again = F.col("_n") - F.when(F.col("_seen").isNull(), 1).otherwise(0)
        (once.select(F.col("_id").alias("application_id"), again.cast("long").alias("n")).filter(F.col("n") > 0)
         .write.mode("overwrite").parquet(f"{path}/repeats/batch={batch_id}"))
        batch.agg(F.max(at).alias("high")).write.mode("overwrite").parquet(f"{path}/bound/batch={batch_id}")
    finally:
        batch.unpersist()


def quarantine_late(preds: DataFrame, path: str, checkpoint: str, ts: str = "ts", delay: str = "1 day") -> dict[str, DataFrame]:
    """Run :func:`split_batch` over all that ``preds`` has now; the three tables as stored."""
    query = (preds.writeStream.foreachBatch(lambda batch, i: split_batch(batch, i, path, ts, delay))
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return read_late(preds.sparkSession, path, preds.schema)
