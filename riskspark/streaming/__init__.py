"""Structured Streaming versions of scoring and monitoring.

* ``score_stream``        – applications arriving as files -> validated, scored
                            records appended to a JSON log (checkpointed sink).
* ``daily_windows``       – 1-day tumbling windows (n, mean p, reject rate)
                            with a watermark: append mode emits closed days,
                            state stays bounded.
* ``with_end_marker``     – ends a finite feed with a later marker row, so that
                            its last windows close and are emitted too.
* ``dedup_predictions``   – drop repeated application ids within the watermark.
* ``join_outcomes_stream``– stream-static join of predictions and outcomes.
* ``psi_bin_counts`` + ``psi_by_window`` – per-window bin counts against
                            static reference edges; PSI per closed window,
                            suppressed below the minimum sample size.
* ``run_available``       – run a query over everything available now and
                            return the written result as a batch DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.functions.bands import decision
from riskspark.operators.contracts import with_violations
from riskspark.schema import DECISION_THRESHOLD, PSI_MIN_SAMPLES, PSI_SHARE_FLOOR
from riskspark.session import ensure_checkpoint_dir


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def score_stream(stream: DataFrame, model, threshold: float = DECISION_THRESHOLD,
                 model_name: str = "model") -> DataFrame:
    """Validated rows scored with ``model`` (narrow: no state, no shuffle).
    Rows breaking a field rule are dropped here; ``quarantine_stream`` keeps them."""
    v = with_violations(stream)
    ok = v.filter(F.size("violations") == 0).drop("violations")
    s = model.score(ok)
    return s.withColumns({"decision": decision("p_default", threshold),
                          "threshold": F.lit(float(threshold)), "model": F.lit(model_name)})


def quarantine_stream(stream: DataFrame) -> DataFrame:
    return with_violations(stream).filter(F.size("violations") > 0)


def daily_windows(preds: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Per 1-day window: n, mean p_default, reject rate; late rows beyond the
    watermark are dropped and each window's state is freed once it closes."""
    return (preds.withWatermark(ts, delay)
            .groupBy(F.window(F.col(ts), "1 day").alias("w"))
            .agg(F.count(F.lit(1)).alias("n"), F.avg("p_default").alias("mean_p_default"),
                 F.avg((F.col("decision") == "reject").cast("double")).alias("reject_rate"))
            .select(F.date_format(F.col("w.start"), "yyyy-MM-dd").alias("date"), "n", "mean_p_default",
                    "reject_rate"))


def with_end_marker(feed: DataFrame, last, ts: str = "ts", later: str = "10 days") -> DataFrame:
    """``feed`` and one row, all NULL but for a time ``later`` than ``last``, the
    feed's last one. It moves the watermark past the windows that would stay
    open at the end of a finite feed; its own window never closes. ``later``
    must be over the window's length plus the watermark's delay."""
    spark = feed.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/marker-{uuid.uuid4().hex}"
    at = (F.lit(last).cast("timestamp") + F.expr(f"interval {later}"))
    row = [at.alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in feed.schema.fields]
    spark.range(1).select(*row).write.parquet(path)
    return feed.unionByName(spark.readStream.schema(feed.schema).parquet(path))


def dedup_predictions(preds: DataFrame, ts: str = "ts", delay: str = "1 day") -> DataFrame:
    """Keep the first record per application_id within the watermark delay."""
    return preds.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["application_id"])


def join_outcomes_stream(preds: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Stream-static inner join on application_id (outcomes as a static table)."""
    return preds.filter(F.col("application_id").isNotNull()).join(outcomes, "application_id", "inner")


def join_outcome_streams(preds: DataFrame, outcomes: DataFrame, within: str = "10 days", ts: str = "ts",
                         outcome_ts: str = "outcome_ts", delay: str = "1 day") -> DataFrame:
    """Each prediction with the outcome that came within ``within`` of it, or with NULLs once both
    watermarks say that none can come any more.

    Both sides are streams with a watermark, so the state holds a prediction for ``within`` plus the
    delay at most, and an outcome no longer than that. An outcome before its prediction or after the interval does not
    match. A NULL id moves the watermark and is left out."""
    # naming the time keeps the filters behind the watermarks, which the rows that they drop have to move
    left = preds.withWatermark(ts, delay).filter(F.col("application_id").isNotNull() | F.col(ts).isNull())
    right = (outcomes.select(F.col("application_id").alias("_id"), F.col(outcome_ts), "actual")
             .withWatermark(outcome_ts, delay).filter(F.col("_id").isNotNull() | F.col(outcome_ts).isNull()))
    cond = ((F.col("application_id") == F.col("_id")) & (F.col(outcome_ts) >= F.col(ts))
            & (F.col(outcome_ts) <= F.col(ts) + F.expr(f"interval {within}")))
    return left.join(right, cond, "leftOuter").drop("_id")


def write_feed(df: DataFrame, path: str, ts: str, bounds: list, last, later: str) -> None:
    """``df`` as a feed of files in time order, cut at ``bounds``, and a last file with one row, all NULL but for a
    time ``later`` than ``last``, which lets everything before it close."""
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:]):
        part = df if low is None else df.filter(F.col(ts) >= F.lit(low))
        part = part if high is None else part.filter(F.col(ts) < F.lit(high))
        part.coalesce(1).write.mode("append").parquet(path)
    at = F.lit(last).cast("timestamp") + F.expr(f"interval {later}")
    row = [at.alias(ts) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    df.sparkSession.range(1).select(*row).coalesce(1).write.mode("append").parquet(path)


def psi_batches(preds: DataFrame, edges: list[float], path: str, checkpoint: str, ts: str = "ts") -> DataFrame:
    """Counts of scores per (day, bin), kept by a ``foreachBatch`` sink: (day, bin, n) of all batches so far.

    A batch is counted once and written to the folder of its id, which a batch delivered again after a restart
    overwrites; counts of batches are added when they are read. So nothing is counted twice, late rows
    count whenever they come, and no state is held in the stream."""
    spark = preds.sparkSession
    x = F.col("p_default").cast("double")
    b = F.lit(0)
    for e in edges:
        b = b + F.when(x >= F.lit(float(e)), 1).otherwise(0)

    def count(batch: DataFrame, batch_id: int) -> None:
        (batch.filter(x.isNotNull()).groupBy(F.date_trunc("day", ts).alias("day"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
         .write.mode("overwrite").parquet(f"{path}/batch={batch_id}"))

    q = preds.writeStream.foreachBatch(count).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return read_psi_batches(spark, path)


def read_psi_batches(spark: SparkSession, path: str) -> DataFrame:
    counts = spark.read.schema("day timestamp, bin int, n long, batch long").parquet(path)
    return counts.groupBy("day", "bin").agg(F.sum("n").alias("n"))


def rolling_counts(daily: DataFrame, days: int) -> DataFrame:
    """(window_start, bin, n) of the windows of ``days`` days that begin on each day: a day's counts go to the
    windows it lies in, ``days`` rows a count."""
    spread = (daily.withColumn("back", F.explode(F.sequence(F.lit(0), F.lit(days - 1))))
              .select((F.col("day") - F.make_dt_interval(F.col("back"))).alias("window_start"), "bin", "n"))
    return spread.groupBy("window_start", "bin").agg(F.sum("n").alias("n"))


def psi_bin_counts(preds: DataFrame, edges: list[float], ts: str = "ts", delay: str = "1 day",
                   window: str = "1 day") -> DataFrame:
    """Streaming counts per (window, bin) against static reference edges."""
    x = F.col("p_default").cast("double")
    b = F.lit(0)
    for e in edges:
        b = b + F.when(x >= F.lit(float(e)), 1).otherwise(0)
    # a NULL score moves the watermark; its bin is NULL and left out when the counts are read
    return (preds.withWatermark(ts, delay)
            .groupBy(F.window(F.col(ts), window).alias("w"), F.when(x.isNotNull(), b).alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), "bin", "n"))


def psi_by_window(counts: DataFrame, expected_shares: list[float], min_samples: int = PSI_MIN_SAMPLES) -> DataFrame:
    """PSI per window from (window_start, bin, n) and the reference bin shares;
    NULL when the window holds fewer than ``min_samples`` rows."""
    spark = counts.sparkSession
    counts = counts.filter(F.col("bin").isNotNull())
    ref = spark.createDataFrame([(i, float(s)) for i, s in enumerate(expected_shares)], "bin int, e_share double")
    per = counts.groupBy("window_start").agg(F.sum("n").alias("_t"))
    full = counts.join(per, "window_start").join(F.broadcast(ref), "bin", "inner")   # ref: n_bins rows
    # bins absent from a window have share 0 -> floored; add their terms separately
    nb = len(expected_shares)
    a = F.greatest(F.col("n") / F.col("_t"), F.lit(PSI_SHARE_FLOOR))
    e = F.greatest(F.col("e_share"), F.lit(PSI_SHARE_FLOOR))
    present = full.withColumn("term", (a - e) * F.log(a / e))
    missing_term = (F.lit(PSI_SHARE_FLOOR) - e) * F.log(F.lit(PSI_SHARE_FLOOR) / e)
    ref_total = ref.agg(F.sum(((F.lit(PSI_SHARE_FLOOR) - F.greatest(F.col("e_share"), F.lit(PSI_SHARE_FLOOR)))
                               * F.log(F.lit(PSI_SHARE_FLOOR) / F.greatest(F.col("e_share"), F.lit(PSI_SHARE_FLOOR)))))
                        .alias("_all_missing")).withColumn("_k", F.lit(0))
    agg = (present.groupBy("window_start")
           .agg(F.sum("term").alias("_present"), F.sum(missing_term).alias("_present_as_missing"),
                F.first("_t").alias("n"), F.count(F.lit(1)).alias("_bins")))
    out = (agg.withColumn("_k", F.lit(0)).join(F.broadcast(ref_total), "_k").drop("_k")
           .withColumn("psi", F.col("_present") + F.col("_all_missing") - F.col("_present_as_missing")))
    return out.select("window_start", "n", F.when(F.col("n") >= min_samples, F.col("psi")).alias("psi"),
                      F.lit(nb).alias("n_bins"))


def run_available(query_df: DataFrame, output_mode: str = "append", fmt: str = "parquet",
                  name: str = "stream") -> DataFrame:
    """Process everything available now (``trigger(availableNow=True)``) into a
    sink under the checkpoint folder and return the sink as a batch DataFrame.
    The stream's own checkpoint makes a restarted run resume exactly once."""
    spark = query_df.sparkSession
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if output_mode == "complete":
        sink_name = f"{name}_{uuid.uuid4().hex[:8]}"
        q = (query_df.writeStream.outputMode("complete").format("memory").queryName(sink_name)
             .option("checkpointLocation", f"{base}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        return spark.table(sink_name)
    q = (query_df.writeStream.outputMode(output_mode).format(fmt)
         .option("path", f"{base}/data").option("checkpointLocation", f"{base}/_checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(query_df.schema).format(fmt).load(f"{base}/data")

