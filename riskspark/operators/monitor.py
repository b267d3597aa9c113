"""Monitoring: prediction log, outcome join, daily and monthly tables, headline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.functions.bands import psi_band
from riskspark.functions.exact import grid_mean, grid_sq_error_mean
from riskspark.operators.metrics import prob_metrics, psi, rank_metrics
from riskspark.schema import PSI_MIN_SAMPLES


def join_outcomes(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """Inner join of logged predictions and realized outcomes on application_id.

    NULL ids are dropped, ids compared as strings; duplicate outcome ids fan
    out (check :func:`duplicate_outcome_ids` first). Without an id column the
    result is empty with an ``actual`` column.
    """
    if "application_id" not in predictions.columns:
        return predictions.limit(0).withColumn("actual", F.lit(None).cast("int"))
    preds = (predictions.filter(F.col("application_id").isNotNull())
             .withColumn("application_id", F.col("application_id").cast("string")))
    return preds.join(truth, on="application_id", how="inner")


def duplicate_outcome_ids(truth: DataFrame) -> DataFrame:
    """Outcome ids present more than once (these would fan the join out)."""
    return truth.groupBy("application_id").count().filter(F.col("count") > 1)


def unlabeled_counts(predictions: DataFrame, truth: DataFrame) -> DataFrame:
    """n_predictions, n_labelled (matched), n_unlabeled (no outcome yet; a NULL id
    has none), from one join against the distinct outcome ids."""
    ids = truth.select("application_id").distinct().withColumn("_hit", F.lit(1))
    matched = predictions.select("application_id").join(ids, "application_id", "left")
    return matched.agg(F.count(F.lit(1)).alias("n_predictions"), F.count("_hit").alias("n_labelled"),
                       F.count_if(F.col("_hit").isNull()).alias("n_unlabeled"))


def daily_table(predictions: DataFrame, ts: str = "ts", p_decimals: int | None = None) -> DataFrame:
    """Per UTC date: n, mean p_default, reject rate."""
    return (predictions.groupBy(F.to_date(F.col(ts)).alias("date"))
            .agg(F.count(F.lit(1)).alias("n"),
                 grid_mean("p_default", p_decimals).alias("mean_p_default"),
                 F.avg((F.col("decision") == "reject").cast("double")).alias("reject_rate")))


def realized_metrics(joined: DataFrame, by: list[str] | tuple[str, ...] = (),
                     y: str = "actual", p: str = "p_default", p_decimals: int | None = None,
                     checkpoint: bool = True) -> DataFrame:
    """n, actual_default_rate, mean_p_default, brier, roc_auc, ks, log_loss per
    group; the rank metrics and log-loss are NULL when a class is absent."""
    by = list(by)
    pm = prob_metrics(joined, y, p, by, p_decimals=p_decimals)
    rm = rank_metrics(joined, y, p, by, checkpoint=checkpoint)
    if by:
        j = pm.join(rm, on=by, how="left")
    else:
        j = pm.withColumn("_k", F.lit(0)).join(rm.withColumn("_k", F.lit(0)), "_k", "left").drop("_k")
    both = F.col("roc_auc").isNotNull()
    return j.select(*by, "n",
                    F.col("actual_rate").alias("actual_default_rate"),
                    F.col("mean_p").alias("mean_p_default"),
                    "brier", "roc_auc", "ks",
                    F.when(both, F.col("log_loss")).alias("log_loss"))


def realized_monthly(joined: DataFrame, ts: str = "ts", p_decimals: int | None = None,
                     checkpoint: bool = True) -> DataFrame:
    """Realized metrics per calendar month ('yyyy-MM' of the UTC timestamp)."""
    return realized_metrics(joined.withColumn("month", F.date_format(F.col(ts), "yyyy-MM")), by=["month"],
                            p_decimals=p_decimals, checkpoint=checkpoint)


def headline(predictions: DataFrame, reference: DataFrame, ref_col: str = "p_default",
             min_samples: int = PSI_MIN_SAMPLES, ts: str = "ts", p_decimals: int | None = None,
             checkpoint: bool = True) -> DataFrame:
    """One row: n_predictions, window, PSI vs the reference scores (NULL under
    ``min_samples`` rows), its band, mean p (production, reference), reject rate."""
    stats = predictions.agg(
        F.count(F.lit(1)).alias("n_predictions"),
        F.min(ts).alias("window_start"), F.max(ts).alias("window_end"),
        grid_mean("p_default", p_decimals).alias("mean_p_default_prod"),
        F.avg((F.col("decision") == "reject").cast("double")).alias("reject_rate"))
    ref = reference.agg(grid_mean(ref_col, p_decimals).alias("mean_p_default_train_ref"))
    n = stats.first()["n_predictions"]
    if n >= min_samples:
        pv = psi(reference, ref_col, predictions, "p_default", checkpoint=checkpoint)
    else:
        pv = predictions.sparkSession.createDataFrame([(None,)], "psi double")
    k = F.lit(0)
    out = (stats.withColumn("_k", k).join(ref.withColumn("_k", k), "_k")
           .join(pv.withColumn("_k", k), "_k").drop("_k"))
    return out.select("n_predictions", "window_start", "window_end", "psi",
                      psi_band("psi").alias("psi_band"), "mean_p_default_prod",
                      "mean_p_default_train_ref", "reject_rate")


def calibration_summary(df: DataFrame, y: str = "default", p: str = "p_default",
                        p_decimals: int | None = None) -> DataFrame:
    """n, mean_pred, observed, gap (difference of the unrounded means), brier."""
    yy, pp = F.col(y).cast("double"), F.col(p).cast("double")
    return (df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), grid_mean(pp, p_decimals).alias("mean_pred"),
                 F.avg(yy).alias("observed"), grid_sq_error_mean(pp, yy, p_decimals).alias("brier"))
            .withColumn("gap", F.col("mean_pred") - F.col("observed"))
            .select("n", "mean_pred", "observed", "gap", "brier"))


def batch_summary(scored: DataFrame) -> DataFrame:
    """rows, rejects, reject percentage of a scored batch."""
    return scored.agg(F.count(F.lit(1)).alias("n_rows"),
                      F.count_if(F.col("decision") == "reject").alias("n_reject"),
                      (100.0 * F.avg((F.col("decision") == "reject").cast("double"))).alias("reject_pct"))
