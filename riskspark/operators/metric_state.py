"""Monitoring state that merges by addition.

One row a (day, score, decision) with three counts: ``n`` logged predictions,
``pos`` and ``neg`` outcomes that came in for them. Every monitoring table
(daily, monthly, overall; AUC, KS, Brier, log-loss, mean score, reject rate)
is a function of these counts, and counts of disjoint inputs add up, so a
growing log is read once: a day's predictions, and later each load of
outcomes, become one *delta* each.

The state is a folder of Parquet, ``month=.../delta=...`` (folders by day would
be thousands of tiny files). Adding a delta writes folders of its own, in the
months it has rows for, and reads and rewrites nothing else. The same delta
delivered again replaces its folders, so a retried load changes nothing.
Outcomes belong to the day of their *prediction*, however late they come.

The size follows the distinct scores a day, not the log: four-decimal scores
give at most 20,000 rows a day and delta.

Defined results: a NULL timestamp is day NULL; a NULL score or decision is a
key of its own (counted in ``n``, left out of the means, as in the tables over
the log itself); outcomes of unknown ids add nothing; repeated outcome ids
count each time, as :func:`riskspark.operators.monitor.join_outcomes` has it;
an empty delta leaves the state as it is; a state never written is empty.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.metrics import rank_from_counts
from riskspark.operators.monitor import join_outcomes
from riskspark.schema import LOGLOSS_EPS

KEYS = ["day", "score", "decision"]
COUNTS = ["n", "pos", "neg"]
STATE_SCHEMA = "day date, score double, decision string, n long, pos long, neg long, month string, delta string"


def _month(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def prediction_counts(predictions: DataFrame, ts: str = "ts", p: str = "p_default") -> DataFrame:
    """The delta of newly logged predictions."""
    none = F.lit(0).cast("bigint")
    return (predictions.groupBy(F.to_date(ts).alias("day"), F.col(p).cast("double").alias("score"), "decision")
            .agg(F.count(F.lit(1)).alias("n")).select(*KEYS, "n", none.alias("pos"), none.alias("neg")))


def outcome_counts(predictions: DataFrame, truth: DataFrame, ts: str = "ts", p: str = "p_default") -> DataFrame:
    """The delta of newly known outcomes: the only step that joins the log, and
    only with the outcomes that are new."""
    known = join_outcomes(predictions, truth).filter(F.col("actual").isNotNull())
    y = F.col("actual").cast("bigint")
    return (known.groupBy(F.to_date(ts).alias("day"), F.col(p).cast("double").alias("score"), "decision")
            .agg(F.sum(y).alias("pos"), F.sum(1 - y).alias("neg"))
            .select(*KEYS, F.lit(0).cast("bigint").alias("n"), "pos", "neg"))


def add_delta(counts: DataFrame, path: str, delta: str) -> None:
    """Store ``counts`` as the delta named ``delta``; a second delivery replaces the first."""
    if not delta or "/" in delta:
        raise ValueError("a delta needs a name without '/'")
    # one file a month and delta: a month has a bounded number of days and distinct scores
    (counts.select(*KEYS, *COUNTS, _month(F.col("day")).alias("month"), F.lit(delta).alias("delta"))
     .repartition("month")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("month", "delta").parquet(path))


def read_state(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
    """The merged counts, one row a (day, score, decision); months outside the
    given range of days are not read (partition pruning)."""
    try:
        stored = spark.read.schema(STATE_SCHEMA).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        stored = spark.createDataFrame([], STATE_SCHEMA)
    if first_day is not None:
        bound = F.lit(first_day).cast("date")
        stored = stored.filter((F.col("month") >= _month(bound)) & (F.col("day") >= bound))
    if last_day is not None:
        bound = F.lit(last_day).cast("date")
        stored = stored.filter((F.col("month") <= _month(bound)) & (F.col("day") <= bound))
    return merge(stored)


def merge(counts: DataFrame, by: list[str] | tuple[str, ...] = tuple(KEYS)) -> DataFrame:
    """Add counts of equal keys."""
    return counts.groupBy(*by).agg(*[F.sum(c).alias(c) for c in COUNTS])


def _weighted_mean(x: Column, weight: Column, decimals: int | None) -> Column:
    """Sum of weight times x over the sum of the weights of non-NULL x; from
    whole numbers if x lies on a decimal grid, and so exact in any order."""
    total = F.sum(F.when(x.isNotNull(), weight))
    if decimals is None:
        return F.when(total > 0, F.sum(x * weight) / total)
    scale = float(10 ** decimals)
    return F.when(total > 0, F.sum(F.round(x * scale).cast("bigint") * weight).cast("double") / (total * scale))


def daily_from_state(state: DataFrame, p_decimals: int | None = None) -> DataFrame:
    """Per day with predictions: n, mean p_default, reject rate."""
    decided = F.sum(F.when(F.col("decision").isNotNull(), F.col("n")))
    rejects = F.sum(F.when(F.col("decision") == "reject", F.col("n")).otherwise(0))
    return (state.filter(F.col("n") > 0).groupBy(F.col("day").alias("date"))
            .agg(F.sum("n").alias("n"), _weighted_mean(F.col("score"), F.col("n"), p_decimals).alias("mean_p_default"),
                 F.when(decided > 0, rejects / decided).alias("reject_rate")))


def realized_from_state(state: DataFrame, period: Column | None = None, name: str = "month",
                        p_decimals: int | None = None) -> DataFrame:
    """n, actual_default_rate, mean_p_default, brier, roc_auc, ks, log_loss of
    the predictions with an outcome, per ``period`` of the day (None: overall).
    The rank metrics and log-loss are NULL where a class is absent."""
    by = [] if period is None else [name]
    known = state.filter((F.col("pos") + F.col("neg") > 0) & F.col("score").isNotNull())
    if period is not None:
        known = known.withColumn(name, period)
    g = known.groupBy(*by, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    s, pos, neg = F.col("score"), F.col("pos"), F.col("neg")
    n = F.sum(pos + neg)
    if p_decimals is None:
        brier = F.sum(pos * (s - 1) * (s - 1) + neg * s * s) / n
    else:
        scale = float(10 ** p_decimals)
        k = F.round(s * scale).cast("bigint")
        one = F.lit(10 ** p_decimals).cast("bigint")
        brier = F.sum(pos * (k - one) * (k - one) + neg * k * k).cast("double") / (n * (scale * scale))
    clipped = F.least(F.greatest(s, F.lit(LOGLOSS_EPS)), F.lit(1.0 - LOGLOSS_EPS))
    loss = -F.sum(pos * F.log(clipped) + neg * F.log(1 - clipped)) / n
    prob = g.groupBy(*by).agg(n.alias("n"), (F.sum(pos) / n).alias("actual_default_rate"),
                              _weighted_mean(s, pos + neg, p_decimals).alias("mean_p_default"),
                              brier.alias("brier"), loss.alias("_loss"))
    ranked = rank_from_counts(g.filter(~F.isnan("score")).select(
        *by, s.alias("_s"), pos.cast("double").alias("_pos"), neg.cast("double").alias("_neg")), by)
    if by:
        joined = prob.join(ranked, by, "left")
    else:
        k0 = F.lit(0)
        joined = prob.withColumn("_k", k0).join(ranked.withColumn("_k", k0), "_k", "left").filter(F.col("n") > 0)
    return joined.select(*by, "n", "actual_default_rate", "mean_p_default", "brier", "roc_auc", "ks",
                         F.when(F.col("roc_auc").isNotNull(), F.col("_loss")).alias("log_loss"))


def monthly_from_state(state: DataFrame, p_decimals: int | None = None) -> DataFrame:
    return realized_from_state(state, _month(F.col("day")), "month", p_decimals)
