"""Shared table builders for the registered queries (Spark side).

Years of the driver tables run 1995-2001, so the time cut-offs are
parameters: train <= 1999, test >= 2000, base <= 1998, calibration = 1999.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.ordered import materialize
from riskspark.operators.prepare import add_interactions, clean, curate
from riskspark.operators.scoring import FROZEN_SCORECARD, with_fico_mean
from riskspark.functions.bands import decision
from riskspark.sources.loanview import loans, table

TRAIN_MAX = 1999
TEST_MIN = 2000
BASE_MAX = 1998
CALIB = 1999
PROD_START = "2000-01-01"


def raw(spark: SparkSession, d: str) -> DataFrame:
    return loans(spark, d)


def curated(spark: SparkSession, d: str) -> DataFrame:
    return curate(raw(spark, d))


def cleaned(spark: SparkSession, d: str, validate: bool = False) -> DataFrame:
    return clean(curated(spark, d), validate=validate)


def cleaned2(spark: SparkSession, d: str) -> DataFrame:
    return add_interactions(cleaned(spark, d))


def scored(spark: SparkSession, d: str) -> DataFrame:
    """Cleaned v2 loans with the frozen scorecard probability and numeric id."""
    return (FROZEN_SCORECARD.score(cleaned2(spark, d))
            .withColumn("loan_id", F.col("application_id").cast("bigint")))


def scored_table(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """The scored loans (only ``cols``, if given) written once to the checkpoint
    folder: multi-pass queries (rank metrics, quantiles, tables) read this
    instead of re-running the join and scoring plan for every pass."""
    s = scored(spark, d)
    return materialize(s.select(*cols) if cols else s)


def test_table(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """``cols`` of the scored test years, written once for several passes."""
    return materialize(test_scored(spark, d).select(*cols))


def train_table(spark: SparkSession, d: str, *cols: str) -> DataFrame:
    """``cols`` of the scored training years, written once for several passes."""
    return materialize(train_scored(spark, d).select(*cols))


def test_scored(spark, d, base: DataFrame | None = None):
    return (base if base is not None else scored(spark, d)).filter(F.col("issue_year") >= TEST_MIN)


def train_scored(spark, d, base: DataFrame | None = None):
    return (base if base is not None else scored(spark, d)).filter(F.col("issue_year") <= TRAIN_MAX)


def prediction_log(spark: SparkSession, d: str) -> DataFrame:
    """Every application scored at its order date: ts, id, p, decision, threshold, model."""
    s = FROZEN_SCORECARD.score(with_fico_mean(loans(spark, d, dated=True)))
    return s.select(F.col("applied_on").cast("timestamp").alias("ts"), "application_id", "p_default",
                    decision("p_default", 0.13).alias("decision"),
                    F.lit(0.13).alias("threshold"), F.lit(FROZEN_SCORECARD.name).alias("model"))


def outcomes(spark: SparkSession, d: str) -> DataFrame:
    """Realized outcomes: labelled loans as (application_id, actual)."""
    return curated(spark, d).select("application_id", F.col("default").cast("int").alias("actual"))


def event_predictions(spark: SparkSession, d: str) -> DataFrame:
    """Events as a prediction feed: p = min(value / 500, 1)."""
    e = table(spark, d, "events")
    p = F.least(F.col("value") / 500.0, F.lit(1.0))
    return e.select(F.col("ts").cast("timestamp").alias("ts"),
                    F.col("event_id").cast("string").alias("application_id"),
                    p.alias("p_default"), decision(p, 0.13).alias("decision"))
