"""Profiling tables (one aggregate per table; wide profiles are unpivoted)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.metrics import with_equal_width_bin
from riskspark.operators.ordered import exact_quantiles, materialize
from riskspark.schema import FICO_EDGES, TARGET


def _stack(cols: list[str], name: str = "column_name", value: str = "value") -> str:
    body = ", ".join(f"'{c}', `{c}`" for c in cols)
    return f"stack({len(cols)}, {body}) as ({name}, {value})"


def long_values(df: DataFrame, cols: list[str], keep: list[str] = ()) -> DataFrame:
    """(keep..., column_name, value DOUBLE) rows for the given numeric columns."""
    casted = df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.selectExpr(*[f"`{k}`" for k in keep], _stack(cols))


def status_frequency(raw: DataFrame, col: str = "loan_status") -> DataFrame:
    """Value counts including NULL."""
    return raw.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def missing_share(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Percentage of NULL (or NaN) per column, only columns above zero."""
    cols = cols or df.columns
    types = dict(df.dtypes)

    def miss(c):
        m = F.col(c).isNull()
        if types[c] in ("double", "float"):
            m = m | F.isnan(c)
        return F.avg(m.cast("double")) * 100

    wide = df.agg(*[miss(c).alias(c) for c in cols])
    return wide.selectExpr(_stack(cols, value="missing_pct")).filter(F.col("missing_pct") > 0)


def class_balance(df: DataFrame, y: str = TARGET) -> DataFrame:
    """n, defaults, repaid, default rate and imbalance ratio (repaid / defaults)."""
    yy = F.col(y)
    return (df.filter(yy.isNotNull())
            .agg(F.count(F.lit(1)).alias("n"), F.count_if(yy == 1).alias("n_default"),
                 F.count_if(yy == 0).alias("n_repaid"))
            .withColumn("default_rate", F.col("n_default") / F.col("n"))
            .withColumn("imbalance_ratio", F.when(F.col("n_default") > 0, F.col("n_repaid") / F.col("n_default"))))


def rate_by(df: DataFrame, key: str | list[str], y: str = TARGET) -> DataFrame:
    """Default rate and count per key value."""
    keys = [key] if isinstance(key, str) else key
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("default_rate"))


def fico_bucket(c: str = "fico_range_low", edges: list[int] = FICO_EDGES):
    """Right-closed interval label '(a, b]'; values outside (first, last] -> NULL."""
    x = F.col(c)
    expr = None
    for a, b in zip(edges[:-1], edges[1:]):
        cond = (x > a) & (x <= b)
        lab = f"({a}, {b}]"
        expr = F.when(cond, lab) if expr is None else expr.when(cond, lab)
    return expr


def fico_bucket_rate(df: DataFrame, y: str = TARGET) -> DataFrame:
    return (df.withColumn("fico_bucket", fico_bucket()).filter(F.col("fico_bucket").isNotNull())
            .groupBy("fico_bucket").agg(F.count(F.lit(1)).alias("n"),
                                        F.avg(F.col(y).cast("double")).alias("default_rate")))


DESCRIBE_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def describe(df: DataFrame, cols: list[str], probs: list[float] = DESCRIBE_PROBS,
             checkpoint: bool = True) -> DataFrame:
    """count, mean, sample std, min, exact percentiles, max per column (long)."""
    df = materialize(df.select(*cols)) if checkpoint else df
    lv = long_values(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    basic = lv.groupBy("column_name").agg(F.count(F.lit(1)).alias("count"), F.avg("value").alias("mean"),
                                          F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                          F.max("value").alias("max"))
    q = exact_quantiles(lv, "value", probs, by=["column_name"], checkpoint=False)
    names = {i: f"p{int(round(p * 100)):02d}" for i, p in enumerate(probs)}
    wide = q.groupBy("column_name").pivot("qi", list(names)).agg(F.first("quantile"))
    wide = wide.select("column_name", *[F.col(str(i)).alias(n) for i, n in names.items()])
    return basic.join(wide, on="column_name", how="left")


def clipped_histogram(df: DataFrame, cols: list[str], n_bins: int = 50, lo_q: float = 0.01,
                      hi_q: float = 0.99, checkpoint: bool = True) -> DataFrame:
    """Per column: values clipped to their [1 %, 99 %] quantiles, then
    ``n_bins`` equal-width bins over [lo, hi]: column_name, bin, n."""
    df = materialize(df.select(*cols)) if checkpoint else df
    lv = long_values(df, cols).filter(F.col("value").isNotNull() & ~F.isnan("value"))
    q = exact_quantiles(lv, "value", [lo_q, hi_q], by=["column_name"], checkpoint=False)
    bounds = q.groupBy("column_name").agg(F.min("quantile").alias("_lo"), F.max("quantile").alias("_hi"))
    # a degenerate range [v, v] is widened by 0.5 on both sides
    bounds = bounds.select("column_name",
                           F.when(F.col("_lo") == F.col("_hi"), F.col("_lo") - 0.5).otherwise(F.col("_lo")).alias("_lo"),
                           F.when(F.col("_lo") == F.col("_hi"), F.col("_hi") + 0.5).otherwise(F.col("_hi")).alias("_hi"),
                           F.col("_lo").alias("_clo"), F.col("_hi").alias("_chi"))
    j = lv.join(F.broadcast(bounds), on="column_name")   # one row per column
    x = F.least(F.greatest(F.col("value"), F.col("_clo")), F.col("_chi"))
    return (with_equal_width_bin(j, x, "_lo", "_hi", n_bins).groupBy("column_name", "bin")
            .agg(F.count(F.lit(1)).alias("n")))


def interaction_stats(df: DataFrame, cols: list[str], y: str = TARGET) -> DataFrame:
    """mean, sample std, NULL percentage and Pearson r with the label per column."""
    lv = long_values(df, cols, keep=[y])
    v = F.col("value")
    return (lv.groupBy("column_name")
            .agg(F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                 (F.avg(v.isNull().cast("double")) * 100).alias("null_pct"),
                 F.corr(v, F.col(y).cast("double")).alias("corr_default")))


def year_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy("issue_year").agg(F.count(F.lit(1)).alias("n"))


def distinct_levels(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_name, level) for every distinct level of the given columns."""
    return df.selectExpr(_stack(cols, value="level")).distinct()


def new_levels(train: DataFrame, test: DataFrame, cols: list[str]) -> DataFrame:
    """Levels present in ``test`` but never in ``train`` (anti join per column)."""
    return distinct_levels(test, cols).join(distinct_levels(train, cols), ["column_name", "level"], "left_anti")


def dtype_census(df: DataFrame) -> DataFrame:
    spark = df.sparkSession
    counts: dict[str, int] = {}
    for _, t in df.dtypes:
        counts[t] = counts.get(t, 0) + 1
    return spark.createDataFrame(sorted(counts.items()), "dtype string, n_columns int")


def numpy_probs(n_bins: int) -> list[float]:
    return [float(q) for q in np.linspace(0, 1, n_bins + 1)]
