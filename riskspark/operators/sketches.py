"""Quantiles of stated accuracy from KLL sketches that merge.

A sketch of a value column is a few kilobytes whatever it has read, sketches of
parts merge into the sketch of the whole, and any quantile or rank is then read
without the rows. So a growing table keeps one sketch a part (day, year,
partition) and a profile or a set of bin edges costs a merge. The exact
operators in ``ordered`` and ``profile`` stay the default; this is for where a
known error in rank is good enough.

Accuracy: a quantile's rank is off by at most ``rank_error(k)`` of the rows with
a confidence of 99 % each. ``n``, lowest and highest value are exact.

NULL and NaN are left out. A group without any value has no row. Ties and
repeated rows count as often as they stand there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Items a sketch keeps a level; its error falls about as 1 / k.
DEFAULT_K = 1600


def rank_error(k: int = DEFAULT_K) -> float:
    """The published bound of a KLL sketch's rank error, a share of the rows."""
    return 2.296 / k ** 0.9021


def sketch(df: DataFrame, value: str, by: list[str] | tuple[str, ...] = (), k: int = DEFAULT_K) -> DataFrame:
    """One row a group: n, lowest, highest, sketch (binary). Partial sketches
    are merged before and after the shuffle, so a hot group sends one sketch a task."""
    x = F.col(value).cast("double")
    return (df.select(*by, F.when(~F.isnan(x), x).alias("_x")).filter(F.col("_x").isNotNull()).groupBy(*by)
            .agg(F.count("_x").alias("n"), F.min("_x").alias("lowest"), F.max("_x").alias("highest"),
                 F.kll_sketch_agg_double("_x", F.lit(k)).alias("sketch"))
            .filter(F.col("n") > 0))


def merge(sketches: DataFrame, by: list[str] | tuple[str, ...] = (), k: int = DEFAULT_K) -> DataFrame:
    """The sketch of the union of the parts that ``by`` brings together."""
    return (sketches.groupBy(*by)
            .agg(F.sum("n").alias("n"), F.min("lowest").alias("lowest"), F.max("highest").alias("highest"),
                 F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
            .filter(F.col("n") > 0))


def quantiles(sketches: DataFrame, probs: list[float], by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """(by, qi, q, quantile) read from the sketches; 0 and 1 give the exact ends."""
    # a sketch is asked for literal ranks only
    asked = [F.struct(F.lit(float(q)).alias("q"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias("v")) for q in probs]
    found = sketches.select(*by, "lowest", "highest", F.posexplode(F.array(*asked)).alias("qi", "_f"))
    q = F.col("_f.q")
    return found.select(*by, "qi", q.alias("q"), F.when(q <= 0, F.col("lowest")).when(q >= 1, F.col("highest"))
                        .otherwise(F.col("_f.v")).alias("quantile"))


def rank_misses(df: DataFrame, value: str, estimates: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """How far each estimated quantile's rank lies from the asked one, as a share
    of the rows (0 if a tied value covers it): (by, qi, q, quantile, miss).

    One pass over the rows against each group's estimates, an array of one entry a probability."""
    keys = list(by) or ["_g"]
    if not by:
        df, estimates = df.withColumn("_g", F.lit(0)), estimates.withColumn("_g", F.lit(0))
    packed = estimates.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("qi", "q", "quantile"))).alias("_e"))
    x = F.col(value).cast("double")
    rows = df.filter(x.isNotNull() & ~F.isnan(x)).groupBy(*keys, x.alias("_x")).agg(F.count(F.lit(1)).alias("_c"))
    each = rows.join(packed, keys).select(*keys, "_x", "_c", F.explode("_e").alias("_e"))
    counted = each.groupBy(*keys, "_e").agg(F.sum("_c").alias("_n"), F.sum(F.when(F.col("_x") < F.col("_e.quantile"), F.col("_c")).otherwise(0)).alias("_lt"),
                                            F.sum(F.when(F.col("_x") <= F.col("_e.quantile"), F.col("_c")).otherwise(0)).alias("_le"))
    q = F.col("_e.q")
    miss = F.greatest(F.col("_lt") / F.col("_n") - q, q - F.col("_le") / F.col("_n"), F.lit(0.0))
    return counted.select(*by, "_e.qi", "_e.q", "_e.quantile", miss.alias("miss"))
