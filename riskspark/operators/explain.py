"""Per-row contributions, reason codes and the grade-gap comparison.

For a linear model the contribution of feature j to the log-odds is
``coef_j * (x_j - mean_j)`` with the training mean, and
``bias = intercept + sum coef_j * (mean_j - center_j)``, so contributions plus
bias equal the margin exactly. Reason codes are an ``ARRAY<STRUCT>`` built,
filtered, sorted and sliced inside one projection (no shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators.scoring import Scorecard
from riskspark.schema import FEATURE_LABELS, GRADE_AGREE_PP

REASON_TYPE = "array<struct<feature:string,label:string,value:string,contribution:double>>"


def feature_label(name: str) -> str:
    return FEATURE_LABELS.get(name, name)


def json_safe(df: DataFrame, name: str) -> Column:
    """The column as the string a JSON value is made of: numbers as doubles, NaN
    and infinities as NULL (JSON has neither), text, booleans and dates as they read."""
    kind, x = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.NumericType):
        x = x.cast("double")
        return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x.cast("string"))
    return x.cast("string")


def scorecard_contributions(card: Scorecard, df: DataFrame, train: DataFrame) -> DataFrame:
    """Append ``contributions`` (array of (pos, feature, label, value, contribution))
    and ``bias``; training means come from one aggregate over ``train``."""
    means = train.agg(*[F.avg(card.value(t)).alias(t.feature) for t in card.terms]).first()
    bias = card.intercept + sum(t.coef * ((means[t.feature] or 0.0) - t.center) for t in card.terms)
    items = []
    for pos, t in enumerate(card.terms):
        contrib = F.lit(float(t.coef)) * (card.value(t) - F.lit(float(means[t.feature] or 0.0)))
        items.append(F.struct(F.lit(pos).alias("pos"), F.lit(t.feature).alias("feature"),
                              F.lit(feature_label(t.feature)).alias("label"),
                              json_safe(df, t.feature).alias("value"),
                              contrib.alias("contribution")))
    return df.withColumn("contributions", F.array(*items)).withColumn("bias", F.lit(float(bias)))


def linear_reason_codes(df: DataFrame, top_n: int = 5, positive_only: bool = True,
                        col: str = "contributions") -> DataFrame:
    """Append ``reasons``: contributions sorted descending (ties by feature
    position), optionally positive only, at most ``top_n``."""
    arr = F.col(col)
    if positive_only:
        arr = F.filter(arr, lambda c: c["contribution"] > 0)
    keyed = F.transform(arr, lambda c: F.struct((-c["contribution"]).alias("k"), c["pos"].alias("p"), c.alias("c")))
    ordered = F.transform(F.array_sort(keyed), lambda s: s["c"])
    top = F.slice(ordered, 1, top_n)
    return df.withColumn("reasons", F.transform(top, lambda c: F.struct(
        c["feature"].alias("feature"), c["label"].alias("label"), c["value"].alias("value"),
        c["contribution"].alias("contribution"))))


def grade_gap(scored: DataFrame, reference: DataFrame, grade: str = "grade", y: str = "default",
              agree: float = GRADE_AGREE_PP) -> DataFrame:
    """Model probability vs the observed default rate of the applicant's grade
    (and of the whole reference population): deltas and a verdict.

    The per-grade table has one row per grade level and is joined normally
    (Catalyst/AQE broadcast it by its measured size).
    """
    rates = reference.groupBy(grade).agg(F.avg(F.col(y).cast("double")).alias("_gr"))
    pop = reference.agg(F.avg(F.col(y).cast("double")).alias("_pop")).withColumn("_k", F.lit(0))
    j = (scored.join(rates, grade, "left").withColumn("_k", F.lit(0))
         .join(F.broadcast(pop), "_k").drop("_k"))
    gr = F.coalesce(F.col("_gr"), F.col("_pop"))
    dg = F.col("p_default") - gr
    return j.select("application_id", grade, "p_default", gr.alias("grade_rate"), dg.alias("delta_vs_grade"),
                    (F.col("p_default") - F.col("_pop")).alias("delta_vs_population"),
                    F.when(F.abs(dg) < agree, "agree").when(dg > 0, "pessimistic").otherwise("optimistic").alias("verdict"))
