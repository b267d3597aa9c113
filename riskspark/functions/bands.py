"""Banding and decision expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.schema import (
    DECISION_THRESHOLD, PSI_MODERATE, PSI_SIGNIFICANT, RISK_BAND_TOP, RISK_BANDS,
)


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def risk_band(p: Column | str = "p_default") -> Column:
    p = _c(p)
    expr = None
    for upper, name in RISK_BANDS:
        expr = F.when(p < upper, name) if expr is None else expr.when(p < upper, name)
    return F.when(p.isNull(), F.lit(None).cast("string")).otherwise(expr.otherwise(RISK_BAND_TOP))


def psi_band(v: Column | str = "psi") -> Column:
    v = _c(v)
    return (F.when(v.isNull(), "INSUFFICIENT_DATA")
             .when(v >= PSI_SIGNIFICANT, "SIGNIFICANT")
             .when(v >= PSI_MODERATE, "MODERATE")
             .otherwise("STABLE"))


def decision(p: Column | str = "p_default", threshold: float = DECISION_THRESHOLD) -> Column:
    """'reject' when p >= threshold, else 'approve'.

    A NULL or NaN probability is never ">= t" in the matched behaviour (NaN
    compares false), so it approves; Spark orders NaN above every number, so
    NaN is tested explicitly.
    """
    p = _c(p)
    return F.when(p.isNotNull() & ~F.isnan(p) & (p >= F.lit(float(threshold))), "reject").otherwise("approve")
