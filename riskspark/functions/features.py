"""Interaction features (computed in double, cast once to FLOAT)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_div(num: Column, den: Column) -> Column:
    """num / den where den > 0, else NULL (also NULL when either side is NULL)."""
    return F.when(den > 0, num / den).cast("float")


def interaction_columns() -> dict[str, Column]:
    """The seven interactions over a cleaned frame, NULL in -> NULL out."""
    c = F.col
    # History clipped at one year; a NULL history stays NULL (greatest() would
    # otherwise turn NULL into 1).
    hist = c("credit_history_years").cast("float")
    hist_clip = F.when(hist.isNotNull(), F.greatest(hist, F.lit(1.0).cast("float")))
    # log1p is NULL below -1 in Spark (NaN/-inf elsewhere); balances are >= 0.
    return {
        "loan_to_income": safe_div(c("loan_amnt"), c("annual_inc")),
        "installment_to_income": safe_div(c("installment") * 12, c("annual_inc")),
        "int_rate_x_term": (c("int_rate") * c("term")).cast("float"),
        # 850 - fico_mean stays in FLOAT like its input, the product in double.
        "fico_dti_risk": ((F.lit(850).cast("float") - c("fico_mean")).cast("double")
                          * (c("dti") / 100)).cast("float"),
        "revol_util_x_logbal": ((c("revol_util") / 100) * F.log1p(c("revol_bal"))).cast("float"),
        "accounts_per_year": (c("total_acc") / hist_clip).cast("float"),
        "delinq_per_year": (c("delinq_2yrs") / hist_clip).cast("float"),
    }
