"""Parsing expressions for raw loan columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskspark.schema import DEFAULT_STATUSES, EMP_LENGTH_YEARS, REPAY_STATUSES


def default_flag(status: Column | str = "loan_status") -> Column:
    """1 for a default status, 0 for a repaid one, NULL otherwise (censored/unknown)."""
    s = F.col(status) if isinstance(status, str) else status
    return (F.when(s.isin(*DEFAULT_STATUSES), F.lit(1))
             .when(s.isin(*REPAY_STATUSES), F.lit(0))
             .cast("int"))


def month_year(c: Column | str) -> Column:
    """Year of a 'Mon-YYYY' string; unparseable or NULL -> NULL (never raises)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.year(F.try_to_timestamp(c, F.lit("MMM-yyyy")))


def term_months(c: Column | str = "term") -> Column:
    """' 36 months' -> 36 as TINYINT. A term without digits raises (as the cast
    of an empty string does under ANSI); NULL stays NULL."""
    c = F.col(c) if isinstance(c, str) else c
    return F.regexp_extract(F.trim(c), r"(\d+)", 1).cast("tinyint")


def emp_length_years(c: Column | str = "emp_length") -> Column:
    """Employment-length text -> years as FLOAT; unknown text and NULL -> NULL."""
    c = F.col(c) if isinstance(c, str) else c
    expr = None
    for text, years in EMP_LENGTH_YEARS.items():
        expr = (F.when(c == text, F.lit(years)) if expr is None
                else expr.when(c == text, F.lit(years)))
    return expr.cast("float")
