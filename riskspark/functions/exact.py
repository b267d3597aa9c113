"""Order-independent aggregates for values on a known decimal grid.

Scores rounded to d decimals are integers times 10^-d. Summing the integers
(BIGINT) is exact in any order, so the mean is the same double on every
engine and every partitioning; floating sums are not (their last bits depend
on the order partitions are combined).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x):
    return F.col(x) if isinstance(x, str) else x


def grid_mean(x: Column | str, decimals: int | None) -> Column:
    """Mean of ``x``; exact when ``decimals`` gives the grid of ``x``."""
    x = _c(x)
    if decimals is None:
        return F.avg(x)
    scale = float(10 ** decimals)
    return F.sum(F.round(x * scale).cast("bigint")).cast("double") / (F.count(x) * scale)


def grid_sq_error_mean(p: Column | str, y: Column | str, decimals: int | None) -> Column:
    """Mean of (p - y)^2 for 0/1 labels; exact when p lies on the grid."""
    p, y = _c(p).cast("double"), _c(y).cast("double")
    if decimals is None:
        return F.avg((p - y) * (p - y))
    scale = float(10 ** decimals)
    d = F.round(p * scale).cast("bigint") - (y * scale).cast("bigint")
    ok = p.isNotNull() & y.isNotNull()
    return F.sum(F.when(ok, d * d)).cast("double") / (F.count(F.when(ok, 1)) * (scale * scale))
