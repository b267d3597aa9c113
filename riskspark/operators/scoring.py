"""Batch scoring: input checks, interactions, alignment, score, decision.

A model is anything with ``score(df) -> df`` adding ``p_default``: a frozen
linear scorecard (pure column expressions, so SQL can reproduce it), a fitted
Spark ML pipeline (``riskspark.operators.models``) or a calibrated pair. Every
step is a narrow projection: scoring never shuffles.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.functions.bands import decision
from riskspark.operators.prepare import ensure_interactions
from riskspark.schema import (
    CATEGORICAL_COLS, CLEAN_FEATURES_V2, DECISION_THRESHOLD, INTERACTION_COLS,
)


@dataclass(frozen=True)
class Term:
    feature: str
    coef: float
    center: float = 0.0
    fill: float | None = None


@dataclass(frozen=True)
class Scorecard:
    """Logistic scorecard: p = 1 / (1 + exp(-(intercept + sum coef * (x - center))))."""
    intercept: float
    terms: tuple[Term, ...]
    round_digits: int | None = 4
    name: str = "scorecard"
    labels: dict = field(default_factory=dict)

    def value(self, t: Term) -> Column:
        x = F.col(t.feature).cast("double")
        return F.coalesce(x, F.lit(float(t.fill))) if t.fill is not None else x

    def term(self, t: Term) -> Column:
        x = self.value(t)
        return F.lit(float(t.coef)) * (x - F.lit(float(t.center)) if t.center else x)

    def margin(self) -> Column:
        m = F.lit(float(self.intercept))
        for t in self.terms:
            m = m + self.term(t)
        return m

    def probability(self) -> Column:
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-self.margin()))
        return F.round(p, self.round_digits) if self.round_digits is not None else p

    def score(self, df: DataFrame, out: str = "p_default") -> DataFrame:
        return df.withColumn(out, self.probability())

    @property
    def features(self) -> list[str]:
        return [t.feature for t in self.terms]


# Frozen scorecard used by the oracle-checked queries (coefficients are ours).
FROZEN_SCORECARD = Scorecard(
    intercept=-3.2,
    terms=(Term("int_rate", 0.12), Term("fico_mean", -0.004, center=700.0), Term("dti", 0.01, fill=10.0)),
    round_digits=4,
    name="scorecard_v1",
)


def with_fico_mean(raw: DataFrame) -> DataFrame:
    """Raw rows carry the FICO range; the models use its midpoint."""
    if "fico_mean" in raw.columns:
        return raw
    return raw.withColumn("fico_mean", ((F.col("fico_range_low") + F.col("fico_range_high")) / 2).cast("float"))


def missing_required(columns: list[str], feature_order: list[str] = CLEAN_FEATURES_V2) -> list[str]:
    """Required inputs absent from ``columns``; the interactions are derived, so exempt."""
    have = set(columns)
    return [c for c in feature_order if c not in INTERACTION_COLS and c not in have]


def align_columns(df: DataFrame, feature_order: list[str], types: dict[str, str] | None = None,
                  keep: list[str] = ()) -> DataFrame:
    """Select exactly ``feature_order`` (absent columns as typed NULLs, extras
    dropped) plus the ``keep`` pass-through columns."""
    types = types or {}
    cols = [F.col(c) if c in df.columns else F.lit(None).cast(types.get(c, "double")).alias(c)
            for c in feature_order]
    return df.select(*[F.col(k) for k in keep if k in df.columns and k not in feature_order], *cols)


def pin_levels(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Unseen categorical levels become NULL (levels fixed at training time).

    ``levels`` is the fitted level list per column (bounded by the model, not
    by the data), so an ``isin`` literal is used instead of a join.
    """
    return df.withColumns({c: F.when(F.col(c).isin(*lv), F.col(c)) for c, lv in levels.items() if c in df.columns})


def score_batch(df: DataFrame, model, threshold: float = DECISION_THRESHOLD,
                feature_order: list[str] = CLEAN_FEATURES_V2,
                levels: dict[str, list[str]] | None = None) -> DataFrame:
    """Input + ``p_default`` + ``decision``.

    Checks required columns (raises listing all of them), computes the seven
    interactions when any is absent, pins categorical levels, scores and
    applies the threshold.
    """
    missing = missing_required(df.columns, feature_order)
    if missing:
        raise ValueError(f"input is missing {len(missing)} required column(s): {', '.join(missing)}")
    work = ensure_interactions(df)
    if levels:
        work = pin_levels(work, levels)
    scored = model.score(work)
    return scored.withColumn("decision", decision("p_default", threshold))


def categorical_levels(train: DataFrame, cols: list[str] = CATEGORICAL_COLS) -> dict[str, list[str]]:
    """Distinct training levels per categorical column (one aggregate; the
    result size is the number of levels, which the model must hold anyway)."""
    row = train.agg(*[F.array_sort(F.collect_set(c)).alias(c) for c in cols]).first()
    return {c: list(row[c]) for c in cols}
