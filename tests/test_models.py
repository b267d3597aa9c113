import numpy as np
import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskspark.operators.calibration import CalibratedModel, fit_isotonic, recalibrate
from riskspark.operators.explain import linear_reason_codes, scorecard_contributions
from riskspark.operators.models import class_weight_table, exact_medians, fit_lr, most_frequent
from riskspark.operators.scoring import FROZEN_SCORECARD, Scorecard, Term
from riskspark.operators.tuning import sample_trials, time_series_folds


def test_isotonic_equals_minmax_formula(spark):
    rng = np.random.RandomState(1)
    x = np.round(rng.rand(300), 2)
    y = (rng.rand(300) < x).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(x, y)], "p_default double, default int")
    iso = fit_isotonic(df)
    pts = sorted(set(x))
    got = {r.p_default: r.p_calibrated for r in iso.transform(spark.createDataFrame([(float(p),) for p in pts], "p_default double")).collect()}
    sy = np.array([y[x == p].sum() for p in pts], float)
    w = np.array([(x == p).sum() for p in pts], float)
    for i, p in enumerate(pts):
        best = max(min(sy[j:k + 1].sum() / w[j:k + 1].sum() for k in range(i, len(pts))) for j in range(i + 1))
        assert got[p] == pytest.approx(best, abs=1e-12)


def test_exact_median_and_mode(spark):
    df = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (3.0, "b"), (4.0, "a"), (None, None)], "x double, c string")
    assert exact_medians(df, ["x"]) == {"x": 2.5}
    assert most_frequent(df, ["c"]) == {"c": "a"}


def test_medians_of_many_rows_count_only_values_near_them(spark, monkeypatch):
    """By a sampled range and two passes; a range that misses its median sends only its column to the full count."""
    import numpy as np
    from riskspark.operators import models
    rng = np.random.default_rng(4)
    cols = {"x": rng.normal(size=3001), "few": rng.integers(0, 3, 3001).astype(float), "one": np.full(3001, 7.0),
            "gaps": np.where(rng.random(3001) < 0.4, np.nan, rng.exponential(size=3001)), "even": np.r_[np.nan, rng.normal(size=3000)]}
    rows = [tuple(None if k % 2 and np.isnan(v) else float(v) for v in r) for k, r in enumerate(zip(*cols.values(), strict=True))]
    df = spark.createDataFrame([(*r, None) for r in rows], ", ".join(f"{c} double" for c in [*cols, "none"]))
    want = {c: float(np.nanmedian(v)) for c, v in cols.items()} | {"none": 0.0}
    monkeypatch.setattr(models, "FEW_ROWS", 100)
    full = []
    plain = models.exact_quantiles
    monkeypatch.setattr(models, "exact_quantiles", lambda values, *a, **k: full.append(
        {r[0] for r in values.select("column_name").distinct().collect()}) or plain(values, *a, **k))
    assert exact_medians(df, list(want)) == pytest.approx(want, abs=1e-15)
    assert full == [{"none"}]
    ranges = models._median_ranges
    monkeypatch.setattr(models, "_median_ranges", lambda *a: ranges(*a) | {"x": (2.0, 3.0), "gaps": (-1.0, 0.0)})
    assert exact_medians(df, list(want)) == pytest.approx(want, abs=1e-15)
    assert full[1:] == [{"x", "gaps", "none"}]


def test_fit_lr_keeps_no_copy_in_memory(spark):
    """What the iterations read has the memory for itself; all categoricals are indexed in one pass."""
    from pyspark.ml.feature import StringIndexerModel
    rows = [(float(i % 7), "AB"[i % 2], "XYZ"[i % 3], int(i % 5 == 0)) for i in range(200)]
    df = spark.createDataFrame(rows, "dti double, grade string, purpose string, default int")
    seen = []
    plain = DataFrame.persist
    with pytest.MonkeyPatch.context() as m:
        m.setattr(type(df), "persist", lambda self, *a: seen.append(self) or plain(self, *a))
        model = fit_lr(df, ["dti", "grade", "purpose"], max_iter=5)
    assert not seen
    assert [len(s.getInputCols()) for s in model.stages if isinstance(s, StringIndexerModel)] == [2]


def test_class_weights(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "default int")
    w = {r.label: r for r in class_weight_table(df).collect()}
    assert w[0].balanced_weight == pytest.approx(4 / 6) and w[1].balanced_weight == pytest.approx(2.0)
    assert w[1].scale_pos_weight == pytest.approx(3.0)


def _labelled(spark, n=400):
    rng = np.random.RandomState(0)
    x0, x1 = rng.randn(n), rng.randn(n)
    cats = rng.choice(["a", "b", "c"], n)
    rows = [(int(i), float(a), float(b), str(c), int(a > 0), 2014 + i % 4) for i, (a, b, c) in enumerate(zip(x0, x1, cats))]
    return spark.createDataFrame(rows, "loan_id bigint, x0 double, x1 double, grade string, default int, issue_year int")


def test_lr_and_recalibration(spark):
    df = _labelled(spark)
    m = fit_lr(df.filter("issue_year <= 2016"), ["x0", "x1", "grade"], max_iter=50)
    scored = CalibratedModel(m, None).score(df)
    assert scored.filter((F.col("p_default") < 0) | (F.col("p_default") > 1)).count() == 0
    new = recalibrate(CalibratedModel(m, None), df.filter("issue_year = 2017"))
    assert new.base is m                                    # base reused, only the isotonic layer is new
    r = new.score(df.filter("issue_year = 2017")).agg(F.avg("p_default"), F.avg("default")).first()
    assert r[0] == pytest.approx(r[1], abs=1e-9)            # isotonic: mean prediction = observed on its fit window


def test_contributions_sum_to_margin_and_top_n(spark):
    card = Scorecard(-1.0, (Term("a", 0.5), Term("b", -2.0, center=1.0), Term("c", 0.1, fill=3.0)), round_digits=None)
    df = spark.createDataFrame([(1.0, 2.0, None), (3.0, 0.0, 4.0), (0.0, 1.0, 1.0)], "a double, b double, c double")
    c = scorecard_contributions(card, df, df).withColumn("m", card.margin())
    for r in c.collect():
        assert sum(x.contribution for x in r.contributions) + r.bias == pytest.approx(r.m, abs=1e-12)
    rc = linear_reason_codes(c, top_n=1, positive_only=True).collect()
    for r in rc:
        assert len(r.reasons) <= 1 and all(x.contribution > 0 for x in r.reasons)
        pos = sorted([x.contribution for x in r.contributions if x.contribution > 0], reverse=True)
        assert [x.contribution for x in r.reasons] == pos[:1]


def test_time_series_folds_and_trials(spark):
    df = _labelled(spark, 30)
    f = time_series_folds(df, 2).orderBy("pos").collect()
    assert [r.pos for r in f] == list(range(30))
    assert [r.test_fold for r in f] == [None] * 10 + [0] * 10 + [1] * 10
    years = [r.issue_year for r in f]
    assert years == sorted(years)
    t = sample_trials(15)
    assert len(t) == 15 and t[0]["n_estimators"] == 400 and len({tuple(sorted(x.items())) for x in t[1:]}) == 14


def test_coefficients_by_size(spark):
    from riskspark.operators.models import coefficient_table
    from riskspark.schema import INTERACTION_COLS
    rows = [(float(i % 7), float(i % 5), "ab"[i % 2], int(i % 7 > 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "dti double, loan_to_income double, grade string, `default` int")
    table = coefficient_table(fit_lr(df, ["dti", "loan_to_income", "grade"]), top_n=2).collect()
    assert table[0].feature == "dti" and table[0].coefficient > 0
    assert {r.feature for r in table} == {"dti", "loan_to_income", "grade=a", "grade=b", "grade=(other)"}
    assert [r.abs_coefficient for r in table] == sorted((abs(r.coefficient) for r in table), reverse=True)
    assert table[0].top_share == sum(r.feature in INTERACTION_COLS for r in table[:2]) / 2


def test_json_safe_of_every_type(spark):
    import datetime as dt
    from riskspark.operators.explain import json_safe
    df = spark.createDataFrame([(float("nan"), 3, "x", True, dt.date(2026, 1, 2)), (float("inf"), None, None, None, None), (1.5, 4, "y", False, None)],
                               "a double, b int, c string, d boolean, e date")
    got = [tuple(r) for r in df.select(*[json_safe(df, c) for c in df.columns]).collect()]
    assert got == [(None, "3.0", "x", "true", "2026-01-02"), (None, None, None, None, None), ("1.5", "4.0", "y", "false", None)]


def test_isotonic_fit_reads_its_rows_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for pdf in batches:
            seen.add(len(pdf))
            yield pdf

    df = spark.createDataFrame([(i / 100, int(i % 3 == 0)) for i in range(100)], "p_default double, default int")
    fit_isotonic(df.mapInPandas(count, df.schema))
    assert seen.value == 100  # before: once for the ranges of scores, once for the fit
