from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from riskspark.operators.calibration import fit_calibrated
from riskspark.operators.models import fit_lr
from riskspark.operators.scoring import FROZEN_SCORECARD, score_batch
from riskspark.plans import tables as TB
from riskspark.schema import CLEAN_FEATURES_V2
from riskspark.sources.bucketed import join_bucketed, write_bucketed
from riskspark.sources.registry import ModelRegistry

SF = "/root/testdata/sf0.001"


def _scores(df):
    return sorted((r.application_id, r.p_default) for r in df.select("application_id", "p_default").collect())


def test_save_swap_load_in_another_session(spark, tmp_path):
    loans = TB.cleaned2(spark, SF).cache()
    columns = {c: loans.schema[c].dataType.simpleString() for c in CLEAN_FEATURES_V2}
    levels = {"grade": ["A", "B"]}
    registry = ModelRegistry(spark, str(tmp_path))
    assert registry.current("m") is None and registry.versions("m") == []
    first = registry.save("m", replace(FROZEN_SCORECARD, intercept=0.0), columns)
    second = registry.save("m", FROZEN_SCORECARD, columns, levels)
    assert set(registry.versions("m")) == {first, second}
    other = ModelRegistry(spark.newSession(), str(tmp_path))
    model = other.load("m")
    assert (model.version, list(model.columns), model.levels, model.model) == (second, CLEAN_FEATURES_V2, levels, FROZEN_SCORECARD)
    got = model.score(loans)
    assert _scores(got) == _scores(score_batch(loans, FROZEN_SCORECARD))
    assert got.filter("grade not in ('A', 'B')").count() == 0
    aligned = model.score(loans.drop("mort_acc").withColumn("branch", F.lit(1)), keep=["application_id"], align=True)
    assert _scores(aligned) == _scores(got) and "branch" not in aligned.columns
    registry.use("m", first)
    assert other.load("m").model.intercept == 0.0 and other.load("m", second).model == FROZEN_SCORECARD


def test_unfinished_unknown_and_used_versions(spark, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    version = registry.save("m", FROZEN_SCORECARD, {})
    (tmp_path / "m" / "versions" / "halfway" / "model").mkdir(parents=True)
    assert registry.versions("m") == [version]
    for wrong in (lambda: registry.use("m", "halfway"), lambda: registry.load("n"), lambda: registry.drop_version("m", version),
                  lambda: registry.load("m", "halfway"), lambda: registry.save("a/b", FROZEN_SCORECARD, {})):
        with pytest.raises(ValueError):
            wrong()
    newer = registry.save("m", FROZEN_SCORECARD, {}, use=False)
    assert registry.current("m") == version
    registry.drop_version("m", newer)
    assert registry.versions("m") == [version]


def test_fitted_model_keeps_its_scores(spark, tmp_path):
    loans = TB.cleaned2(spark, SF).cache()
    model = fit_calibrated(loans.filter("issue_year <= 1998"), loans.filter("issue_year = 1999"),
                           lambda df: fit_lr(df, CLEAN_FEATURES_V2))
    registry = ModelRegistry(spark, str(tmp_path))
    registry.save("fitted", model, {c: "double" for c in CLEAN_FEATURES_V2})
    assert _scores(registry.load("fitted").score(loans)) == _scores(score_batch(loans, model))


def test_bucketed_join_has_no_exchange(spark, tmp_path):
    log = spark.createDataFrame([(str(i % 40), float(i)) for i in range(100)] + [(None, 1.0)], "application_id string, p double")
    truth = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)] + [(3, 1)], "application_id long, actual int")
    write_bucketed(log, "t_log", "application_id", 4, str(tmp_path / "log"))
    write_bucketed(truth, "t_truth", "application_id", 4, str(tmp_path / "truth"))
    joined = join_bucketed(spark, "t_log", "t_truth")
    want = log.join(truth.withColumn("application_id", F.col("application_id").cast("string")), "application_id")
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, want.collect()))
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    write_bucketed(log.limit(5), "t_log", "application_id", 4, str(tmp_path / "log"), mode="append")
    again = join_bucketed(spark, "t_log", "t_truth")
    assert "Exchange" not in again._jdf.queryExecution().executedPlan().toString()
    assert spark.table("t_log").count() == 106
    spark.sql("drop table t_log")
    spark.sql("drop table t_truth")
