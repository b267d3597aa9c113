"""Plan checks: native operators stay JVM-side (no Python UDF evaluation)."""

import pytest

from riskspark.plans import tables as TB

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["clean_loans", "scored_loans", "row_violations", "metric_row", "cost_curve",
                                  "daily_monitor", "linear_reason_codes"])
def test_no_python_udf(spark, name):
    import __spark_entry__ as E
    plan = _plan(E.queries()[name](spark, SF))
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_scan_prunes_columns(spark):
    plan = _plan(TB.raw(spark, SF).select("grade"))
    # the lineitem scan reads only the columns the view needs, never l_comment etc.
    assert "l_comment" not in plan and "l_shipinstruct" not in plan


def test_model_comparison_flags(spark):
    from pyspark.sql import functions as F
    from riskspark.operators.metrics import compare_metric_rows
    a = spark.createDataFrame([(0.6, 0.20)], "roc_auc double, brier double")
    b = spark.createDataFrame([(0.7, 0.25)], "roc_auc double, brier double")
    r = {x.metric: x for x in compare_metric_rows(a, b).collect()}
    assert r["roc_auc"].b_better is True and r["brier"].b_better is False
    assert r["roc_auc"].delta == pytest.approx(0.1)
