import datetime as dt

import pytest
from pyspark.sql import functions as F

from riskspark.operators import metric_state as MS
from riskspark.operators import monitor as MON

LOG = "ts string, application_id string, p_default double, decision string"


def _log(spark):
    rows = [(f"2026-{1 + i % 3:02d}-{1 + i % 5:02d} 10:00:00", str(i), (i * 7 % 20) / 20, "reject" if i * 7 % 20 > 10 else "approve")
            for i in range(120)]
    rows += [(None, "x", 0.5, None), ("2026-01-01 09:00:00", "y", None, "approve"), ("2026-02-02 09:00:00", None, 0.25, "reject")]
    return spark.createDataFrame(rows, LOG).withColumn("ts", F.col("ts").cast("timestamp")).cache()


def _truth(spark):
    rows = [(str(i), int(i % 4 == 0)) for i in range(0, 120, 2)] + [("x", 1), ("nobody", 1), ("3", None)]
    return spark.createDataFrame(rows, "application_id string, actual int").cache()


def _rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def _files(path):
    return {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_state_equals_full_recompute_and_redelivery_changes_nothing(spark, tmp_path):
    log, truth, path = _log(spark), _truth(spark), str(tmp_path / "state")
    feb = F.col("ts") >= F.lit("2026-02-01").cast("timestamp")
    MS.add_delta(MS.prediction_counts(log.filter(~F.coalesce(feb, F.lit(True)))), path, "log-1")
    for _ in range(2):
        MS.add_delta(MS.prediction_counts(log.filter(F.coalesce(feb, F.lit(True)))), path, "log-2")
    for i in (0, 1):  # outcomes in two loads, of predictions of all months
        MS.add_delta(MS.outcome_counts(log, truth.filter(F.coalesce(F.try_to_number("application_id", F.lit("999")) % 4 == 0, F.lit(False)) == F.lit(i == 0))),
                     path, f"outcomes-{i}")
    state = MS.read_state(spark, path)
    assert _rows(MS.daily_from_state(state)) == _rows(MON.daily_table(log))
    joined = MON.join_outcomes(log, truth).filter("actual is not null")
    assert _rows(MS.monthly_from_state(state)) == _rows(MON.realized_monthly(joined))
    assert _rows(MS.realized_from_state(state)) == _rows(MON.realized_metrics(joined))


def test_a_new_day_touches_no_other_folder(spark, tmp_path):
    log, path = _log(spark), tmp_path / "state"
    MS.add_delta(MS.prediction_counts(log.filter("ts is not null")), str(path), "first")
    before = _files(path)
    more = spark.createDataFrame([(dt.datetime(2026, 2, 27), "n1", 0.4, "reject")], "ts timestamp, application_id string, p_default double, decision string")
    MS.add_delta(MS.prediction_counts(more), str(path), "second")
    after = _files(path)
    assert {f: after[f] for f in before} == before
    assert [f.parent.parent.name for f in set(after) - set(before)] == ["month=2026-02"]
    MS.add_delta(MS.prediction_counts(more.limit(0)), str(path), "third")
    assert _files(path) == after
    late = MS.read_state(spark, str(path), first_day="2026-02-20", last_day="2026-02-28")
    assert [(r.day, r.n) for r in late.collect()] == [(dt.date(2026, 2, 27), 1)]


def test_other_months_are_not_read(spark, tmp_path):
    path = str(tmp_path / "state")
    MS.add_delta(MS.prediction_counts(_log(spark).filter("ts is not null")), path, "first")
    plan = MS.read_state(spark, path, "2026-02-01", "2026-02-28")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert "month" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_empty_state_and_bad_names(spark, tmp_path):
    state = MS.read_state(spark, str(tmp_path / "none"))
    assert state.count() == MS.daily_from_state(state).count() == MS.monthly_from_state(state).count() == 0
    assert MS.realized_from_state(state).count() == 0
    with pytest.raises(ValueError):
        MS.add_delta(MS.prediction_counts(_log(spark)), str(tmp_path / "s"), "a/b")
