import pytest
from pyspark.sql import functions as F

from riskspark.operators import monitor as MON
from riskspark.sources.files import load_ground_truth, load_predictions


def _log(spark):
    rows = [("2026-01-05 10:00:00", "a", 0.2, "reject"), ("2026-01-20 10:00:00", "b", 0.8, "reject"),
            ("2026-02-03 10:00:00", "c", 0.6, "reject"), ("2026-02-10 10:00:00", "d", 0.3, "reject"),
            ("2026-02-11 10:00:00", None, 0.1, "approve")]
    return spark.createDataFrame(rows, "ts string, application_id string, p_default double, decision string") \
        .withColumn("ts", F.col("ts").cast("timestamp"))


def test_join_drops_null_and_unmatched(spark):
    truth = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1), ("zz", 0)], "application_id string, actual int")
    j = MON.join_outcomes(_log(spark), truth)
    assert sorted(r.application_id for r in j.collect()) == ["a", "b", "c"]
    u = MON.unlabeled_counts(_log(spark), truth).first()
    assert (u.n_predictions, u.n_labelled, u.n_unlabeled) == (5, 3, 2)


def test_realized_single_class_and_months(spark):
    truth = spark.createDataFrame([("a", 0), ("b", 1), ("c", 1), ("d", 1)], "application_id string, actual int")
    j = MON.join_outcomes(_log(spark), truth)
    m = {r.month: r for r in MON.realized_monthly(j).collect()}
    assert set(m) == {"2026-01", "2026-02"}
    assert m["2026-01"].roc_auc == 1.0 and m["2026-01"].n == 2
    assert m["2026-02"].roc_auc is None and m["2026-02"].log_loss is None and m["2026-02"].brier is not None


def test_daily_and_headline(spark):
    d = MON.daily_table(_log(spark)).collect()
    assert len(d) == 5
    h = MON.headline(_log(spark), _log(spark)).first()
    assert h.psi is None and h.psi_band == "INSUFFICIENT_DATA" and h.n_predictions == 5


def test_prediction_log_reader_skips_bad_lines(spark, tmp_path):
    p = tmp_path / "log"
    p.mkdir()
    (p / "part-0.json").write_text(
        '{"ts": "2026-01-01T00:00:00+00:00", "application_id": "a", "p_default": 0.2, "decision": "approve"}\n'
        'not json at all\n'
        '{"ts": "2026-02-01T00:00:00+00:00", "application_id": "b", "p_default": 0.7, "decision": "reject"}\n')
    df = load_predictions(spark, str(p))
    assert df.count() == 2 and len(df.collect()) == 2
    assert load_predictions(spark, str(p), since="2026-01-15").count() == 1
    assert load_predictions(spark, str(tmp_path / "missing")).count() == 0


def test_ground_truth_reader(spark, tmp_path):
    f = tmp_path / "truth.csv"
    f.write_text("application_id,default\n1,0\n2,1\n")
    t = load_ground_truth(spark, str(f))
    assert sorted(tuple(r) for r in t.collect()) == [("1", 0), ("2", 1)]
    g = tmp_path / "t2.csv"
    g.write_text("id,label\n1,0\n")
    assert load_ground_truth(spark, str(g), "id", "label").first().application_id == "1"
    with pytest.raises(ValueError):
        load_ground_truth(spark, str(g))
    with pytest.raises(ValueError):
        load_ground_truth(spark, str(tmp_path / "x.json"))
