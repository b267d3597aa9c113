import math

from pyspark.sql import functions as F

from riskspark.functions.parse import default_flag, emp_length_years, month_year, term_months
from riskspark.operators.prepare import add_interactions, curate, time_split, recent_years


def test_default_flag_sets_and_censored(spark):
    rows = [("Charged Off",), ("Default",), ("Late (31-120 days)",), ("Late (16-30 days)",),
            ("Does not meet the credit policy. Status:Charged Off",), ("Fully Paid",),
            ("Does not meet the credit policy. Status:Fully Paid",), ("Current",), ("Issued",), ("weird",), (None,)]
    df = spark.createDataFrame(rows, "loan_status string")
    got = [r[0] for r in df.select(default_flag("loan_status")).collect()]
    assert got == [1, 1, 1, 1, 1, 0, 0, None, None, None, None]   # order kept


def test_parsers(spark):
    df = spark.createDataFrame([(" 36 months", "< 1 year", "Aug-2003"), (" 60 months", "10+ years", "bad"),
                                ("36", "3 years", None), (" 36 months", "unknown", "Jan-1999")],
                               "term string, emp string, d string")
    r = df.select(term_months("term").alias("t"), emp_length_years("emp").alias("e"), month_year("d").alias("y")).collect()
    assert [x.t for x in r] == [36, 60, 36, 36]
    assert [x.e for x in r] == [0.0, 10.0, 3.0, None]
    assert [x.y for x in r] == [2003, None, None, 1999]


def test_curate_drops_censored(spark):
    df = spark.createDataFrame([("Fully Paid", "Aug-2003"), ("Current", "Aug-2003"), ("Default", "Jan-2001")],
                               "loan_status string, issue_d string")
    out = curate(df).orderBy("issue_year").collect()
    assert [(r["default"], r.issue_year) for r in out] == [(1, 2001), (0, 2003)]


def test_interactions_safe_division_and_history(spark):
    rows = [(10000.0, 0.0, 300.0, 10.0, 36, 700.0, 20.0, 50.0, 1000.0, 0, 12.0, 1.0),
            (10000.0, 50000.0, 300.0, 10.0, 60, 650.0, 10.0, 40.0, 0.0, 4, 8.0, 2.0),
            (10000.0, -5.0, 300.0, 10.0, 36, 700.0, None, 50.0, 1000.0, None, 12.0, 1.0)]
    df = spark.createDataFrame(rows, "loan_amnt double, annual_inc double, installment double, int_rate double, "
                                     "term tinyint, fico_mean float, dti double, revol_util double, revol_bal double, "
                                     "credit_history_years smallint, total_acc double, delinq_2yrs double")
    out = add_interactions(df).collect()
    a, b, c = out
    assert a.loan_to_income is None and a.installment_to_income is None       # zero income
    assert c.loan_to_income is None                                            # negative income
    assert math.isclose(b.loan_to_income, 0.2, rel_tol=1e-6)
    assert math.isclose(b.installment_to_income, 300 * 12 / 50000, rel_tol=1e-6)
    assert math.isclose(b.int_rate_x_term, 600.0, rel_tol=1e-6)
    assert math.isclose(b.fico_dti_risk, (850 - 650) * 0.10, rel_tol=1e-6)
    assert math.isclose(a.accounts_per_year, 12.0, rel_tol=1e-6)              # history 0 clipped to 1
    assert math.isclose(b.accounts_per_year, 2.0, rel_tol=1e-6)
    assert c.accounts_per_year is None and c.fico_dti_risk is None            # NULL operand
    assert b.revol_util_x_logbal == 0.0
    assert set(df.columns) <= set(add_interactions(df).columns)               # input columns kept


def test_time_split_and_recent_years(spark):
    df = spark.createDataFrame([(y,) for y in [2014, 2015, 2016, 2017, 2018, None]], "issue_year int")
    tr, te = time_split(df)
    assert sorted(r[0] for r in tr.collect()) == [2014, 2015, 2016]
    assert sorted(r[0] for r in te.collect()) == [2017, 2018]
    assert sorted(r[0] for r in recent_years(df.dropna(), years=2).collect()) == [2017, 2018]
    assert sorted(r[0] for r in recent_years(df.dropna(), years=1, max_year=2016).collect()) == [2016]


def test_prediction_log_keeps_what_it_rejects(spark, tmp_path):
    from riskspark.sources.files import load_predictions, scan_predictions
    good = '{"ts": "2020-01-02T00:00:00Z", "application_id": "00123", "p_default": 0.5}'
    (tmp_path / "log.json").write_text(good + "\nnot json\n" + good.replace("0.5", '"oops"') + "\n\n")
    records, rejected = scan_predictions(spark, str(tmp_path / "log.json"))
    assert [r["application_id"] for r in records.collect()] == ["00123"] and rejected.count() == 2
    assert records.count() == 1 and load_predictions(spark, str(tmp_path / "none.json")).count() == 0
