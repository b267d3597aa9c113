"""Model-fitting and streaming queries.

Queries of boosted and logistic fits have no SQL oracle (fits are iterative); the
driver records a rows-only check and the tests check their invariants. Streaming queries read
files that Spark derives from the driver tables, run with
``trigger(availableNow=True)`` and return the sink as a batch DataFrame.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from riskspark import streaming as ST
from riskspark.operators import metrics as M
from riskspark.operators import monitor as MON
from riskspark.operators.boosting import exists, fit_boosted
from riskspark.operators.calibration import CalibratedModel, fit_calibrated, recalibrate
from riskspark.operators.models import fit_lr
from riskspark.operators.ordered import materialize
from riskspark.operators.prepare import recent_years
from riskspark.operators.scoring import FROZEN_SCORECARD, score_batch
from riskspark.plans import tables as TB
from riskspark.plans.catalog import _EPS, _PSI_PROBS, _RANK_SQL, _violation_rules, ISOTONIC_CTES, R, register
from riskspark.plans.sqlbase import quantile_ctes, with_base
from riskspark.schema import CLEAN_FEATURES_V2
from riskspark.session import ensure_checkpoint_dir
from riskspark.sources.files import append_log, load_predictions, read_any, to_log_records, write_any


def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _splits(spark, d):
    """The columns that models and their reports read, written once a query: all, base, calibration and test years."""
    s = TB.scored_table(spark, d, *dict.fromkeys([*CLEAN_FEATURES_V2, "default", "issue_year", "application_id"]))
    y = F.col("issue_year")
    return s, s.filter(y <= TB.BASE_MAX), s.filter(y == TB.CALIB), s.filter(y >= TB.TEST_MIN)


def calibrated_gbt(spark, base, calib) -> CalibratedModel:
    """Boosted trees on base years + isotonic on the calibration year. The model, and the stages of a fit
    that has not ended, stand in a folder named by the rows they are fitted on, so that a later query or session with
    the same checkpoint folder loads or resumes them, and changed tables get a model of their own."""
    rows = F.bit_xor(F.xxhash64(*base.columns))
    both = base.unionByName(calib).agg(F.count(F.lit(1)).alias("n"), rows.alias("x")).first()
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/model-gbt-{both['n']}-{(both['x'] or 0) & (2**64 - 1):016x}"
    if not exists(spark, f"{path}/model/isotonic/data"):  # what a save writes last
        model = fit_calibrated(base, calib, lambda df: fit_boosted(df, CLEAN_FEATURES_V2, store=f"{path}/fit"))
        model.save(f"{path}/model")
    return CalibratedModel.load(f"{path}/model")


def _metric_row(scored):
    # scored once: the metrics read the scores in several passes
    return M.metric_row(materialize(scored.select("default", "p_default")))


@register("lr_test_metrics", None)
def q_lr_test_metrics(spark, d):
    loans = materialize(TB.cleaned2(spark, d).select(*dict.fromkeys([*CLEAN_FEATURES_V2, "default", "issue_year"])))
    base, test = (loans.filter(c) for c in (F.col("issue_year") <= TB.BASE_MAX, F.col("issue_year") >= TB.TEST_MIN))
    lr = fit_lr(base, CLEAN_FEATURES_V2)
    return _metric_row(CalibratedModel(lr, None).score(test))


@register("gbt_calibrated_metrics", None)
def q_gbt_calibrated_metrics(spark, d):
    _, base, calib, test = _splits(spark, d)
    return _metric_row(calibrated_gbt(spark, base, calib).score(test))


@register("gbt_feature_importance", None)
def q_gbt_feature_importance(spark, d):
    _, base, calib, _ = _splits(spark, d)
    return calibrated_gbt(spark, base, calib).base.importance(spark).limit(15)


@register("recalibration_report", None)
def q_recalibration_report(spark, d):
    """Frozen base, isotonic refit on the most recent labelled year before the
    evaluation year; calibration summary before and after."""
    s, base, calib, _ = _splits(spark, d)
    model = calibrated_gbt(spark, base, calib)
    window = recent_years(s.filter(F.col("issue_year") <= TB.TEST_MIN), years=1, max_year=TB.TEST_MIN)
    new = recalibrate(model, window)
    ev = s.filter(F.col("issue_year") > TB.TEST_MIN)
    before = MON.calibration_summary(model.score(ev)).withColumn("stage", F.lit("before"))
    after = MON.calibration_summary(new.score(ev)).withColumn("stage", F.lit("after"))
    return before.unionByName(after)


@register("gbt_batch_scoring", None)
def q_gbt_batch_scoring(spark, d):
    """Batch path: write the test slice as CSV, read it back by suffix, check
    columns, derive interactions, pin levels, score, decide, write Parquet."""
    _, base, calib, test = _splits(spark, d)
    src = _scratch(spark, "batch-in") + ".csv"
    batch = test.select(*[c for c in CLEAN_FEATURES_V2 if c not in ("loan_to_income",)], "application_id")
    write_any(batch, src)
    df = read_any(spark, src, schema=batch.schema)
    out = score_batch(df, calibrated_gbt(spark, base, calib), threshold=0.13)
    dst = _scratch(spark, "batch-out") + ".parquet"
    write_any(out.select("application_id", "p_default", "decision"), dst)
    return MON.batch_summary(read_any(spark, dst))


# ----------------------------------------------------------------- streaming --

def _event_stream(spark, d):
    ev = TB.table(spark, d, "events")
    st = spark.readStream.schema(ev.schema).parquet(f"{d.rstrip('/')}/events.parque[t]")
    p = F.least(F.col("value") / 500.0, F.lit(1.0))
    return st.select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_id").cast("string").alias("application_id"),
                     F.col("user_id"), p.alias("p_default"),
                     F.when(p >= 0.13, "reject").otherwise("approve").alias("decision"))


def _ended(spark, d):
    """The events feed and a marker row after its end, which closes the last windows."""
    last = TB.table(spark, d, "events").agg(F.max("ts").cast("timestamp").alias("t")).first()["t"]
    return ST.with_end_marker(_event_stream(spark, d), last)


@register("stream_daily_events", """
select strftime(cast(ts as date), '%Y-%m-%d') as date, count(*) as n,
       (case when abs(avg(least(value / 500e0, 1e0))) < 1e12
             then floor(avg(least(value / 500e0, 1e0)) * 1e6 + 0.5) / 1e6 end) as mean_p_default,
       floor(avg(case when least(value / 500e0, 1e0) >= 0.13e0 then 1e0 else 0e0 end) * 1e6 + 0.5) / 1e6 as reject_rate
from events
group by 1""")
def q_stream_daily_events(spark, d):
    """1-day windows (append mode, 1-day watermark) over the events feed, all of
    which a marker row after its end closes."""
    return ST.run_available(ST.daily_windows(_ended(spark, d)), name="daily")


@register("stream_dedup_events", """
select cast(event_id as varchar) as application_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts from events""")
def q_stream_dedup_events(spark, d):
    """The events feed with every third event delivered twice: each id once
    (the state is bounded by the watermark)."""
    again = _event_stream(spark, d).filter(F.col("application_id").cast("bigint") % 3 == 0)
    once = ST.run_available(ST.dedup_predictions(_event_stream(spark, d).unionByName(again)), name="dedup")
    return once.select("application_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"))


_BROKEN = "concat_ws(',', " + ", ".join(f"case when {broken} then '{v}' end" for v, broken in _violation_rules()) + ")"


@register("stream_scored_log", with_base(f"""
v as (select application_id, p_default, {_BROKEN} as violation from scored)
select application_id, case when violation = '' then 'scored' else 'quarantined' end as status,
       case when violation = '' then p_default end as p_default,
       case when violation <> '' then violation end as violation from v"""))
def q_stream_scored_log(spark, d):
    """Applications arrive as Parquet files -> field rules -> valid rows scored
    with the frozen scorecard into the JSON prediction log, broken rows into
    a quarantine sink (both checkpointed) -> both read back."""
    apps = TB.cleaned(spark, d).drop("default", "issue_year")
    src = _scratch(spark, "apps")
    apps.write.parquet(src)
    stream = spark.readStream.schema(apps.schema).parquet(src)
    scored = ST.score_stream(stream, FROZEN_SCORECARD, 0.13, FROZEN_SCORECARD.name)
    log = ST.run_available(to_log_records(scored, 0.13, FROZEN_SCORECARD.name), fmt="json", name="scorelog")
    quar = ST.run_available(ST.quarantine_stream(stream).select("application_id", "violations"), name="quarantine")
    return (log.select("application_id", F.lit("scored").alias("status"), "p_default",
                       F.lit(None).cast("string").alias("violation"))
            .unionByName(quar.select("application_id", F.lit("quarantined").alias("status"),
                                     F.lit(None).cast("double").alias("p_default"),
                                     F.array_join("violations", ",").alias("violation"))))


@register("stream_outcome_join", with_base("""
select p.ts, p.application_id, p.p_default, p.decision, o.actual
from predlog p join outcomes o on o.application_id = p.application_id"""))
def q_stream_outcome_join(spark, d):
    """Logged predictions (JSON log written by the batch sink) streamed and
    joined to the static outcome table."""
    log_dir = _scratch(spark, "predlog")
    plog = TB.prediction_log(spark, d)
    append_log(to_log_records(plog, 0.13, FROZEN_SCORECARD.name, ts="ts"), log_dir)
    batch = load_predictions(spark, log_dir)
    stream = spark.readStream.schema(batch.schema).json(log_dir)
    joined = ST.join_outcomes_stream(stream.select("ts", "application_id", "p_default", "decision"),
                                     TB.outcomes(spark, d))
    return ST.run_available(joined, name="outjoin").withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _window_psi_sql(days: int, rolling: bool = False) -> str:
    bins = " + ".join(f"case when v >= (select quantile from qe where qi = {i}) then 1 else 0 end"
                      for i in range(len(_PSI_PROBS)))
    feed = "select least(value / 500e0, 1e0) as v, " + (
        f"date_trunc('day', ts) - to_days(cast(back as integer)) as w from events cross join range({days}) r(back)" if rolling else
        f"time_bucket(interval {days} day, ts, timestamp '1970-01-01') as w from events")
    return with_base(f"""{quantile_ctes('qe', 'train_scored', 'p_default', _PSI_PROBS)},
ev as (select p_default as v from train_scored where p_default is not null),
av as ({feed}),
eb as (select {bins} as bin, count(*) as n from ev group by 1),
ab as (select w, {bins} as bin, count(*) as n from av group by 1, 2),
t as (select w, sum(n) as n from ab group by w),
sh as (select t.w, t.n, greatest(coalesce(eb.n, 0) / (select count(*) from ev), 1e-6) as e,
              greatest(coalesce(ab.n, 0) / t.n, 1e-6) as a
       from t cross join (select i as bin from range(10) r(i)) b
       left join eb on eb.bin = b.bin left join ab on ab.bin = b.bin and ab.w = t.w)
select strftime(w, '%Y-%m-%d') as window_start, cast(n as bigint) as n,
       case when n >= 1000 then {R('sum((a - e) * ln(a / e))')} end as psi, 10 as n_bins
from sh group by w, n""")


def _window_psi(spark, d, days: int):
    """PSI of the events feed per window of ``days`` against static edges of the
    training scores (NULL under 1,000 rows in a window)."""
    ref = TB.train_table(spark, d, "p_default")
    edges = M.psi_edges(ref, "p_default")
    shares = M.psi_table(ref, "p_default", ref, "p_default", edges=edges, checkpoint=False) \
        .orderBy("bin").select("e_share").collect()
    counts = ST.run_available(ST.psi_bin_counts(_ended(spark, d), edges, window=f"{days} days"), name="psibins")
    out = ST.psi_by_window(counts, [r["e_share"] for r in shares])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@register("stream_psi_daily", _window_psi_sql(1))
def q_stream_psi_daily(spark, d):
    return _window_psi(spark, d, 1)


@register("stream_psi_weekly", _window_psi_sql(7))
def q_stream_psi_weekly(spark, d):
    return _window_psi(spark, d, 7)


@register("stream_psi_rolling", _window_psi_sql(7, rolling=True))
def q_stream_psi_rolling(spark, d):
    """PSI of the events feed over every seven days, from counts that a foreachBatch sink keeps by batch."""
    ref = TB.train_table(spark, d, "p_default")
    edges = M.psi_edges(ref, "p_default")
    shares = M.psi_table(ref, "p_default", ref, "p_default", edges=edges, checkpoint=False) \
        .orderBy("bin").select("e_share").collect()
    base = _scratch(spark, "psi-batches")
    daily = ST.psi_batches(_event_stream(spark, d), edges, f"{base}/counts", f"{base}/checkpoint")
    out = ST.psi_by_window(ST.rolling_counts(daily, 7), [r["e_share"] for r in shares])
    return out.withColumn("window_start", F.date_format("window_start", "yyyy-MM-dd"))


@register("stream_outcomes_matched", """
select cast(event_id as varchar) as application_id,
       case when event_id % 3 <> 0 and event_id % 15 - 2 between 0 and 10 then cast(event_id % 2 as integer) end as actual
from events""")
def q_stream_outcomes_matched(spark, d):
    """Predictions and outcomes as two feeds of several files, joined within ten days: a third have no outcome, some have
    one before the prediction or later than that."""
    ev = TB.table(spark, d, "events")
    at = F.col("ts").cast("timestamp")
    preds = ev.select(at.alias("ts"), F.col("event_id").cast("string").alias("application_id"))
    outcomes = ev.filter("event_id % 3 != 0").select(
        F.col("event_id").cast("string").alias("application_id"),
        (at + F.make_dt_interval((F.col("event_id") % 15 - 2).cast("int"))).alias("outcome_ts"), (F.col("event_id") % 2).cast("int").alias("actual"))
    span = ev.agg(F.min(at).alias("low"), F.max(at).alias("high")).first()
    bounds = [span["low"] + (span["high"] - span["low"]) * k / 3 for k in (1, 2)]
    feeds = []
    for df, ts in ((preds, "ts"), (outcomes, "outcome_ts")):
        path = _scratch(spark, "feed")
        ST.write_feed(df, path, ts, bounds, span["high"], "60 days")
        feeds.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(path))
    joined = ST.join_outcome_streams(*feeds)
    return ST.run_available(joined, name="matched").select("application_id", "actual")


# ------------------------------------------------------------ file sources --

@register("raw_csv_scan", """with """ + __import__("riskspark.plans.sqlbase", fromlist=["BASE_CTES"]).BASE_CTES + """
select loan_status, count(*) as n from loans group by loan_status""")
def q_raw_csv_scan(spark, d):
    """Loans written as a raw CSV file set, scanned back with the declared
    schema and only the selected columns parsed."""
    from riskspark.sources.files import load_raw
    path = _scratch(spark, "raw") + ".csv"
    TB.raw(spark, d).drop("application_id").write.option("header", True).csv(path)
    raw = load_raw(spark, path, usecols=["grade", "loan_status"])
    return raw.groupBy("loan_status").agg(F.count(F.lit(1)).alias("n"))


@register("curated_table_roundtrip", """with """ + __import__("riskspark.plans.sqlbase", fromlist=["BASE_CTES"]).BASE_CTES + """
select issue_year, count(*) as n, count(*) filter (where "default" = 1) as n_default
from curated where issue_year <= 1999 group by issue_year""")
def q_curated_table_roundtrip(spark, d):
    """Curated table written partitioned by issue_year; reading the training
    years back prunes partitions instead of filtering rows."""
    from riskspark.operators.prepare import write_cleaned
    from riskspark.sources.files import load_curated
    path = _scratch(spark, "curated")
    write_cleaned(TB.curated(spark, d), path)
    back = load_curated(spark, path).filter(F.col("issue_year") <= TB.TRAIN_MAX)
    return back.groupBy("issue_year").agg(F.count(F.lit(1)).alias("n"),
                                          F.count_if(F.col("default") == 1).alias("n_default"))


@register("ground_truth_file_join", """with """ + __import__("riskspark.plans.sqlbase", fromlist=["BASE_CTES"]).BASE_CTES + """
select count(*) as n_matched, sum(o.actual) as n_default
from predlog p join outcomes o on o.application_id = p.application_id""")
def q_ground_truth_file_join(spark, d):
    """Outcomes delivered as a CSV file with their own column names, read by
    the outcome reader and joined to the prediction log."""
    from riskspark.sources.files import load_ground_truth
    path = _scratch(spark, "truth") + ".csv"
    (TB.curated(spark, d).select(F.col("application_id").alias("app"), F.col("default").alias("label"))
     .write.option("header", True).csv(path))
    truth = load_ground_truth(spark, path, id_col="app", label_col="label")
    j = MON.join_outcomes(TB.prediction_log(spark, d), truth)
    return j.agg(F.count(F.lit(1)).alias("n_matched"), F.sum("actual").cast("bigint").alias("n_default"))


def _metric_ctes(name: str, src: str) -> str:
    """CTE ``name`` (metric, value): the metric row of ``src`` ("default", p_default)."""
    rank = _RANK_SQL.format(src=src).replace("g as (", f"{name}_g as (", 1).replace("c as (", f"{name}_c as (", 1) \
        .replace(" from g)", f" from {name}_g)")
    clip = f"least(greatest(p_default, {_EPS}), 1 - {_EPS})"
    return f"""{rank},
{name}_r as (select sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N)) as roc_auc,
  sum(case when pos > 0 then pos * ((P - cp + pos) / ((P - cp + pos) + (N - cn + neg))) end) / max(P) as pr_auc,
  max(abs(cp / P - cn / N)) as ks from {name}_c),
{name}_p as (select avg((p_default - "default") * (p_default - "default")) as brier,
  avg(-("default" * ln({clip}) + (1 - "default") * ln(1 - {clip}))) as log_loss from {src}),
{name} as (""" + " union all ".join(f"select '{m}' as metric, {m} as value from {name}_{t}" for m, t in (
        ("roc_auc", "r"), ("pr_auc", "r"), ("brier", "p"), ("log_loss", "p"), ("ks", "r"))) + ")"


@register("model_comparison", with_base(f"""{ISOTONIC_CTES},
knots as (select o.x, f.fit from f join o using (i)),
below as (select t.loan_id, t."default", t.p_default as s, k.x as x0, k.fit as y0
          from test_scored t asof left join knots k on k.x <= t.p_default),
around as (select b.*, k.x as x1, k.fit as y1 from below b asof left join knots k on k.x >= b.s),
calibrated as (select "default", case when x0 is null then y1 when x1 is null or x0 = x1 then y0
                 else y0 + (y1 - y0) * (s - x0) / (x1 - x0) end as p_default from around),
{_metric_ctes('ma', 'test_scored')},
{_metric_ctes('mb', 'calibrated')}
select metric, {R('ma.value')} as value_scorecard, {R('mb.value')} as value_calibrated,
       {R('mb.value - ma.value')} as delta,
       case when metric in ('brier', 'log_loss') then mb.value < ma.value else mb.value > ma.value end as calibrated_better
from ma join mb using (metric)"""))
def q_model_comparison(spark, d):
    """Frozen scorecard vs the same scorecard recalibrated (isotonic on the
    calibration year): metric by metric with delta and a better flag."""
    from riskspark.operators.calibration import fit_isotonic
    s = TB.scored_table(spark, d, "issue_year", "default", "p_default")
    calib = s.filter(F.col("issue_year") == TB.CALIB)
    test = s.filter(F.col("issue_year") >= TB.TEST_MIN)
    iso = fit_isotonic(calib, "p_default", "default", "p_cal")
    cal = iso.transform(test).drop("p_default").withColumnRenamed("p_cal", "p_default")
    a = M.metric_row(test, checkpoint=False)
    b = M.metric_row(cal, checkpoint=False)
    return M.compare_metric_rows(a, b, "scorecard", "calibrated")

