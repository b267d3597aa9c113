"""Queries over stored state: additive monitoring counts, bucketed log and outcomes,
models by name, sketches, late rows, files in and out."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from riskspark.operators import metric_state as MS
from riskspark.operators import sketches as SK
from riskspark.operators.models import coefficient_table, fit_lr
from riskspark.operators.monitor import batch_summary
from riskspark.operators.ordered import materialize
from riskspark.operators.profile import long_values
from riskspark.operators.scoring import FROZEN_SCORECARD, score_batch
from riskspark.plans import tables as TB
from riskspark.plans.catalog import P_DEC, REGISTRY, R, register
from riskspark.plans.sqlbase import unpivot, with_base
from riskspark.schema import CLEAN_FEATURES_V2, INTERACTION_COLS, NUMERIC_FEATURES_V2
from riskspark.session import scratch_path
from riskspark.sources.bucketed import join_bucketed, write_bucketed
from riskspark.sources.files import read_any, write_any
from riskspark.sources.registry import ModelRegistry
from riskspark.streaming import file_stream
from riskspark.streaming.late import quarantine_late


def _metric_state(spark, d):
    """The prediction log in two deltas, the second delivered twice, and the
    outcomes in two loads, the second of outcomes that came in later."""
    path = scratch_path(spark, "metric-state")
    log = materialize(TB.prediction_log(spark, d).select("ts", "application_id", "p_default", "decision"))
    truth = TB.curated(spark, d).select("application_id", F.col("default").cast("int").alias("actual"), "issue_year")
    truth = materialize(truth)
    start = F.lit(TB.PROD_START).cast("timestamp")
    late = F.coalesce(F.col("issue_year") >= TB.TEST_MIN, F.lit(True))
    MS.add_delta(MS.prediction_counts(log.filter(F.col("ts") < start)), path, "log-1")
    rest = MS.prediction_counts(log.filter(F.coalesce(F.col("ts") >= start, F.lit(True))))
    for _ in range(2):
        MS.add_delta(rest, path, "log-2")
    MS.add_delta(MS.outcome_counts(log, truth.filter(~late).drop("issue_year")), path, "outcomes-1")
    MS.add_delta(MS.outcome_counts(log, truth.filter(late).drop("issue_year")), path, "outcomes-2")
    return MS.read_state(spark, path)


@register("state_daily", REGISTRY["daily_monitor"][1])
def q_state_daily(spark, d):
    t = MS.daily_from_state(_metric_state(spark, d), p_decimals=P_DEC)
    return t.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("state_monthly", REGISTRY["realized_monthly"][1])
def q_state_monthly(spark, d):
    return MS.monthly_from_state(_metric_state(spark, d), p_decimals=P_DEC)


@register("state_overall", REGISTRY["realized_overall"][1])
def q_state_overall(spark, d):
    return MS.realized_from_state(_metric_state(spark, d), p_decimals=P_DEC)


@register("registry_scored_loans", REGISTRY["scored_loans"][1])
def q_registry_scored_loans(spark, d):
    """A first version is replaced by the frozen scorecard; the loans are scored by name."""
    registry = ModelRegistry(spark, scratch_path(spark, "registry"))
    loans = TB.cleaned2(spark, d)
    columns = {c: loans.schema[c].dataType.simpleString() for c in CLEAN_FEATURES_V2}
    registry.save("default-risk", replace(FROZEN_SCORECARD, intercept=0.0), columns)
    registry.save("default-risk", FROZEN_SCORECARD, columns)
    scored = registry.load("default-risk").score(loans, threshold=0.13)
    return scored.select("application_id", "p_default", "decision")


# Buckets of the registered query's tables; a parameter of write_bucketed.
BUCKETS = 64


@register("bucketed_outcome_join", REGISTRY["outcome_join"][1])
def q_bucketed_outcome_join(spark, d):
    """Log and outcomes stored in buckets of application_id, joined without an exchange."""
    run = uuid.uuid4().hex
    names = [f"riskspark_{t}_{run}" for t in ("log", "outcomes")]
    log = TB.prediction_log(spark, d).select("ts", "application_id", "p_default", "decision")
    for name, df in zip(names, (log, TB.outcomes(spark, d))):
        write_bucketed(df, name, "application_id", BUCKETS, scratch_path(spark, name))
    joined = join_bucketed(spark, *names)
    return joined.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "application_id", "p_default",
                         "decision", "actual")


_SKETCH_PROBS = [0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99]
# Seven probabilities of some 25 columns at 99 % each: twice the bound holds for all.
_SKETCH_BOUND = 2 * SK.rank_error()


@register("sketch_quantiles", with_base(f"""lv as ({unpivot('cleaned2', NUMERIC_FEATURES_V2)})
select column_name, count(*) as n, {R('min(value)')} as lowest, {R('max(value)')} as highest, {len(_SKETCH_PROBS)} as n_within
from lv where value is not null and not isnan(value) group by 1"""))
def q_sketch_quantiles(spark, d):
    """Sketches of every feature and year, stored, then merged over the years: how many of the quantiles
    read from them have a rank within the bound in the whole table."""
    loans = materialize(TB.cleaned2(spark, d).select("issue_year", *NUMERIC_FEATURES_V2))
    values = long_values(loans, NUMERIC_FEATURES_V2, keep=["issue_year"])
    path = scratch_path(spark, "sketches")
    SK.sketch(values, "value", ["column_name", "issue_year"]).write.mode("overwrite").parquet(path)
    merged = materialize(SK.merge(spark.read.parquet(path), ["column_name"]))
    misses = SK.rank_misses(values, "value", SK.quantiles(merged, _SKETCH_PROBS, ["column_name"]), ["column_name"])
    within = misses.groupBy("column_name").agg(F.count_if(F.col("miss") <= _SKETCH_BOUND).cast("int").alias("n_within"))
    return merged.join(within, "column_name").select("column_name", "n", "lowest", "highest", "n_within")


_CUT = "(select cast(min(ts) as date) + cast(date_diff('day', min(ts), max(ts)) // 3 as integer) from events)"


@register("stream_late_quarantine", f"""
e as materialized (select event_id, ts, ts < {_CUT} as early from events),
w as (select max(ts) - interval 1 day as b from e where early and event_id % 10 <> 0),
feed as (select event_id, ts, 1 as file from e where early and event_id % 10 <> 0
         union all select event_id, ts, 2 from e where not early or event_id % 10 = 0
         union all select event_id, ts, 2 from e where not early and event_id % 7 = 0
         union all select event_id, ts, 2 from e where early and event_id % 10 <> 0 and event_id % 7 = 1),
m as (select event_id, file = 2 and ts < (select b from w) as late from feed),
c as (select event_id, count(*) filter (late) as late, count(*) filter (not late) as timely from m group by 1)
select cast(event_id as varchar) as application_id, 'late' as status, late as n from c where late > 0
union all select cast(event_id as varchar), 'counted', 1 from c where timely > 0
union all select cast(event_id as varchar), 'repeated', timely - 1 from c where timely > 1
""".replace("\ne as", "\nwith e as", 1))
def q_stream_late_quarantine(spark, d):
    """The events feed in two files: the first third of the days but for every tenth event; then the rest, those
    left out, and events of both parts again. Every delivery is counted, late or a repeat."""
    ev = TB.event_predictions(spark, d).withColumn("_k", F.col("application_id").cast("bigint"))
    span = ev.agg(F.to_date(F.min("ts")).alias("low"), F.date_diff(F.max("ts"), F.min("ts")).alias("days")).first()
    early = F.col("ts") < F.date_add(F.lit(span["low"]), span["days"] // 3).cast("timestamp")
    held = F.col("_k") % 10 == 0
    path = scratch_path(spark, "late")
    second = (ev.filter(~early | held).unionByName(ev.filter(~early & (F.col("_k") % 7 == 0)))
              .unionByName(ev.filter(early & ~held & (F.col("_k") % 7 == 1))))
    schema = ev.drop("_k").schema
    for part in (ev.filter(early & ~held), second):
        part.drop("_k").coalesce(1).write.mode("append").parquet(f"{path}/feed")
    stream = file_stream(spark, f"{path}/feed", schema, max_files_per_trigger=1)
    out = quarantine_late(stream, f"{path}/out", f"{path}/checkpoint")
    one = F.lit(1).cast("bigint").alias("n")
    late = out["late"].groupBy("application_id").agg(F.count(F.lit(1)).alias("n"))
    return (out["rows"].select("application_id", F.lit("counted").alias("status"), one)
            .unionByName(late.select("application_id", F.lit("late").alias("status"), "n"))
            .unionByName(out["repeats"].groupBy("application_id").agg(F.sum("n").alias("n"))
                         .select("application_id", F.lit("repeated").alias("status"), "n")))


@register("batch_file_scoring", with_base(f"""
select count(*) as n_rows, count(*) filter (where p_default >= 0.13e0) as n_reject,
       {R('100.0e0 * avg(case when p_default >= 0.13e0 then 1e0 else 0e0 end)')} as reject_pct from test_scored"""))
def q_batch_file_scoring(spark, d):
    """The batch path over files by suffix with the frozen scorecard: CSV in, scored Parquet out, read back."""
    path = scratch_path(spark, "batch")
    loans = TB.cleaned2(spark, d).filter(F.col("issue_year") >= TB.TEST_MIN)
    batch = loans.select("application_id", *[c for c in CLEAN_FEATURES_V2 if c not in INTERACTION_COLS])
    write_any(batch, f"{path}/in.csv")
    scored = score_batch(read_any(spark, f"{path}/in.csv", schema=batch.schema), FROZEN_SCORECARD, threshold=0.13)
    write_any(scored.select("application_id", "p_default", "decision"), f"{path}/out.parquet")
    return batch_summary(read_any(spark, f"{path}/out.parquet"))


@register("lr_coefficients", None)
def q_lr_coefficients(spark, d):
    """Coefficients of the logistic baseline by size, and the share of interactions in the top 15."""
    base = TB.cleaned2(spark, d).filter(F.col("issue_year") <= TB.BASE_MAX).select(*CLEAN_FEATURES_V2, "default")
    return coefficient_table(fit_lr(materialize(base), CLEAN_FEATURES_V2))
