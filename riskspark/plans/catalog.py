"""Registered queries: name -> (Spark plan builder, DuckDB oracle SQL or None).

Every query reads the driver tables at ``sf_dir`` through the loan view and
runs over whole tables. Spark plans use the library operators; the oracle SQL
states the same result independently (often brute force). Doubles are
rounded to 6 digits at the very end on both sides (``finish``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskspark.operators import contracts as C
from riskspark.operators import metrics as M
from riskspark.operators import monitor as MON
from riskspark.operators import profile as PR
from riskspark.operators.ordered import materialize, row_rank
from riskspark.operators.prepare import clean_checked, curate_counts, recent_years, time_split
from riskspark.operators.scoring import FROZEN_SCORECARD
from riskspark.functions.bands import risk_band
from riskspark.functions.exact import grid_mean
from riskspark.plans import tables as TB
from riskspark.plans.sqlbase import dbl, linspace, quantile_ctes, unpivot, with_base
from riskspark.schema import (
    APPLICATION_FIELDS, CATEGORICAL_COLS, CLEAN_FEATURES_V1, CONTRACT_REQUIRED,
    ENUM_RULES, FEATURE_LABELS, INTERACTION_COLS, NUMERIC_FEATURES_V2,
    NUMERIC_RULES, TEXT_RULES, raw_schema,
)

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, tuple[QueryFn, str | None]] = {}


def round6(x):
    """floor(x * 1e6 + 0.5) / 1e6: the same IEEE operations in both engines,
    so equal inputs round equally (built-in round() differs at ties)."""
    return F.when(F.abs(x) < 1e12, F.floor(x * 1e6 + 0.5).cast("double") / 1e6).otherwise(x)


def finish(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round double columns at the end (engines differ in the last bits)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DoubleType):
            cols.append(round6(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def register(name: str, sql: str | None):
    def deco(fn):
        REGISTRY[name] = (lambda spark, d, _fn=fn: finish(_fn(spark, d)), sql)
        return fn
    return deco


P_DEC = FROZEN_SCORECARD.round_digits


def GM(p: str) -> str:
    """Exact mean of a 4-decimal score (integer sum), as in ``grid_mean``."""
    return f"(cast(sum(cast(round({p} * 1e4) as bigint)) as double) / (count({p}) * 1e4))"


def GB(p: str, y: str) -> str:
    """Exact Brier score of a 4-decimal score, as in ``grid_sq_error_mean``."""
    d = f"(cast(round({p} * 1e4) as bigint) - cast({y} * 1e4 as bigint))"
    return f"(cast(sum({d} * {d}) as double) / (count(*) * 1e8))"


def R(x: str) -> str:
    return f"(case when abs({x}) < 1e12 then floor(({x}) * 1e6 + 0.5) / 1e6 else ({x}) end)"


# ---------------------------------------------------------------- profiling --

@register("default_rate_by_grade", with_base(
    f'select grade, count(*) as n, {R("avg(\"default\")")} as default_rate from curated group by grade'))
def q_default_rate_by_grade(spark, d):
    return PR.rate_by(TB.curated(spark, d), "grade")


@register("default_rate_by_year", with_base(
    f'select issue_year, count(*) as n, {R("avg(\"default\")")} as default_rate from curated group by issue_year'))
def q_default_rate_by_year(spark, d):
    return PR.rate_by(TB.curated(spark, d), "issue_year")


@register("status_freq", with_base("select loan_status, count(*) as n from loans group by loan_status"))
def q_status_freq(spark, d):
    return PR.status_frequency(TB.raw(spark, d))


_RAW_TYPES = {f.name: f.dataType.simpleString() for f in raw_schema().fields}


def _miss_sql():
    parts = []
    for c, t in _RAW_TYPES.items():
        m = f"{c} is null" + (f" or isnan({c})" if t == "double" else "")
        parts.append(f"select '{c}' as column_name, avg(case when {m} then 1e0 else 0e0 end) * 100 as missing_pct from loans")
    return with_base(f"select column_name, {R('missing_pct')} as missing_pct from (\n  "
                     + "\n  union all ".join(parts) + ") m where missing_pct > 0")


@register("missing_pct", _miss_sql())
def q_missing_pct(spark, d):
    return PR.missing_share(TB.raw(spark, d))


@register("class_balance", with_base(f"""
select n, n_default, n_repaid, {R("n_default / n")} as default_rate,
       {R("case when n_default > 0 then n_repaid / n_default end")} as imbalance_ratio
from (select count(*) as n, count(*) filter (where "default" = 1) as n_default,
             count(*) filter (where "default" = 0) as n_repaid from curated) t"""))
def q_class_balance(spark, d):
    return PR.class_balance(TB.curated(spark, d))


def _fico_sql():
    from riskspark.schema import FICO_EDGES
    cases = " ".join(f"when fico_range_low > {a} and fico_range_low <= {b} then '({a}, {b}]'"
                     for a, b in zip(FICO_EDGES[:-1], FICO_EDGES[1:]))
    return with_base(f"""
select fico_bucket, count(*) as n, {R('avg("default")')} as default_rate
from (select *, case {cases} end as fico_bucket from curated) t
where fico_bucket is not null group by fico_bucket""")


@register("fico_bucket_rate", _fico_sql())
def q_fico_bucket_rate(spark, d):
    return PR.fico_bucket_rate(TB.curated(spark, d))


_DESCRIBE_COLS = NUMERIC_FEATURES_V2
_DESC_PROBS = [0.01, 0.25, 0.5, 0.75, 0.99]


def _describe_sql():
    lv = unpivot("cleaned2", _DESCRIBE_COLS)
    qn = ", ".join(f"{R(f'max(case when q.qi = {i} then q.quantile end)')} as p{int(round(p * 100)):02d}"
                   for i, p in enumerate(_DESC_PROBS))
    return with_base(f"""lv as (select * from ({lv}) u where value is not null and not isnan(value)),
{quantile_ctes('qq', 'lv', 'value', _DESC_PROBS, by=['column_name'])},
b as (select column_name, count(*) as count, avg(value) as mean, stddev_samp(value) as std,
             min(value) as min, max(value) as max from lv group by column_name),
w as (select column_name, {qn} from qq q group by column_name)
select b.column_name, b.count, {R('b.mean')} as mean, {R('b.std')} as std, {R('b.min')} as min,
       w.p01, w.p25, w.p50, w.p75, w.p99, {R('b.max')} as max
from b left join w using (column_name)""")


@register("numeric_describe", _describe_sql())
def q_numeric_describe(spark, d):
    return PR.describe(TB.cleaned2(spark, d), _DESCRIBE_COLS)


def _ew_bin_sql(src: str, x: str, lo: str, hi: str, n_bins: int, keep: str) -> str:
    """Equal-width bin with the same edge checks as the Spark expression."""
    step = f"((({hi}) - ({lo})) / {n_bins}e0)"
    edge = lambda i: f"(case when ({i}) = {n_bins} then ({hi}) else cast({i} as double) * {step} + ({lo}) end)"
    guess = f"cast(least(greatest(floor((({x}) - ({lo})) / {step}), 0), {n_bins - 1}) as int)"
    return f"""(select {keep}, case when ({hi}) > ({lo}) then up else 0 end as bin from (
  select *, case when dn < {n_bins - 1} and ({x}) >= {edge('dn + 1')} then dn + 1 else dn end as up from (
    select *, case when g > 0 and ({x}) < {edge('g')} then g - 1 else g end as dn from (
      select *, {guess} as g from {src}) a) b) c)"""


def _hist_sql():
    lv = unpivot("cleaned2", _DESCRIBE_COLS)
    binned = _ew_bin_sql("x", "xv", "lo", "hi", 50, "column_name")
    return with_base(f"""lv as (select * from ({lv}) u where value is not null and not isnan(value)),
{quantile_ctes('qq', 'lv', 'value', [0.01, 0.99], by=['column_name'])},
bd as (select column_name, min(quantile) as qlo, max(quantile) as qhi from qq group by column_name),
x as (select lv.column_name, least(greatest(lv.value, bd.qlo), bd.qhi) as xv,
             case when bd.qlo = bd.qhi then bd.qlo - 0.5 else bd.qlo end as lo,
             case when bd.qlo = bd.qhi then bd.qhi + 0.5 else bd.qhi end as hi
      from lv join bd using (column_name))
select column_name, bin, count(*) as n from {binned} t group by column_name, bin""")


@register("clipped_histogram", _hist_sql())
def q_clipped_histogram(spark, d):
    return PR.clipped_histogram(TB.cleaned2(spark, d), _DESCRIBE_COLS)


@register("interaction_stats", with_base(f"""lv as ({unpivot('cleaned2', INTERACTION_COLS, keep=['"default"'])})
select column_name, {R('avg(value)')} as mean, {R('stddev_samp(value)')} as std,
       {R('avg(case when value is null then 1e0 else 0e0 end) * 100')} as null_pct,
       {R('corr(value, cast("default" as double))')} as corr_default
from lv group by column_name"""))
def q_interaction_stats(spark, d):
    return PR.interaction_stats(TB.cleaned2(spark, d), INTERACTION_COLS)


# ------------------------------------------------------ cleaning and splits --

@register("curate_counts", with_base("""
select count(*) as n_raw, count("default") as n_labelled, count(*) - count("default") as n_dropped from labelled"""))
def q_curate_counts(spark, d):
    return curate_counts(TB.raw(spark, d))


@register("clean_loans", with_base("select * from cleaned"))
def q_clean_loans(spark, d):
    return clean_checked(TB.curated(spark, d))


@register("interactions", with_base(
    "select application_id, " + ", ".join(INTERACTION_COLS) + " from cleaned2"))
def q_interactions(spark, d):
    return TB.cleaned2(spark, d).select("application_id", *INTERACTION_COLS)


_SPLITS = [("train", "issue_year <= 1999"), ("test", "issue_year >= 2000"),
           ("base", "issue_year <= 1998"), ("calib", "issue_year = 1999")]


@register("split_summary", with_base("\nunion all ".join(
    f"""select '{n}' as split, count(*) as n, count(*) filter (where "default" = 1) as n_default,
       {R('avg("default")')} as default_rate, min(issue_year) as min_year, max(issue_year) as max_year
from cleaned where {w}""" for n, w in _SPLITS)))
def q_split_summary(spark, d):
    # one pass to a row per year, then the splits, which overlap, over the years
    y = F.col("issue_year")
    years = TB.cleaned(spark, d).groupBy(y).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("default") == 1).alias("n_default"))
    of = F.array_compact(F.array(F.when(y <= TB.TRAIN_MAX, "train"), F.when(y >= TB.TEST_MIN, "test"),
                                 F.when(y <= TB.BASE_MAX, "base"), F.when(y == TB.CALIB, "calib")))
    return (years.select("*", F.explode(of).alias("split")).groupBy("split")
            .agg(F.sum("n").alias("n"), F.sum("n_default").alias("n_default"),
                 (F.sum("n_default") / F.sum("n")).alias("default_rate"),
                 F.min(y).alias("min_year"), F.max(y).alias("max_year")))


_REQ_NOT_NULL = ["loan_amnt", "term", "int_rate", "installment", "grade", "annual_inc", "fico_mean", "default", "issue_year"]


@register("split_checks", with_base(f"""
select count(*) as n_total,
       count(*) filter (where issue_year <= 1999) as n_train,
       count(*) filter (where issue_year >= 2000) as n_test,
       count(*) filter (where issue_year is null) as n_no_year,
       count(*) filter (where issue_year <= 1999 and issue_year >= 2000) as n_overlap,
       count(*) filter (where {' or '.join(f'"{c}" is null' for c in _REQ_NOT_NULL)}) as n_required_null,
       count(*) filter (where credit_history_years < 0) as n_negative_history
from cleaned"""))
def q_split_checks(spark, d):
    cl = TB.cleaned(spark, d)
    y = F.col("issue_year")
    req = None
    for c in _REQ_NOT_NULL:
        req = F.col(c).isNull() if req is None else (req | F.col(c).isNull())
    return cl.agg(F.count(F.lit(1)).alias("n_total"), F.count_if(y <= TB.TRAIN_MAX).alias("n_train"),
                  F.count_if(y >= TB.TEST_MIN).alias("n_test"), F.count_if(y.isNull()).alias("n_no_year"),
                  F.count_if((y <= TB.TRAIN_MAX) & (y >= TB.TEST_MIN)).alias("n_overlap"),
                  F.count_if(req).alias("n_required_null"),
                  F.count_if(F.col("credit_history_years") < 0).alias("n_negative_history"))


@register("recent_window", with_base("""
select issue_year, count(*) as n from cleaned, (select max(issue_year) as top from cleaned) m
where issue_year between top - 1 and top group by issue_year"""))
def q_recent_window(spark, d):
    return PR.year_distribution(recent_years(TB.cleaned(spark, d), years=2))


@register("new_levels", with_base(f"""
select column_name, level from ({unpivot('cleaned', CATEGORICAL_COLS, value_type='varchar', value='level')}) te
where issue_year >= 2000
except
select column_name, level from ({unpivot('cleaned', CATEGORICAL_COLS, value_type='varchar', value='level')}) tr
where issue_year <= 1999""".replace("select '", "select issue_year, '")))
def q_new_levels(spark, d):
    train, test = time_split(TB.cleaned(spark, d), TB.TRAIN_MAX, TB.TEST_MIN)
    return PR.new_levels(train, test, CATEGORICAL_COLS)


# ------------------------------------------------------------- contracts --

def _contract_sql():
    parts = []
    for c in CONTRACT_REQUIRED:
        inv = 'count(*) filter (where "default" is not null and "default" not in (0, 1))' if c == "default" else "0"
        parts.append(f"""select '{c}' as column_name, count(*) as n_rows, count(*) - count("{c}") as n_null,
       count("{c}") = 0 as all_null, cast({inv} as bigint) as n_invalid from curated""")
    return with_base("\nunion all ".join(parts))


@register("contract_counts", _contract_sql())
def q_contract_counts(spark, d):
    return C.contract_profile(TB.curated(spark, d))


def _violation_rules() -> list[tuple[str, str]]:
    """(violation, SQL condition) of every row rule, in the order of the rules."""
    parts = []
    for c, lo, lo_inc, hi, hi_inc, nullable in NUMERIC_RULES:
        x = f"cast({c} as double)"
        broken = f"isnan({x}) or {x} {'<' if lo_inc else '<='} {lo} or {x} {'>' if hi_inc else '>='} {hi}"
        if not nullable:
            broken = f"{c} is null or {broken}"
        parts.append((f"{c}:out_of_range", f"coalesce({broken}, false)"))
    for c, lo, hi, nullable in TEXT_RULES:
        broken = f"length({c}) < {lo} or length({c}) > {hi}"
        if not nullable:
            broken = f"{c} is null or {broken}"
        parts.append((f"{c}:bad_length", f"coalesce({broken}, false)"))
    for c, allowed, nullable in ENUM_RULES:
        broken = f"{c} not in ({', '.join(map(str, allowed))})"
        if not nullable:
            broken = f"{c} is null or {broken}"
        parts.append((f"{c}:not_allowed", f"coalesce({broken}, false)"))
    return parts


def _violation_body():
    return "\nunion all ".join(f"select application_id, '{v}' as violation from cleaned where {broken}"
                               for v, broken in _violation_rules())


def _violation_sql():
    return with_base(_violation_body())


@register("row_violations", _violation_sql())
def q_row_violations(spark, d):
    apps = TB.cleaned(spark, d).select(*APPLICATION_FIELDS)
    # explode emits nothing for an empty array: only quarantined rows remain
    return C.with_violations(apps).select("application_id", F.explode("violations").alias("violation"))


@register("quarantine_summary", with_base(f"""
v as ({_violation_body()})
select count(*) as n_rows,
       count(*) filter (where application_id not in (select application_id from v)) as n_valid,
       count(*) filter (where application_id in (select application_id from v)) as n_quarantined
from cleaned"""))
def q_quarantine_summary(spark, d):
    v = C.with_violations(TB.cleaned(spark, d).select(*APPLICATION_FIELDS))
    return v.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.size("violations") == 0).alias("n_valid"),
                 F.count_if(F.size("violations") > 0).alias("n_quarantined"))


# --------------------------------------------------------------- scoring --

@register("scored_loans", with_base(
    "select application_id, p_default, case when p_default >= 0.13e0 then 'reject' else 'approve' end as decision from scored"))
def q_scored_loans(spark, d):
    from riskspark.operators.scoring import score_batch
    s = score_batch(TB.cleaned(spark, d), FROZEN_SCORECARD, threshold=0.13)
    return s.select("application_id", "p_default", "decision")


@register("batch_summary", with_base(f"""
select count(*) as n_rows, count(*) filter (where p_default >= 0.13e0) as n_reject,
       {R('100.0e0 * avg(case when p_default >= 0.13e0 then 1e0 else 0e0 end)')} as reject_pct from scored"""))
def q_batch_summary(spark, d):
    from riskspark.operators.scoring import score_batch
    return MON.batch_summary(score_batch(TB.cleaned(spark, d), FROZEN_SCORECARD, threshold=0.13))


@register("risk_bands", with_base(f"""
select case when p_default < 0.10e0 then 'Low risk' when p_default < 0.25e0 then 'Moderate risk'
            when p_default < 0.50e0 then 'Elevated risk' else 'High risk' end as risk_band,
       count(*) as n, {R(GM('p_default'))} as mean_p_default
from scored group by 1"""))
def q_risk_bands(spark, d):
    return (TB.scored(spark, d).groupBy(risk_band("p_default").alias("risk_band"))
            .agg(F.count(F.lit(1)).alias("n"), grid_mean("p_default", P_DEC).alias("mean_p_default")))


@register("grade_gap", with_base(f"""
gr as (select grade, avg("default") as grade_rate from train_scored group by grade),
pop as (select avg("default") as pop_rate from train_scored),
j as (select t.application_id, t.grade, t.p_default, coalesce(gr.grade_rate, pop.pop_rate) as grade_rate, pop.pop_rate
      from test_scored t left join gr using (grade) cross join pop)
select application_id, grade, p_default, {R('grade_rate')} as grade_rate,
       {R('p_default - grade_rate')} as delta_vs_grade, {R('p_default - pop_rate')} as delta_vs_population,
       case when abs(p_default - grade_rate) < 0.03e0 then 'agree'
            when p_default - grade_rate > 0 then 'pessimistic' else 'optimistic' end as verdict
from j"""))
def q_grade_gap(spark, d):
    S = TB.scored_table(spark, d, "application_id", "issue_year", "grade", "default", "p_default")
    from riskspark.operators.explain import grade_gap
    return grade_gap(TB.test_scored(spark, d, S), TB.train_scored(spark, d, S))


# --------------------------------------------------------------- metrics --

_RANK_SQL = """g as (select p_default as s, sum("default")::double as pos, sum(1 - "default")::double as neg
      from {src} where "default" is not null and p_default is not null group by p_default),
c as (select s, pos, neg,
             sum(pos) over (order by s rows between unbounded preceding and current row) as cp,
             sum(neg) over (order by s rows between unbounded preceding and current row) as cn,
             sum(pos) over () as P, sum(neg) over () as N from g)"""

_EPS = "2.220446049250313e-16"


@register("metric_row", with_base(f"""{_RANK_SQL.format(src='test_scored')},
r as (select sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N)) as roc_auc,
             sum(case when pos > 0 then pos * ((P - cp + pos) / ((P - cp + pos) + (N - cn + neg))) end) / max(P) as pr_auc,
             max(abs(cp / P - cn / N)) as ks from c),
pm as (select {GB('p_default', '"default"')} as brier,
              avg(-("default" * ln(least(greatest(p_default, {_EPS}), 1 - {_EPS}))
                    + (1 - "default") * ln(1 - least(greatest(p_default, {_EPS}), 1 - {_EPS})))) as log_loss
       from test_scored)
select {R('roc_auc')} as roc_auc, {R('pr_auc')} as pr_auc, {R('brier')} as brier, {R('log_loss')} as log_loss,
       {R('ks')} as ks from r cross join pm"""))
def q_metric_row(spark, d):
    return M.metric_row(TB.test_table(spark, d, "default", "p_default"), p_decimals=P_DEC, checkpoint=False)


@register("metrics_by_group", with_base(f"""
g as (select grade, p_default as s, sum("default")::double as pos, sum(1 - "default")::double as neg
      from test_scored group by grade, p_default),
c as (select grade, s, pos, neg,
             sum(pos) over (partition by grade order by s rows between unbounded preceding and current row) as cp,
             sum(neg) over (partition by grade order by s rows between unbounded preceding and current row) as cn,
             sum(pos) over (partition by grade) as P, sum(neg) over (partition by grade) as N from g),
r as (select grade, sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N)) as roc_auc,
             max(abs(cp / P - cn / N)) as ks, max(P) + max(N) as n, max(P) / (max(P) + max(N)) as default_rate
      from c group by grade)
select grade, cast(n as bigint) as n, {R('default_rate')} as default_rate, {R('roc_auc')} as roc_auc, {R('ks')} as ks
from r where n >= 100 and (select count(distinct "default") from test_scored t where t.grade = r.grade) = 2"""))
def q_metrics_by_group(spark, d):
    return M.metrics_by_group(TB.test_table(spark, d, "grade", "default", "p_default"), checkpoint=False)


@register("roc_points", with_base(f"""{_RANK_SQL.format(src='test_scored')}
select s as threshold, cast(P - cp + pos as bigint) as tp, cast(N - cn + neg as bigint) as fp,
       {R('(P - cp + pos) / P')} as tpr, {R('(N - cn + neg) / N')} as fpr,
       {R('(P - cp + pos) / ((P - cp + pos) + (N - cn + neg))')} as precision, {R('(P - cp + pos) / P')} as recall
from c"""))
def q_roc_points(spark, d):
    return M.roc_points(TB.test_table(spark, d, "default", "p_default"), checkpoint=False)


@register("confusion_matrix", with_base(f"""
select count(*) filter (where p_default >= 0.13e0 and "default" = 1) as tp,
       count(*) filter (where p_default >= 0.13e0 and "default" = 0) as fp,
       count(*) filter (where p_default < 0.13e0 and "default" = 0) as tn,
       count(*) filter (where p_default < 0.13e0 and "default" = 1) as fn,
       {R('avg(case when p_default >= 0.13e0 then 1e0 else 0e0 end)')} as predicted_rate
from test_scored"""))
def q_confusion_matrix(spark, d):
    return M.confusion_matrix(TB.test_scored(spark, d), threshold=0.13)


def _cost_sql(weight: str, tail: str = "") -> str:
    return with_base(f"""
grid as (select i, case when i = 98 then 0.99e0 else cast(i as double) * ((0.99e0 - 0.01e0) / 98) + 0.01e0 end as threshold
         from range(99) t(i)),
x as (select "default" as y, p_default as s, {weight} as w from test_scored),
tot as (select sum(case when y = 1 then w else 0e0 end) as P from x),
cc as (select g.threshold,
              sum(case when x.s < g.threshold and x.y = 1 then x.w else 0e0 end) as fn,
              sum(case when x.s >= g.threshold and x.y = 0 then x.w else 0e0 end) as fp,
              sum(case when x.s >= g.threshold and x.y = 1 then x.w else 0e0 end) as tp
       from grid g cross join x group by g.threshold),
curve as (select threshold, fn, fp, 5e0 * fn + 1e0 * fp as cost,
                 case when tp + fp > 0 then tp / (tp + fp) else 0e0 end as precision,
                 case when P > 0 then tp / P else 0e0 end as recall from cc cross join tot)
select {R('threshold')} as threshold, {R('fn')} as fn, {R('fp')} as fp, {R('cost')} as cost,
       {R('precision')} as precision, {R('recall')} as recall from curve {tail}""")


def _curve(spark, d, weight=None):
    return M.cost_curve(TB.test_scored(spark, d), weight=weight)    # one aggregation pass


@register("cost_curve", _cost_sql("1e0"))
def q_cost_curve(spark, d):
    return _curve(spark, d)


@register("cost_curve_weighted", _cost_sql("loan_amnt"))
def q_cost_curve_weighted(spark, d):
    return _curve(spark, d, "loan_amnt")


@register("optimal_threshold", _cost_sql("1e0", "order by cost, threshold limit 1"))
def q_optimal_threshold(spark, d):
    return M.optimal_threshold(_curve(spark, d))


@register("naive_threshold_cost", _cost_sql("1e0", "order by abs(threshold - 0.5e0), threshold limit 1"))
def q_naive_threshold_cost(spark, d):
    return M.nearest_threshold(_curve(spark, d), 0.5)


_PSI_PROBS = linspace(0, 1, 11)[1:-1]


def _psi_sql(expected: str, actual: str, value: str = "p_default", final: str | None = None) -> str:
    bins = " + ".join(f"case when v >= (select quantile from qe where qi = {i}) then 1 else 0 end"
                      for i in range(len(_PSI_PROBS)))
    return f"""{quantile_ctes('qe', expected, value, _PSI_PROBS)},
ev as (select cast({value} as double) as v from {expected} where {value} is not null),
av as (select cast({value} as double) as v from {actual} where {value} is not null),
eb as (select {bins} as bin, count(*) as n from ev group by 1),
ab as (select {bins} as bin, count(*) as n from av group by 1),
bins as (select i as bin from range(10) t(i)),
sh as (select b.bin, greatest(coalesce(eb.n, 0) / (select count(*) from ev), 1e-6) as e,
              greatest(coalesce(ab.n, 0) / (select count(*) from av), 1e-6) as a
       from bins b left join eb using (bin) left join ab using (bin)),
psi as (select sum((a - e) * ln(a / e)) as psi from sh)"""


@register("psi", with_base(_psi_sql("train_scored", "test_scored") + f"\nselect {R('psi')} as psi from psi"))
def q_psi(spark, d):
    S = TB.scored_table(spark, d, "issue_year", "p_default")
    return M.psi(TB.train_scored(spark, d, S), "p_default", TB.test_scored(spark, d, S), "p_default", checkpoint=False)


def _decile_sql(rk: str, n: str) -> str:
    return "1 + " + " + ".join(f"case when cast({rk} as double) > cast({n} - 1 as double) * {dbl(q)} then 1 else 0 end"
                               for q in linspace(0, 1, 11)[1:-1])


@register("gains_table", with_base(f"""
r as (select "default" as y, p_default as s,
             row_number() over (order by p_default desc, loan_id asc) - 1 as rk, count(*) over () as n
      from test_scored),
d as (select *, {_decile_sql('rk', 'n')} as decile from r),
g as (select decile, count(*) as n, sum(y) as n_defaults, avg(y) as default_rate, min(s) as score_min, max(s) as score_max
      from d group by decile),
t as (select avg(y) as rate, sum(y) as D from r)
select cast(decile as int) as decile, cast(n as bigint) as n, cast(n_defaults as bigint) as n_defaults,
       {R('default_rate')} as default_rate, {R('score_min')} as score_min, {R('score_max')} as score_max,
       {R('default_rate / (D / (select count(*) from r))')} as lift,
       cast(sum(n_defaults) over (order by decile) as bigint) as cum_defaults,
       {R('sum(n_defaults) over (order by decile) / D')} as cum_capture_rate
from g cross join t"""))
def q_gains_table(spark, d):
    return M.gains_table(TB.test_table(spark, d, "loan_id", "default", "p_default"), id_col="loan_id", checkpoint=False)


_REL_PROBS = [float(q) for q in (__import__("numpy").linspace(0, 1, 21) * 100) / 100][1:-1]


@register("reliability_table", with_base(f"""{quantile_ctes('qr', 'test_scored', 'p_default', _REL_PROBS)},
b as (select p_default, "default" as y,
             {' + '.join(f'case when p_default > (select quantile from qr where qi = {i}) then 1 else 0 end' for i in range(len(_REL_PROBS)))} as bin
      from test_scored)
select bin, count(*) as n, {R(GM('p_default'))} as mean_predicted, {R('avg(y)')} as fraction_observed
from b group by bin"""))
def q_reliability_table(spark, d):
    return M.reliability_table(TB.test_table(spark, d, "default", "p_default"), p_decimals=P_DEC, checkpoint=False)


def _score_hist_sql():
    binned = _ew_bin_sql("x", "xv", "lo", "hi", 50, "cls, xv, lo, hi, t")
    return with_base(f"""
x as (select s."default" as cls, cast(s.p_default as double) as xv, r.lo, r.hi, r.t
      from test_scored s join (select "default" as cls, min(p_default) as lo, max(p_default) as hi, count(*) as t
                               from test_scored group by 1) r on r.cls = s."default")
select cls, bin, count(*) as n,
       {R('count(*) / (max(t) * case when max(hi) > max(lo) then (max(hi) - max(lo)) / 50 else 1e0 end)')} as density
from {binned} b group by cls, bin""")


@register("score_histogram", _score_hist_sql())
def q_score_histogram(spark, d):
    return M.score_histogram(TB.test_table(spark, d, "default", "p_default"), "p_default", "default")


# ------------------------------------------------------------- models ------

# isotonic regression by its min-max formula: the fitted value at every score of the calibration year
ISOTONIC_CTES = """
g as (select p_default as x, sum("default")::double as sy, count(*)::double as w
      from scored where issue_year = 1999 group by p_default),
o as (select x, sy, w, row_number() over (order by x) as i,
             sum(sy) over (order by x rows between unbounded preceding and current row) as cs,
             sum(w) over (order by x rows between unbounded preceding and current row) as cw from g),
pr as (select a.i as j, b.i as k, (b.cs - a.cs + a.sy) / (b.cw - a.cw + a.w) as av from o a join o b on a.i <= b.i),
sm as (select j, k, min(av) over (partition by j order by k desc rows between unbounded preceding and current row) as m from pr),
f as (select k as i, max(m) as fit from sm group by k)"""


@register("isotonic_fit", with_base(f"""{ISOTONIC_CTES}
select o.x as score, {R('f.fit')} as p_calibrated from f join o using (i)"""))
def q_isotonic_fit(spark, d):
    from riskspark.operators.calibration import fit_isotonic
    calib = TB.scored(spark, d).filter(F.col("issue_year") == TB.CALIB)
    iso = fit_isotonic(calib, "p_default", "default")
    pts = calib.select(F.col("p_default").alias("score")).distinct()
    return iso.transform(pts.withColumn("p_default", F.col("score"))).select("score", F.col("p_calibrated"))


@register("time_folds", with_base("""
r as (select application_id, row_number() over (order by issue_year, loan_id) - 1 as pos, count(*) over () as n
      from train_scored),
f as (select *, n // 3 as ts from r)
select application_id, pos,
       case when pos >= n - 2 * ts and pos < n - ts then 0 when pos >= n - ts then 1 end as test_fold
from f"""))
def q_time_folds(spark, d):
    from riskspark.operators.tuning import time_series_folds
    train = TB.train_table(spark, d, "application_id", "loan_id", "issue_year")
    return time_series_folds(train, n_splits=2, order=("issue_year", "loan_id"), checkpoint=False) \
        .select("application_id", "pos", "test_fold")


@register("class_weights", with_base(f"""
c as (select "default" as label, count(*) as n from cleaned where issue_year <= 1998 group by 1),
t as (select sum(n) as total, sum(n) filter (where label = 0) as n_neg, sum(n) filter (where label = 1) as n_pos from c)
select label, n, {R('total / (2 * n)')} as balanced_weight, {R('n_neg / greatest(n_pos, 1)')} as scale_pos_weight
from c cross join t"""))
def q_class_weights(spark, d):
    from riskspark.operators.models import class_weight_table
    base = TB.cleaned(spark, d).filter(F.col("issue_year") <= TB.BASE_MAX)
    return class_weight_table(base, "default")


def _reason_sql():
    feats = [(t.feature, t.coef, t.center, t.fill) for t in FROZEN_SCORECARD.terms]
    fill = lambda f, fl: f"coalesce(cast({f} as double), {fl}e0)" if fl is not None else f"cast({f} as double)"
    means = ", ".join(f"avg({fill(f, fl)}) as m_{f}" for f, _, _, fl in feats)
    parts = []
    for pos, (f, coef, _, fl) in enumerate(feats):
        lab = FEATURE_LABELS.get(f, f).replace("'", "''")
        parts.append(f"""select application_id, {pos} as pos, '{f}' as feature, '{lab}' as label,
       cast({f} as double) as value, {dbl(coef)} * ({fill(f, fl)} - m_{f}) as contribution
from test_scored cross join mu""")
    return with_base(f"""mu as (select {means} from train_scored),
u as ({' union all '.join(parts)}),
r as (select *, row_number() over (partition by application_id order by contribution desc, pos asc) as rank
      from u where contribution > 0)
select application_id, cast(rank as int) as rank, feature, label, {R('value')} as value, {R('contribution')} as contribution
from r where rank <= 5""")


@register("linear_reason_codes", _reason_sql())
def q_linear_reason_codes(spark, d):
    S = TB.scored_table(spark, d, "application_id", "issue_year", *FROZEN_SCORECARD.features)
    from riskspark.operators.explain import linear_reason_codes, scorecard_contributions
    test = TB.test_scored(spark, d, S)
    contrib = scorecard_contributions(FROZEN_SCORECARD, test, TB.train_scored(spark, d, S))
    rc = linear_reason_codes(contrib, top_n=5, positive_only=True)
    return rc.select("application_id", F.posexplode("reasons").alias("rank", "r")) \
        .select("application_id", (F.col("rank") + 1).cast("int").alias("rank"), "r.feature", "r.label",
                F.col("r.value").cast("double").alias("value"), "r.contribution")


# ------------------------------------------------------------ monitoring ---

@register("outcome_join", with_base("""
select p.ts, p.application_id, p.p_default, p.decision, o.actual
from predlog p join outcomes o on o.application_id = p.application_id where p.application_id is not null"""))
def q_outcome_join(spark, d):
    j = MON.join_outcomes(TB.prediction_log(spark, d), TB.outcomes(spark, d))
    return j.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), "application_id", "p_default",
                    "decision", "actual")


@register("unlabeled", with_base("""
select (select count(*) from predlog) as n_predictions,
       (select count(*) from predlog p where application_id in (select application_id from outcomes)) as n_labelled,
       (select count(*) from predlog p where application_id is null
            or application_id not in (select application_id from outcomes)) as n_unlabeled"""))
def q_unlabeled(spark, d):
    return MON.unlabeled_counts(TB.prediction_log(spark, d), TB.outcomes(spark, d))


@register("daily_monitor", with_base(f"""
select strftime(cast(ts_raw as date), '%Y-%m-%d') as date, count(*) as n, {R(GM('p_default'))} as mean_p_default,
       {R("avg(case when decision = 'reject' then 1e0 else 0e0 end)")} as reject_rate
from predlog group by 1"""))
def q_daily_monitor(spark, d):
    t = MON.daily_table(TB.prediction_log(spark, d), p_decimals=P_DEC)
    return t.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("events_daily_monitor", f"""
select strftime(cast(ts as date), '%Y-%m-%d') as date, count(*) as n,
       {R('avg(least(value / 500e0, 1e0))')} as mean_p_default,
       {R('avg(case when least(value / 500e0, 1e0) >= 0.13e0 then 1e0 else 0e0 end)')} as reject_rate
from events group by 1""")
def q_events_daily_monitor(spark, d):
    t = MON.daily_table(TB.event_predictions(spark, d))
    return t.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


@register("monitor_headline", with_base(_psi_sql("train_scored", "prod", final=None).replace(
    "qe_r as (", "prod as (select * from predlog where ts_raw >= timestamp '2000-01-01'),\nqe_r as (", 1) + f"""
select (select count(*) from prod) as n_predictions,
       (select strftime(min(ts_raw), '%Y-%m-%d %H:%M:%S') from prod) as window_start,
       (select strftime(max(ts_raw), '%Y-%m-%d %H:%M:%S') from prod) as window_end,
       case when (select count(*) from prod) >= 1000 then {R('psi')} end as psi,
       case when (select count(*) from prod) < 1000 then 'INSUFFICIENT_DATA' when psi >= 0.25 then 'SIGNIFICANT'
            when psi >= 0.10 then 'MODERATE' else 'STABLE' end as psi_band,
       (select {R(GM('p_default'))} from prod) as mean_p_default_prod,
       (select {R(GM('p_default'))} from train_scored) as mean_p_default_train_ref,
       (select {R("avg(case when decision = 'reject' then 1e0 else 0e0 end)")} from prod) as reject_rate
from psi"""))
def q_monitor_headline(spark, d):
    prod = materialize(TB.prediction_log(spark, d).filter(F.col("ts") >= F.lit(TB.PROD_START).cast("timestamp")))
    h = MON.headline(prod, TB.train_table(spark, d, "p_default"), p_decimals=P_DEC, checkpoint=False)
    return h.withColumns({"window_start": F.date_format("window_start", "yyyy-MM-dd HH:mm:ss"),
                          "window_end": F.date_format("window_end", "yyyy-MM-dd HH:mm:ss")})


@register("realized_monthly", with_base(f"""
j as (select strftime(p.ts_raw, '%Y-%m') as month, p.p_default, o.actual as y
      from predlog p join outcomes o on o.application_id = p.application_id),
g as (select month, p_default as s, sum(y)::double as pos, sum(1 - y)::double as neg from j group by month, p_default),
c as (select month, s, pos, neg,
             sum(pos) over (partition by month order by s rows between unbounded preceding and current row) as cp,
             sum(neg) over (partition by month order by s rows between unbounded preceding and current row) as cn,
             sum(pos) over (partition by month) as P, sum(neg) over (partition by month) as N from g),
rk as (select month, case when max(P) > 0 and max(N) > 0 then sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N)) end as roc_auc,
              case when max(P) > 0 and max(N) > 0 then max(abs(cp / P - cn / N)) end as ks from c group by month),
pm as (select month, count(*) as n, avg(y) as actual_default_rate, {GM('p_default')} as mean_p_default,
              {GB('p_default', 'y')} as brier,
              avg(-(y * ln(least(greatest(p_default, {_EPS}), 1 - {_EPS}))
                    + (1 - y) * ln(1 - least(greatest(p_default, {_EPS}), 1 - {_EPS})))) as ll from j group by month)
select pm.month, pm.n, {R('actual_default_rate')} as actual_default_rate, {R('mean_p_default')} as mean_p_default,
       {R('brier')} as brier, {R('rk.roc_auc')} as roc_auc, {R('rk.ks')} as ks,
       case when rk.roc_auc is not null then {R('ll')} end as log_loss
from pm left join rk using (month)"""))
def q_realized_monthly(spark, d):
    j = materialize(MON.join_outcomes(TB.prediction_log(spark, d), TB.outcomes(spark, d)))
    return MON.realized_monthly(j, p_decimals=P_DEC, checkpoint=False)


@register("realized_overall", with_base(f"""
j as (select p.p_default, o.actual as y from predlog p join outcomes o on o.application_id = p.application_id),
jj as (select p_default, y as "default" from j),
{_RANK_SQL.format(src='jj')},
rk as (select sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N)) as roc_auc, max(abs(cp / P - cn / N)) as ks from c),
pm as (select count(*) as n, avg(y) as actual_default_rate, {GM('p_default')} as mean_p_default,
              {GB('p_default', 'y')} as brier,
              avg(-(y * ln(least(greatest(p_default, {_EPS}), 1 - {_EPS}))
                    + (1 - y) * ln(1 - least(greatest(p_default, {_EPS}), 1 - {_EPS})))) as log_loss from j)
select n, {R('actual_default_rate')} as actual_default_rate, {R('mean_p_default')} as mean_p_default,
       {R('brier')} as brier, {R('roc_auc')} as roc_auc, {R('ks')} as ks, {R('log_loss')} as log_loss
from pm cross join rk"""))
def q_realized_overall(spark, d):
    j = materialize(MON.join_outcomes(TB.prediction_log(spark, d), TB.outcomes(spark, d)))
    return MON.realized_metrics(j, p_decimals=P_DEC, checkpoint=False)


@register("calibration_summary", with_base(f"""
select count(*) as n, {R(GM('p_default'))} as mean_pred, {R('avg("default")')} as observed,
       {R(GM('p_default') + ' - avg("default")')} as gap, {R(GB('p_default', '"default"'))} as brier
from test_scored"""))
def q_calibration_summary(spark, d):
    return MON.calibration_summary(TB.test_scored(spark, d), p_decimals=P_DEC)


def queries() -> dict[str, QueryFn]:
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
