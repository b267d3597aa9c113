"""Queries of round trips, batch inputs, censuses and comparisons, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskspark.operators import metrics as M
from riskspark.operators import profile as PR
from riskspark.operators.prepare import numeric_cols, split_xy, write_cleaned
from riskspark.operators.scoring import FROZEN_SCORECARD, align_columns, categorical_levels, score_batch
from riskspark.operators.tuning import best_and_worst, exact_sample, random_search, sample_trials
from riskspark.plans import tables as TB
from riskspark.plans.catalog import GM, R, _decile_sql, _ew_bin_sql, register
from riskspark.plans.extra import _scratch
from riskspark.plans.sqlbase import unpivot, with_base
from riskspark.schema import CATEGORICAL_COLS, CLEAN_FEATURES_V1, CLEAN_FEATURES_V2, NUMERIC_FEATURES_V2, RANDOM_STATE, SEARCH_SPACE
from riskspark.session import scratch_path
from riskspark.sources.files import load_curated, scan_predictions, to_log_records

# ------------------------------------------------------------ round trips --


@register("cleaned_tables_roundtrip", with_base("\nunion all ".join(f"""
select '{v}' as version, issue_year, count(*) as n, sum("default") as n_default, {R('sum(installment)')} as installments,
       count({extra}) as n_extra
from {src} group by issue_year""" for v, src, extra in (("v1", "cleaned", "dti"), ("v2", "cleaned2", "loan_to_income")))))
def q_cleaned_tables_roundtrip(spark, d):
    """Cleaned v1 and v2 written partitioned by issue_year and read back."""
    out = None
    for version, df, extra in (("v1", TB.cleaned(spark, d), "dti"), ("v2", TB.cleaned2(spark, d), "loan_to_income")):
        path = _scratch(spark, f"cleaned-{version}")
        write_cleaned(df, path)
        part = load_curated(spark, path).groupBy("issue_year").agg(
            F.count(F.lit(1)).alias("n"), F.sum("default").alias("n_default"), F.sum("installment").alias("installments"),
            F.count(extra).alias("n_extra")).withColumn("version", F.lit(version))
        out = part if out is None else out.unionByName(part)
    return out


def _written_log(spark, d):
    """The prediction log as JSON lines, of which those of two ids in fifty are
    broken: cut off, or with a text as probability."""
    recs = to_log_records(TB.prediction_log(spark, d), 0.13, FROZEN_SCORECARD.name, ts="ts")
    line = F.to_json(F.struct(*recs.columns))
    kind = F.col("application_id").cast("bigint") % 50
    text = (F.when(kind == 0, F.substring(line, 1, 20))
            .when(kind == 1, F.regexp_replace(line, '"p_default":[0-9.Ee-]+', '"p_default":"oops"')).otherwise(line))
    path = _scratch(spark, "log")
    recs.select(text.alias("value")).write.text(path)
    return path


@register("prediction_log_scan", with_base(f"""
logged as (select *, cast(application_id as bigint) % 50 <= 1 as broken from predlog)
select count(*) filter (where not broken) as n_records, count(*) filter (where broken) as n_rejected,
       count(*) filter (where not broken and ts_raw >= timestamp '2000-01-01') as n_since,
       {R(GM('case when not broken then p_default end'))} as mean_p_default from logged"""))
def q_prediction_log_scan(spark, d):
    """Records and rejected lines of a log with broken and wrong-typed lines."""
    records, rejected = scan_predictions(spark, _written_log(spark, d))
    since = F.col("ts") >= F.lit(TB.PROD_START).cast("timestamp")
    good = records.agg(F.count(F.lit(1)).alias("n_records"), F.count_if(since).alias("n_since"),
                       (F.sum(F.round(F.col("p_default") * 1e4).cast("bigint")).cast("double")
                        / (F.count("p_default") * 1e4)).alias("mean_p_default"))
    return good.crossJoin(rejected.agg(F.count(F.lit(1)).alias("n_rejected")))  # a row each


# ------------------------------------------------------------ batch inputs --

_LEVELS = ("purpose", "addr_state")


@register("aligned_batch", with_base("""
select application_id, """ + ", ".join(f"case when {c} in (select {c} from train_scored) then {c} end as {c}" for c in _LEVELS) + """,
       cast(null as double) as mort_acc, p_default, case when p_default >= 0.13e0 then 'reject' else 'approve' end as decision
from test_scored"""))
def q_aligned_batch(spark, d):
    """A batch without one training column and with columns of its own, brought
    to the training columns, its levels pinned to those of the training years."""
    cl = TB.cleaned2(spark, d)
    levels = categorical_levels(cl.filter(F.col("issue_year") <= TB.TRAIN_MAX), list(_LEVELS))
    batch = cl.filter(F.col("issue_year") >= TB.TEST_MIN).drop("mort_acc").withColumn("branch", F.lit("north"))
    aligned = align_columns(batch, CLEAN_FEATURES_V2, keep=["application_id"])
    scored = score_batch(aligned, FROZEN_SCORECARD, threshold=0.13, levels=levels)
    return scored.select("application_id", *_LEVELS, "mort_acc", "p_default", "decision")


@register("features_by_label", with_base(f"""
lv as ({unpivot('cleaned2', NUMERIC_FEATURES_V2, keep=['"default"'])})
select column_name, "default" as label, count(value) as n, count(*) - count(value) as n_null, {R('min(value)')} as lowest,
       {R('max(value)')} as highest from lv group by 1, 2"""))
def q_features_by_label(spark, d):
    """Range and gaps of the model's numeric features for both labels (a NaN counts as NULL)."""
    xy = split_xy(TB.cleaned2(spark, d).drop("application_id"))
    lv = PR.long_values(xy, numeric_cols(xy.columns), keep=["default"]).withColumn("value", F.nullif("value", F.lit(float("nan"))))
    return lv.groupBy("column_name", F.col("default").alias("label")).agg(
        F.count("value").alias("n"), F.count_if(F.col("value").isNull()).alias("n_null"),
        F.min("value").alias("lowest"), F.max("value").alias("highest"))


# -------------------------------------------------------- census, samples --

_SQL_TYPES = {"VARCHAR": "string", "DOUBLE": "double", "FLOAT": "float", "INTEGER": "int", "SMALLINT": "smallint",
              "TINYINT": "tinyint"}
_TYPE_CASE = "case t " + " ".join(f"when '{a}' then '{b}'" for a, b in _SQL_TYPES.items()) + " end"
_CENSUS = [*CLEAN_FEATURES_V1, "default", "issue_year"]


@register("column_census", with_base(f"""
c as ({' union all '.join(f'''select '{c}' as column_name, any_value(typeof("{c}")) as t, count("{c}") as n_values,
       count(distinct "{c}") as n_levels from cleaned''' for c in _CENSUS)})
select column_name, {_TYPE_CASE} as dtype, n_values, n_levels from c"""))
def q_column_census(spark, d):
    """Type, values and distinct values of every cleaned column."""
    df = TB.cleaned(spark, d).select(*_CENSUS)
    types = dict(df.dtypes)
    text = df.select(*[F.col(c).cast("string").alias(c) for c in _CENSUS])
    counts = (text.selectExpr(PR._stack(_CENSUS, value="level")).groupBy("column_name", "level")
              .agg(F.count("level").alias("n")).groupBy("column_name")
              .agg(F.sum("n").alias("n_values"), F.count("level").alias("n_levels")))
    dtype = F.create_map(*[F.lit(x) for c in _CENSUS for x in (c, types[c])])
    return counts.select("column_name", dtype[F.col("column_name")].alias("dtype"), "n_values", "n_levels")


_SAMPLED = """
sampled as (
  select * from (
    select *, row_number() over (order by substr(md5('42:' || loan_id), 1, 15), loan_id) as hash_rank, count(*) over () as n_train
    from train_scored) where hash_rank <= floor(n_train * 0.25e0))"""


@register("exact_sample", with_base(_SAMPLED + "\nselect loan_id, issue_year from sampled"))
def q_exact_sample(spark, d):
    """A seeded sample of exactly a quarter of the training rows."""
    train = TB.train_table(spark, d, "loan_id", "issue_year")
    return exact_sample(train, 0.25, "loan_id", RANDOM_STATE).select("loan_id", "issue_year")


class TrialScorecard:
    """A scorer whose weights are a trial's parameters: what a search does around its fits can be checked by SQL."""

    def __init__(self, params: dict):
        self.params = params

    def score_raw(self, df):
        p = {k: F.lit(float(v)) for k, v in self.params.items()}
        score = (F.col("int_rate") * p["learning_rate"] + F.coalesce("dti", F.lit(10.0)) * p["reg_lambda"] / F.lit(100.0)
                 - (F.col("fico_mean").cast("double") - F.lit(700.0)) * p["subsample"] / (p["max_depth"] * F.lit(100.0)))
        return df.withColumn("p_raw", score)


_KEYS = sorted(SEARCH_SPACE)
_TRIALS = ", ".join(f"({i}, {', '.join(f'{float(t[k])!r}e0' for k in _KEYS)}, {str(i == 0).lower()})" for i, t in enumerate(sample_trials()))
_FITS = _SAMPLED + f""",
trials(trial, {', '.join(_KEYS)}, is_default) as (values {_TRIALS}),
placed as (select *, row_number() over (order by issue_year, loan_id) - 1 as pos, count(*) over () as n_sub from sampled),
folded as (
  select *, (pos - (n_sub - 2 * (n_sub // 3))) // (n_sub // 3) as fold from placed where pos >= n_sub - 2 * (n_sub // 3)),
scored_trials as (
  select trial, fold, "default" as y, int_rate * learning_rate + coalesce(dti, 1e1) * reg_lambda / 1e2
    - (cast(fico_mean as double) - 7e2) * subsample / (max_depth * 1e2) as s
  from folded cross join trials),
midranks as (
  select trial, fold, y, rank() over (partition by trial, fold order by s) + (count(*) over (partition by trial, fold, s) - 1) / 2e0 as r
  from scored_trials),
aucs as (
  select trial, fold, (sum(case when y = 1 then r else 0e0 end) - sum(y) * (sum(y) + 1) / 2e0) / (sum(y) * (count(*) - sum(y))) as auc
  from midranks group by trial, fold),
results as (
  select trial, {', '.join(_KEYS)}, avg(auc) as m, stddev_pop(auc) as sd, is_default from aucs join trials using (trial)
  group by trial, {', '.join(_KEYS)}, is_default),
ranked as (select *, row_number() over (order by m desc, trial) as place from results)"""


def searched(spark, d):
    """The search over the scorecard trials, ended after ten fits and resumed from its ledger."""
    train = TB.train_table(spark, d, "loan_id", "issue_year", "default", "int_rate", "dti", "fico_mean")
    ledger = scratch_path(spark, "ledger")
    run = lambda n: random_search(train, [], fit=lambda _, params: TrialScorecard(params), ledger=ledger, parallelism=4, at_most=n)
    run(10)
    return run(None)


@register("tuning_trials", with_base(_FITS + f"""
select trial, {', '.join(_KEYS)}, {R('m')} as mean_auc, {R('sd')} as std_auc, is_default, place from ranked"""))
def q_tuning_trials(spark, d):
    """Trials of the random search with mean and population std of the fold AUC, ranked, from a resumed ledger."""
    return searched(spark, d)


@register("tuning_extremes", with_base(_FITS + f"""
select trial, {R('m')} as mean_auc, place, case when place <= 5 then 'best' else 'worst' end as "end"
from (select *, count(*) over () as n_trials from ranked) where place <= 5 or place > n_trials - 3"""))
def q_tuning_extremes(spark, d):
    """The five best and three worst trials."""
    return best_and_worst(searched(spark, d)).select("trial", "mean_auc", "place", "end")


@register("riskiest_loans", with_base("""
select application_id, p_default, loan_amnt from test_scored order by p_default desc, loan_id limit 20"""))
def q_riskiest_loans(spark, d):
    """The 20 loans of the test years with the highest probabilities (an ordered head)."""
    return (TB.test_scored(spark, d).orderBy(F.desc("p_default"), "loan_id").limit(20)
            .select("application_id", "p_default", "loan_amnt"))


# -------------------------------------------------------------- comparisons --

@register("metrics_by_year", with_base(f"""
g as (select issue_year, p_default as s, sum("default")::double as pos, sum(1 - "default")::double as neg
      from scored group by 1, 2),
c as (select *, sum(pos) over w as cp, sum(neg) over w as cn, sum(pos) over (partition by issue_year) as P,
             sum(neg) over (partition by issue_year) as N from g
      window w as (partition by issue_year order by s rows between unbounded preceding and current row))
select issue_year, cast(max(P) + max(N) as bigint) as n, {R('max(P) / (max(P) + max(N))')} as default_rate,
       {R('sum(pos * (cn - 0.5 * neg)) / (max(P) * max(N))')} as roc_auc, {R('max(abs(cp / P - cn / N))')} as ks
from c where P > 0 and N > 0 and P + N >= 100 and issue_year is not null group by issue_year"""))
def q_metrics_by_year(spark, d):
    """Stability of the frozen scorecard over the issue years."""
    return M.metrics_by_group(TB.scored_table(spark, d, "issue_year", "default", "p_default"), group="issue_year", checkpoint=False)


def _gains_ctes(name: str, score: str) -> str:
    return f"""{name}_r as (select "default" as y, row_number() over (order by {score} desc, loan_id) - 1 as rk, count(*) over () as n
      from test_scored),
{name}_d as (select y, {_decile_sql('rk', 'n')} as decile from {name}_r),
{name}_g as (select decile, avg(y) as rate, sum(y) as nd from {name}_d group by decile),
{name} as (select decile, rate / ((select sum(y) from {name}_r) / (select count(*) from {name}_r)) as lift,
                  sum(nd) over (order by decile) / (select sum(y) from {name}_r) as capture from {name}_g)"""


@register("gains_comparison", with_base(f"""{_gains_ctes('a', 'p_default')},
{_gains_ctes('b', 'int_rate')}
select cast(a.decile as int) as decile, {R('a.lift')} as lift_scorecard, {R('a.capture')} as capture_scorecard,
       {R('b.lift')} as lift_rate, {R('b.capture')} as capture_rate, {R('b.lift - a.lift')} as lift_delta,
       {R('b.capture - a.capture')} as capture_delta
from a join b using (decile)"""))
def q_gains_comparison(spark, d):
    """Gains of the scorecard and of the interest rate alone, decile by decile."""
    test = TB.test_table(spark, d, "loan_id", "default", "p_default", "int_rate")
    a = M.gains_table(test, s="p_default", id_col="loan_id", checkpoint=False)
    b = M.gains_table(test, s="int_rate", id_col="loan_id", checkpoint=False)
    return M.compare_gains(a, b, "scorecard", "rate")


@register("score_histogram_by_split", with_base(f"""
sp as (select p_default, case when issue_year <= 1999 then 'train' else 'test' end as cls from scored
       where issue_year is not null),
x as (select sp.cls, cast(sp.p_default as double) as xv, r.lo, r.hi, r.t
      from sp join (select cls, min(p_default) as lo, max(p_default) as hi, count(*) as t from sp group by 1) r using (cls))
select cls, bin, count(*) as n,
       {R('count(*) / (max(t) * case when max(hi) > max(lo) then (max(hi) - max(lo)) / 50 else 1e0 end)')} as density
from {_ew_bin_sql('x', 'xv', 'lo', 'hi', 50, 'cls, xv, lo, hi, t')} b group by cls, bin"""))
def q_score_histogram_by_split(spark, d):
    s = TB.scored_table(spark, d, "issue_year", "p_default").filter(F.col("issue_year").isNotNull())
    split = F.when(F.col("issue_year") <= TB.TRAIN_MAX, "train").otherwise("test")
    return M.score_histogram(s.withColumn("split", split), "p_default", "split")


@register("levels_by_label", with_base(f"""
select column_name, level, "default" as label, count(*) as n
from ({unpivot('cleaned', CATEGORICAL_COLS, keep=['"default"'], value_type='varchar', value='level')}) u group by 1, 2, 3"""))
def q_levels_by_label(spark, d):
    """Every level of the categorical columns with its rows for both labels."""
    cl = TB.cleaned(spark, d)
    return (cl.selectExpr("`default` as label", PR._stack(CATEGORICAL_COLS, value="level"))
            .groupBy("column_name", "level", "label").agg(F.count(F.lit(1)).alias("n")))
