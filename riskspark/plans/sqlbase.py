"""DuckDB oracle building blocks: the loan view and its derived tables as CTEs.

These strings are the *independent* statement of each query's meaning, used
only to check the Spark plans; they are plain SQL over the driver's tables.
"""

from __future__ import annotations

import numpy as np

from riskspark.schema import (
    CATEGORICAL_COLS, DEFAULT_STATUSES, EMP_LENGTH_YEARS, REPAY_STATUSES,
)
from riskspark.sources.loanview import oracle_loans_cte


def dbl(x: float) -> str:
    """Exact double literal."""
    return f"cast('{float(x)!r}' as double)"


def _in(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_EMP_CASE = "case emp_length " + " ".join(
    f"when '{k}' then {v}" for k, v in EMP_LENGTH_YEARS.items()) + " end"

_HIST = ("case when credit_history_years is not null then "
         "greatest(cast(credit_history_years as float), cast(1 as float)) end")

BASE_CTES = oracle_loans_cte() + f""",
labelled as (
  select *, cast(case when loan_status in ({_in(DEFAULT_STATUSES)}) then 1
                      when loan_status in ({_in(REPAY_STATUSES)}) then 0 end as int) as "default"
  from loans),
curated as (
  select *, cast(year(try_strptime(issue_d, '%b-%Y')) as int) as issue_year
  from labelled where "default" is not null),
cleaned as (
  select application_id, loan_amnt,
    cast(regexp_extract(trim(term), '(\\d+)', 1) as tinyint) as term,
    int_rate, installment, grade, sub_grade,
    cast({_EMP_CASE} as float) as emp_length,
    home_ownership, annual_inc, verification_status, purpose, addr_state, application_type,
    dti, revol_util, revol_bal, delinq_2yrs, pub_rec,
    cast(coalesce(pub_rec_bankruptcies, 0) as smallint) as pub_rec_bankruptcies,
    cast(coalesce(mort_acc, 0) as smallint) as mort_acc,
    open_acc, total_acc, "default", issue_year,
    cast(emp_length is null as tinyint) as emp_length_missing,
    cast(issue_year - year(try_strptime(earliest_cr_line, '%b-%Y')) as smallint) as credit_history_years,
    cast((fico_range_low + fico_range_high) / 2 as float) as fico_mean
  from curated),
cleaned2 as (
  select *,
    cast(case when annual_inc > 0 then loan_amnt / annual_inc end as float) as loan_to_income,
    cast(case when annual_inc > 0 then installment * 12 / annual_inc end as float) as installment_to_income,
    cast(int_rate * term as float) as int_rate_x_term,
    cast(cast(cast(850 as float) - fico_mean as double) * (dti / 100) as float) as fico_dti_risk,
    cast((revol_util / 100) * ln(1 + revol_bal) as float) as revol_util_x_logbal,
    cast(total_acc / {_HIST} as float) as accounts_per_year,
    cast(delinq_2yrs / {_HIST} as float) as delinq_per_year
  from cleaned),
scored as (
  select *, round(1e0/(1e0+exp(-(-3.2e0 + 1.2e-1*int_rate - 4e-3*(cast(fico_mean as double) - 700)
                     + 1e-2*coalesce(dti,1e1)))),4) as p_default,
         cast(application_id as bigint) as loan_id
  from cleaned2),
test_scored as (select * from scored where issue_year >= 2000),
train_scored as (select * from scored where issue_year <= 1999),
plog as (
  select strftime(o.o_orderdate, '%Y-%m-%d %H:%M:%S') as ts, o.o_orderdate as ts_raw, l.application_id,
         round(1e0/(1e0+exp(-(-3.2e0 + 1.2e-1*l.int_rate
               - 4e-3*(cast(cast((l.fico_range_low + l.fico_range_high) / 2 as float) as double) - 700)
               + 1e-2*coalesce(l.dti,1e1)))),4) as p_default
  from loans l join orders o on cast(o.o_orderkey as varchar) = l.application_id),
predlog as (
  select ts, ts_raw, application_id, p_default,
         case when p_default >= 0.13e0 then 'reject' else 'approve' end as decision
  from plog),
outcomes as (select application_id, cast("default" as int) as actual from curated)"""


def with_base(body: str) -> str:
    return "with " + BASE_CTES + ",\n" + body


def quantile_ctes(name: str, src: str, value: str, probs: list[float], by: list[str] = ()) -> str:
    """CTEs ``{name}`` (by..., qi, quantile) with numpy's linear interpolation:
    h = (n-1)*q, a = x[floor h], b = x[min(floor h + 1, n-1)], t = h - floor h,
    result a + (b-a)*t below t = 0.5, else b - (b-a)*(1-t)."""
    by = list(by)
    bysel = "".join(f"{b}, " for b in by)
    part = f"partition by {', '.join(by)} " if by else ""
    on = " and ".join([f"r.{b} = t.{b}" for b in by] + ["true"])
    qvals = ", ".join(f"({i}, {dbl(q)})" for i, q in enumerate(probs))
    return f"""{name}_r as (
  select {bysel}v, row_number() over ({part}order by v) - 1 as rk, count(*) over ({part.strip()}) as n
  from (select {bysel}cast({value} as double) as v from {src}) s
  where v is not null and not isnan(v)),
{name}_t as (
  select {bysel}n, qi, q, cast(n - 1 as double) * q as h,
         cast(floor(cast(n - 1 as double) * q) as bigint) as lo_i,
         least(cast(floor(cast(n - 1 as double) * q) as bigint) + 1, n - 1) as hi_i
  from (select distinct {bysel}n from {name}_r) g cross join (values {qvals}) p(qi, q)),
{name} as (
  select {"".join(f"t.{b}, " for b in by)}t.qi,
         case when (t.h - t.lo_i) >= 0.5 then b.v - (b.v - a.v) * (1 - (t.h - t.lo_i))
              else a.v + (b.v - a.v) * (t.h - t.lo_i) end as quantile
  from {name}_t t
  join {name}_r a on a.rk = t.lo_i and {on.replace('r.', 'a.')}
  join {name}_r b on b.rk = t.hi_i and {on.replace('r.', 'b.')})"""


def unpivot(src: str, cols: list[str], keep: list[str] = (), value_type: str = "double",
            name: str = "column_name", value: str = "value") -> str:
    keep_sel = "".join(f'{k}, ' for k in keep)
    parts = [f"select {keep_sel}'{c}' as {name}, cast({c} as {value_type}) as {value} from {src}" for c in cols]
    return "\n  union all ".join(parts)


def linspace(a: float, b: float, n: int) -> list[float]:
    return [float(x) for x in np.linspace(a, b, n)]


CATS = CATEGORICAL_COLS
