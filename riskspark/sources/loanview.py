"""Binding of the driver's TPC-H-style tables to the loan data model.

The test tables hold no loans, so one deterministic view maps every order that
has line items to one loan application with the 27 raw columns plus
``application_id``. The same SQL text is the ``loans`` CTE of every oracle
query, so both engines start from identical inputs. Integer arithmetic and
exponent literals keep both engines in exact integer / double arithmetic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed fixture definition (shared verbatim by the Spark side and the oracle).
LOANS_SQL = """
with li as (
  select l_orderkey,
         count(*)                                                          as n_lines,
         cast(sum(cast(round(l_discount * 100) as bigint)) as bigint)      as disc_i,
         cast(sum(cast(round(l_tax * 100) as bigint)) as bigint)           as tax_i,
         cast(sum(cast(l_quantity as bigint)) as bigint)                   as qty_i,
         cast(sum(cast(round(l_extendedprice * 100) as bigint)) as bigint) as gross_c,
         cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as n_ret,
         cast(sum(case when l_linestatus = 'O' then 1 else 0 end) as bigint) as n_open
  from {lineitem} group by l_orderkey),
k as (
  select o.*, c.c_acctbal, c.c_mktsegment, n.n_name, r.r_name, li.*,
         cast(year(o.o_orderdate) as int) as yr, cast(month(o.o_orderdate) as int) as mo,
         (o.o_orderkey * 7919 + o.o_custkey * 104729) % 1000 as noise
  from {orders} o join li on li.l_orderkey = o.o_orderkey
  join {customer} c on c.c_custkey = o.o_custkey
  join {nation} n on n.n_nationkey = c.c_nationkey
  join {region} r on r.r_regionkey = n.n_regionkey)
select cast(o_orderkey as string)                                          as application_id,
  o_totalprice / 1e1                                                       as loan_amnt,
  case when o_orderkey % 3 = 0 then ' 60 months' else ' 36 months' end     as term,
  5e0 + 2e0 * disc_i / n_lines                                             as int_rate,
  o_totalprice / (case when o_orderkey % 3 = 0 then 6e2 else 3.6e2 end)    as installment,
  substr('ABCDEFG', 1 + cast(floor(disc_i * 7e0 / (n_lines * 1.1e1)) as int), 1) as grade,
  substr('ABCDEFG', 1 + cast(floor(disc_i * 7e0 / (n_lines * 1.1e1)) as int), 1)
    || cast(1 + o_orderkey % 5 as string)                                  as sub_grade,
  case o_orderkey % 13 when 0 then null when 1 then '< 1 year' when 2 then '1 year'
    when 12 then '10+ years' else cast(o_orderkey % 13 - 1 as string) || ' years' end as emp_length,
  c_mktsegment                                                             as home_ownership,
  c_acctbal * 1e1                                                          as annual_inc,
  r_name                                                                   as verification_status,
  case when yr >= 2000 and o_orderkey % 53 = 0 then 'renewable energy'
       else substr(o_orderpriority, 3) end                                 as purpose,
  case when o_orderkey % 89 = 0 then n_name else substr(n_name, 1, 2) end  as addr_state,
  case when o_custkey % 17 = 0 then 'Joint App' else 'Individual' end      as application_type,
  case when o_orderkey % 97 = 0 then null else tax_i * 5e0 / n_lines end   as dti,
  case when o_orderkey % 89 = 0 then null else qty_i * 2e0 / n_lines end   as revol_util,
  gross_c / 1e2                                                            as revol_bal,
  cast(600 + 5 * (o_custkey % 50) as double)                               as fico_range_low,
  cast(604 + 5 * (o_custkey % 50) as double)                               as fico_range_high,
  cast(n_ret as double)                                                    as delinq_2yrs,
  cast(o_custkey % 4 as double)                                            as pub_rec,
  case when o_orderkey % 101 = 0 then null else cast(o_custkey % 2 as double) end as pub_rec_bankruptcies,
  case when o_orderkey % 45 = 0 then null else cast(o_custkey % 6 as double) end  as mort_acc,
  cast(n_open as double)                                                   as open_acc,
  cast(n_lines as double)                                                  as total_acc,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', cast(3 * (o_custkey % 12) + 1 as int), 3)
    || '-' || cast(yr - o_custkey % 30 as string)                          as earliest_cr_line,
  substr('JanFebMarAprMayJunJulAugSepOctNovDec', 3 * (mo - 1) + 1, 3)
    || '-' || cast(yr as string)                                           as issue_d,
  case when o_orderstatus = 'P' then
         case o_orderkey % 3 when 0 then 'Current' when 1 then 'In Grace Period' else 'Issued' end
       when noise * n_lines < (60 + 10 * (yr - 1995)) * n_lines + 30 * disc_i then
         case o_orderkey % 5 when 0 then 'Charged Off' when 1 then 'Default'
           when 2 then 'Late (31-120 days)' when 3 then 'Late (16-30 days)'
           else 'Does not meet the credit policy. Status:Charged Off' end
       when o_orderkey % 11 = 0 then 'Does not meet the credit policy. Status:Fully Paid'
       else 'Fully Paid' end                                               as loan_status,
  o_orderdate                                                              as applied_on
from k
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (a single Parquet file per table)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def loans(spark: SparkSession, sf_dir: str, dated: bool = False) -> DataFrame:
    """Raw loan applications (27 raw columns + application_id) from the driver tables;
    ``dated`` adds the day of the application (``applied_on``).

    Plan: partial aggregate of lineitem by order key, sort-merge join with
    orders on the same key (the aggregate's hash partitioning is reused),
    join with customer (Catalyst/AQE pick broadcast only when statistics prove
    it small), nation and region broadcast (25 and 5 rows by definition).
    """
    view = spark.sql(LOANS_SQL, **{t: table(spark, sf_dir, t)
                                   for t in ("lineitem", "orders", "customer", "nation", "region")})
    return view if dated else view.drop("applied_on")


def oracle_loans_cte() -> str:
    """The same view as a DuckDB CTE named ``loans`` over the pre-registered tables."""
    body = LOANS_SQL.format(lineitem="lineitem", orders="orders", customer="customer",
                            nation="nation", region="region").strip()
    # The view's own CTEs become siblings of ``loans``.
    assert body.startswith("with ")
    head, _, select = body.rpartition("\nselect ")
    return head[len("with "):] + ",\nloans as (select " + select + ")"
