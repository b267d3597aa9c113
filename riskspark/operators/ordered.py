"""Distributed ordered prefix sums, exact ranks and exact quantiles.

Rank metrics (AUC, KS, average precision, ROC/PR points), gains deciles, time
folds and exact quantiles all need a running sum in a global order. A window
``ORDER BY`` without ``PARTITION BY`` moves every row into one task, so it is
never used on row-level data here. Instead:

1. the caller collapses ties first (``groupBy(key)``) where the semantics allow;
2. cut points come from ``percentile_approx`` over a bounded sample (a list of
   about ``n_buckets`` values collected to the driver);
3. ``Bucketizer`` (binary search, JVM-side) maps each row to a range bucket;
   bucket order equals key order, so any cut points give an exact result and
   only the balance depends on them;
4. per-bucket totals (at most ``n_buckets`` rows per group) give bucket
   offsets through a window over that small table;
5. the row-level running sum is a window partitioned by (group, bucket) plus
   the bucket offset.

A key value that holds a third of all rows becomes one row after step 1; for
row-level ranks the hot value is split further by a unique tiebreak column
(``by=[value]``, ``key=id``), whose cut points are global.
"""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Target rows per bucket; the number of buckets grows with the data.
ROWS_PER_BUCKET = 1_000_000
# Rows a bucket's cut points are sampled from: they only steer the balance.
SAMPLE_PER_BUCKET = 2_000
# Rows of a group up to which exact quantiles look at all its values; of larger
# groups they count those around each quantile one by one.
FEW_ROWS = 200_000
# 1 / ACCURACY of the rows is the error of an approximate quantile; the values
# within two errors are looked at.
ACCURACY = 10_000


def _bucket_count(spark, n_rows: int, n_buckets: int | None) -> int:
    if n_buckets:
        return max(1, int(n_buckets))
    base = int(spark.conf.get("spark.sql.shuffle.partitions", "8"))
    return max(1, base, math.ceil(n_rows / ROWS_PER_BUCKET))


def range_cuts(df: DataFrame, key: str, n_buckets: int | None = None) -> list[float]:
    """Sorted distinct cut points splitting ``key`` into about ``n_buckets`` even
    ranges (default: one per ``ROWS_PER_BUCKET`` rows, at least
    ``spark.sql.shuffle.partitions``), read from a bounded sample."""
    n_rows = df.count()
    k = _bucket_count(df.sparkSession, n_rows, n_buckets)
    if k <= 1 or n_rows <= 1:
        return []
    share = SAMPLE_PER_BUCKET * k / n_rows
    picked = df if share >= 1 else df.sample(share, seed=7)
    vals = picked.agg(F.percentile_approx(F.col(key).cast("double"), [i / k for i in range(1, k)], 20 * k).alias("c")).first()["c"] or []
    return sorted({float(v) for v in vals if v is not None and not math.isnan(v)})


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on equal ``keys``, NULL being equal to NULL; the keys come from ``left``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    out = cond[0]
    for c in cond[1:]:
        out = out & c
    return left.join(renamed, out, "inner").drop(*[f"_r_{k}" for k in keys])


def bucket_value(df: DataFrame, key: str) -> Column:
    """A double that never falls as ``key`` rises: the number itself, or the
    first six bytes of a string. Rows are ordered by the key in its own type."""
    if df.schema[key].dataType.typeName() != "string":
        return F.col(key).cast("double")
    head = F.rpad(F.hex(F.substring(F.encode(F.col(key), "UTF-8"), 1, 6)), 12, "0")
    return F.conv(head, 16, 10).cast("double")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` (shared storage on
    a cluster) and read it back: one job, the lineage is cut, later passes
    read columnar files (with column pruning) instead of re-running the
    upstream plan, and a lost executor does not send them back through it.
    The files go when the application ends."""
    import uuid
    from riskspark.session import ensure_checkpoint_dir
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/mat-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    written = spark._jvm.org.apache.hadoop.fs.Path(path)
    written.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(written)
    return spark.read.parquet(path)


def bucketize(df: DataFrame, key: str, cuts: list[float], out: str = "_bucket") -> DataFrame:
    """Append ``out`` = number of cut points <= key (0 .. len(cuts))."""
    if not cuts:
        return df.withColumn(out, F.lit(0))
    splits = [-math.inf, *cuts, math.inf]
    tmp = f"{out}_in"
    b = Bucketizer(splits=splits, inputCol=tmp, outputCol=out, handleInvalid="keep")
    res = b.transform(df.withColumn(tmp, F.col(key).cast("double")))
    return res.drop(tmp).withColumn(out, F.col(out).cast("int"))


def ordered_prefix(df: DataFrame, key: str, sums: dict[str, Column | str],
                   by: list[str] | tuple[str, ...] = (), descending: bool = False,
                   tiebreak: str | None = None, n_buckets: int | None = None,
                   checkpoint: bool = True, bucket_key: Column | None = None) -> DataFrame:
    """Append ``cum_<name>``: inclusive running sum of each ``sums`` column in
    (``key`` [desc], ``tiebreak``) order, restarting for every ``by`` group.

    Rows must be unique on (by, key, tiebreak); collapse ties beforehand.
    The input is checkpointed first (``checkpoint=True``) because it is read
    by the cut-point pass and by the main pass.
    """
    by = list(by)
    order_key = "_okey"
    value = bucket_value(df, key)
    work = df.withColumn(order_key, F.col(key)).withColumn("_bval", -value if descending else value)
    for name, c in sums.items():
        work = work.withColumn(f"_v_{name}", F.col(c) if isinstance(c, str) else c)
    # ``bucket_key`` (optional) must be non-decreasing in the order key within
    # each group; it only steers balance (e.g. a per-group normalized value)
    if bucket_key is not None:
        work = work.withColumn("_bkey", bucket_key)
    if checkpoint:
        work = materialize(work)
    bk = "_bkey" if bucket_key is not None else "_bval"
    cuts = range_cuts(work, bk, n_buckets)
    work = bucketize(work, bk, cuts)

    totals = work.groupBy(*by, "_bucket").agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*by).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*by, "_bucket", *[
        F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    if not by:
        # at most len(cuts) + 1 rows: a proven bound, safe to broadcast
        offsets = F.broadcast(offsets)
    work = null_safe_join(work, offsets, [*by, "_bucket"])

    order = [F.desc_nulls_first(order_key) if descending else F.asc_nulls_first(order_key)] + ([F.col(tiebreak)] if tiebreak else [])
    w = Window.partitionBy(*by, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    work = work.withColumns({f"cum_{n}": F.sum(f"_v_{n}").over(w) + F.col(f"_o_{n}") for n in sums})
    return work.drop(order_key, "_bval", "_bucket", "_bkey", *[f"_v_{n}" for n in sums], *[f"_o_{n}" for n in sums])


def row_rank(df: DataFrame, key: str, id_col: str, descending: bool = False,
             by: list[str] | tuple[str, ...] = (), n_buckets: int | None = None,
             checkpoint: bool = True) -> DataFrame:
    """Append 0-based ``rank`` in (key [desc], id asc) order within ``by``.

    Ties on ``key`` are ranked by the unique ``id_col``. Each key value is one
    group of the prefix over ids, so a key held by a third of the rows is
    still spread over many buckets.
    """
    by = list(by)
    kcol = "_rk"
    work = df.withColumn(kcol, (-F.col(key) if descending else F.col(key)).cast("double"))
    counts = work.groupBy(*by, kcol).agg(F.count(F.lit(1)).alias("_c"))
    starts = ordered_prefix(counts, kcol, {"c": "_c"}, by=by, n_buckets=n_buckets, checkpoint=checkpoint)
    starts = starts.select(*by, kcol, (F.col("cum_c") - F.col("_c")).alias("_start"))
    within = ordered_prefix(work, id_col, {"one": F.lit(1)}, by=[*by, kcol], n_buckets=n_buckets,
                            checkpoint=checkpoint)
    out = null_safe_join(within, starts, [*by, kcol])
    return out.withColumn("rank", F.col("_start") + F.col("cum_one") - 1).drop(kcol, "_start", "cum_one")


def _lerp(a: Column, b: Column, t: Column) -> Column:
    """Linear interpolation with the two-sided formula numpy uses."""
    d = b - a
    return F.when(t >= 0.5, b - d * (F.lit(1.0) - t)).otherwise(a + d * t)


def exact_quantiles(df: DataFrame, value: str, probs: list[float],
                    by: list[str] | tuple[str, ...] = (), n_buckets: int | None = None,
                    checkpoint: bool = True) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy's default method).

    Returns one row per (group, q) with column ``quantile``. NULL and NaN
    values are ignored. Only the order statistics at the needed ranks are
    looked up: distinct values around them and what lies between, with counts
    -> running counts -> the few rows covering those ranks. The values are read
    three times (``checkpoint``: from a copy of them), in aggregates that the tasks fold.
    """
    by = list(by)
    v = F.col(value)
    clean = df.select(*by, v.cast("double").alias("_x")).filter(F.col("_x").isNotNull() & ~F.isnan("_x"))
    clean = clean.dropna(subset=by) if by else clean
    if checkpoint:
        clean = materialize(clean)
    around = materialize(_brackets(clean, probs, by))
    g = materialize(_counted_around(clean, around, len(probs), by))
    found = _at_ranks(g, probs, by, n_buckets)
    if not around.filter(F.col("_n") > FEW_ROWS).isEmpty() and not found.filter(~F.col("_in")).isEmpty():
        # an approximate quantile was further off than its bound: all values of every group
        everything = around.withColumns({f"_{e}{i}": F.lit(x) for i in range(len(probs)) for e, x in (("l", -math.inf), ("h", math.inf))})
        found = _at_ranks(materialize(_counted_around(clean, everything, len(probs), by)), probs, by, n_buckets)
    return found.drop("_in")


def _brackets(clean: DataFrame, probs: list[float], by: list[str]) -> DataFrame:
    """Per group the number of rows and, for the i-th smallest of ``probs``, values ``_l{i}`` and ``_h{i}`` that its
    quantile lies between; infinite in groups of few rows."""
    reach, k = 2 / ACCURACY, len(probs)
    ordered = sorted(float(q) for q in probs)
    wanted = [max(0.0, q - reach) for q in ordered] + [min(1.0, q + reach) for q in ordered]
    rows = clean.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.percentile_approx("_x", wanted, ACCURACY).alias("_a"))
    many = F.col("_n") > FEW_ROWS
    low = [F.when(many & (q > reach), F.col("_a")[i]).otherwise(-math.inf).alias(f"_l{i}") for i, q in enumerate(ordered)]
    high = [F.when(many & (q + reach < 1), F.col("_a")[k + i]).otherwise(math.inf).alias(f"_h{i}") for i, q in enumerate(ordered)]
    return rows.select(*by, "_n", *low, *high)


def _counted_around(clean: DataFrame, around: DataFrame, k: int, by: list[str]) -> DataFrame:
    """(by..., _x, _c, _in): every distinct value in a bracket with its count, and one row (``_in`` false) for
    the values before, between and after the brackets, whose ``_x`` is the smallest of them."""
    bounds = [f"_{e}{i}" for i in range(k) for e in "lh"]
    if by:
        placed = clean.join(around.select(*by, *bounds), by)
    else:
        placed = clean.crossJoin(F.broadcast(around.select(*bounds)))  # one row
    inside, after = F.lit(False), F.lit(0)
    for i in range(k):
        inside = inside | F.col("_x").between(F.col(f"_l{i}"), F.col(f"_h{i}"))
        after = after + (F.col("_x") > F.col(f"_h{i}")).cast("int")
    placed = placed.select(*by, "_x", inside.alias("_in"), after.alias("_after"))
    return (placed.groupBy(*by, "_in", "_after", F.when(F.col("_in"), F.col("_x")).alias("_v"))
            .agg(F.min("_x").alias("_least"), F.count(F.lit(1)).alias("_c"))
            .select(*by, F.coalesce("_v", "_least").alias("_x"), "_c", "_in"))


def _at_ranks(g: DataFrame, probs: list[float], by: list[str], n_buckets: int | None) -> DataFrame:
    """Quantiles from distinct values and counts; ``_in`` tells whether both values of a quantile are such."""
    bkey = None
    if by:
        # groups (e.g. columns of a profile) live on unrelated scales: bucket on
        # the value rescaled to [0, 1] within its group so every group spreads
        # over all buckets; the order inside a bucket stays the exact value
        rng = g.groupBy(*by).agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        g = g.join(rng, on=by, how="inner")
        span = F.col("_hi") - F.col("_lo")
        bkey = F.when(span > 0, (F.col("_x") - F.col("_lo")) / span).otherwise(F.lit(0.0))
    pre = ordered_prefix(g, "_x", {"c": "_c"}, by=by, n_buckets=n_buckets, checkpoint=False, bucket_key=bkey)
    pre = pre.withColumn("_start", F.col("cum_c") - F.col("_c"))
    # Without groups every table joins on one constant key: the other side has one
    # row (totals, ranks) or at most 2*len(probs) rows (values found).
    keys = by or ["_g"]
    if not by:
        g = g.withColumn("_g", F.lit(0))
        pre = pre.withColumn("_g", F.lit(0))

    qarr = F.array(*[F.lit(float(q)) for q in probs])
    totals = g.groupBy(*keys).agg(F.sum("_c").alias("_n"))
    targets = (totals
               .select(*keys, "_n", F.posexplode(qarr).alias("qi", "q"))
               .withColumn("_h", (F.col("_n") - 1).cast("double") * F.col("q"))
               .withColumn("_lo", F.floor("_h").cast("bigint"))
               .withColumn("_hi", F.least(F.col("_lo") + 1, F.col("_n") - 1))
               .withColumn("_t", F.col("_h") - F.col("_lo")))
    # one row per group holding at most 2*len(probs) ranks
    needed = targets.groupBy(*keys).agg(
        F.array_distinct(F.flatten(F.collect_list(F.array("_lo", "_hi")))).alias("_ranks"))
    if not by:
        needed = F.broadcast(needed)
    cover = (pre.join(needed, on=keys, how="inner")
             .filter(F.exists("_ranks", lambda r: (F.col("_start") <= r) & (r < F.col("cum_c"))))
             .select(*keys, "_x", "_in", "_start", "cum_c"))
    lo = cover.select(*keys, F.col("_x").alias("_a"), F.col("_in").alias("_a_in"), F.col("_start").alias("_as"), F.col("cum_c").alias("_ae"))
    hi = cover.select(*keys, F.col("_x").alias("_b"), F.col("_in").alias("_b_in"), F.col("_start").alias("_bs"), F.col("cum_c").alias("_be"))
    res = (targets
           .join(lo, on=keys, how="inner").filter((F.col("_as") <= F.col("_lo")) & (F.col("_lo") < F.col("_ae")))
           .join(hi, on=keys, how="inner").filter((F.col("_bs") <= F.col("_hi")) & (F.col("_hi") < F.col("_be"))))
    return res.select(*by, "qi", "q", _lerp(F.col("_a"), F.col("_b"), F.col("_t")).alias("quantile"),
                      (F.col("_a_in") & F.col("_b_in")).alias("_in"))


def quantile_list(df: DataFrame, value: str, probs: list[float], n_buckets: int | None = None,
                  checkpoint: bool = True) -> list[float]:
    """Exact quantiles of one column as a Python list (len(probs) scalars)."""
    rows = exact_quantiles(df, value, probs, n_buckets=n_buckets, checkpoint=checkpoint).orderBy("qi").collect()
    if len(rows) != len(probs):
        return [math.nan] * len(probs)
    return [float(r["quantile"]) for r in rows]
