"""Rank metrics and decision tables as distributed DataFrame jobs.

Conventions: ``y`` is a 0/1 label column, ``s`` a score column. Rows with a
NULL label are ignored by every metric; a NULL/NaN score is ignored by the
rank metrics and never counts as ">= t" in threshold tables.

Tie handling is exact: AUC counts tied (positive, negative) pairs as 1/2 (the
trapezoid under the ROC curve through every distinct score), average precision
steps at every distinct score, and KS is evaluated at distinct scores only
(a deliberate, order-independent definition).
"""

from __future__ import annotations


import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskspark.functions.exact import grid_mean, grid_sq_error_mean
from riskspark.operators.ordered import ordered_prefix, quantile_list
from riskspark.schema import COST_FN, COST_FP, GROUP_MIN_ROWS, LOGLOSS_EPS, PSI_SHARE_FLOOR


def _valid(df: DataFrame, y: str, s: str) -> DataFrame:
    return df.filter(F.col(y).isNotNull() & F.col(s).isNotNull() & ~F.isnan(F.col(s)))


def score_groups(df: DataFrame, y: str = "default", s: str = "p_default",
                 by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Collapse rows to (group, distinct score) with positive / negative counts."""
    yy = F.col(y).cast("int")
    return (_valid(df, y, s)
            .groupBy(*by, F.col(s).cast("double").alias("_s"))
            .agg(F.sum(yy).cast("double").alias("_pos"),
                 F.sum(1 - yy).cast("double").alias("_neg")))


def _ranked(df: DataFrame, y: str, s: str, by, checkpoint: bool = True) -> DataFrame:
    """Distinct scores with ascending running pos/neg and group totals P/N."""
    return _running(score_groups(df, y, s, by), by, checkpoint)


def _running(g: DataFrame, by, checkpoint: bool = True) -> DataFrame:
    pre = ordered_prefix(g, "_s", {"pos": "_pos", "neg": "_neg"}, by=by, checkpoint=checkpoint)
    tot = g.groupBy(*by).agg(F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"))
    if by:
        return pre.join(tot, on=list(by), how="inner")
    # one row: broadcast join on a constant key
    return (pre.withColumn("_k", F.lit(0))
            .join(F.broadcast(tot.withColumn("_k", F.lit(0))), on="_k").drop("_k"))


def rank_metrics(df: DataFrame, y: str = "default", s: str = "p_default",
                 by: list[str] | tuple[str, ...] = (), checkpoint: bool = True) -> DataFrame:
    """Per group: n_pos, n_neg, roc_auc, pr_auc (average precision), ks.

    AUC, AP and KS are NULL when a class is absent. ``checkpoint=False`` when
    ``df`` is already materialized (the grouped scores are then cheap to
    recompute for the cut-point pass).
    """
    return rank_from_counts(score_groups(df, y, s, by), by, checkpoint)


def rank_from_counts(g: DataFrame, by: list[str] | tuple[str, ...] = (), checkpoint: bool = True) -> DataFrame:
    """:func:`rank_metrics` of collapsed rows: one row a (group, score ``_s``)
    with its positive and negative counts ``_pos`` and ``_neg`` (doubles)."""
    by = list(by)
    r = _running(g, by, checkpoint)
    P, N = F.col("_P"), F.col("_N")
    auc_term = F.col("_pos") * (F.col("cum_neg") - 0.5 * F.col("_neg"))
    tp = P - F.col("cum_pos") + F.col("_pos")          # rows with score >= s that are positive
    fp = N - F.col("cum_neg") + F.col("_neg")
    ap_term = F.when(F.col("_pos") > 0, F.col("_pos") * (tp / (tp + fp)))
    # guarded per row: a one-class group must not divide by zero under ANSI
    ks_term = F.when((P > 0) & (N > 0), F.abs(F.col("cum_pos") / P - F.col("cum_neg") / N))
    both = (F.first("_P") > 0) & (F.first("_N") > 0)
    return r.groupBy(*by).agg(
        F.first("_P").cast("bigint").alias("n_pos"),
        F.first("_N").cast("bigint").alias("n_neg"),
        F.when(both, F.sum(auc_term) / (F.first("_P") * F.first("_N"))).alias("roc_auc"),
        F.when(both, F.sum(ap_term) / F.first("_P")).alias("pr_auc"),
        F.when(both, F.max(ks_term)).alias("ks"),
    )


def prob_metrics(df: DataFrame, y: str = "default", p: str = "p_default",
                 by: list[str] | tuple[str, ...] = (), p_decimals: int | None = None) -> DataFrame:
    """Per group: n, label mean, mean p, Brier and clipped log-loss (one scan).

    ``p_decimals``: scores lie on that decimal grid -> exact integer sums."""
    yy = F.col(y).cast("double")
    pp = F.col(p).cast("double")
    pc = F.least(F.greatest(pp, F.lit(LOGLOSS_EPS)), F.lit(1.0 - LOGLOSS_EPS))
    ll = -(yy * F.log(pc) + (1 - yy) * F.log(1 - pc))
    return (df.filter(F.col(y).isNotNull() & F.col(p).isNotNull())
            .groupBy(*by).agg(F.count(F.lit(1)).alias("n"),
                              F.avg(yy).alias("actual_rate"),
                              grid_mean(pp, p_decimals).alias("mean_p"),
                              grid_sq_error_mean(pp, yy, p_decimals).alias("brier"),
                              F.avg(ll).alias("log_loss")))


def metric_row(df: DataFrame, y: str = "default", s: str = "p_default",
               p_decimals: int | None = None, checkpoint: bool = True) -> DataFrame:
    """The five-metric row: roc_auc, pr_auc, brier, log_loss, ks."""
    r = rank_metrics(df, y, s, checkpoint=checkpoint).withColumn("_k", F.lit(0))
    p = prob_metrics(df, y, s, p_decimals=p_decimals).withColumn("_k", F.lit(0))
    return (r.join(p, on="_k")
            .select("roc_auc", "pr_auc", "brier", "log_loss", "ks"))


def metrics_by_group(df: DataFrame, s: str = "p_default", y: str = "default",
                     group: str = "grade", min_rows: int = GROUP_MIN_ROWS, checkpoint: bool = True) -> DataFrame:
    """Per group: n, default_rate, roc_auc, ks; groups under ``min_rows`` rows or
    with one class are omitted (an empty result is an empty DataFrame)."""
    valid = _valid(df, y, s)
    stats = valid.groupBy(group).agg(F.count(F.lit(1)).alias("n"),
                                     F.avg(F.col(y).cast("double")).alias("default_rate"),
                                     F.countDistinct(y).alias("_k"))
    keep = stats.filter((F.col("n") >= min_rows) & (F.col("_k") == 2)).drop("_k")
    ranks = rank_metrics(valid.join(keep.select(group), on=group, how="left_semi"), y, s, by=[group],
                         checkpoint=checkpoint)
    return (keep.join(ranks.select(group, "roc_auc", "ks"), on=group, how="inner")
            .select(group, "n", "default_rate", "roc_auc", "ks")
            .orderBy(group))


def roc_points(df: DataFrame, y: str = "default", s: str = "p_default", checkpoint: bool = True) -> DataFrame:
    """Every distinct score as a threshold: tp, fp, tpr, fpr, precision, recall."""
    r = _ranked(df, y, s, [], checkpoint)
    P, N = F.col("_P"), F.col("_N")
    tp = P - F.col("cum_pos") + F.col("_pos")
    fp = N - F.col("cum_neg") + F.col("_neg")
    return r.select(F.col("_s").alias("threshold"),
                    tp.cast("bigint").alias("tp"), fp.cast("bigint").alias("fp"),
                    F.when(P > 0, tp / P).alias("tpr"), F.when(N > 0, fp / N).alias("fpr"),
                    (tp / (tp + fp)).alias("precision"), F.when(P > 0, tp / P).alias("recall"))


def confusion_matrix(df: DataFrame, y: str = "default", s: str = "p_default",
                     threshold: float = 0.5) -> DataFrame:
    """tp, fp, tn, fn and the predicted-positive rate at ``s >= threshold``."""
    pred = F.coalesce((F.col(s) >= F.lit(float(threshold))) & ~F.isnan(F.col(s)), F.lit(False))
    yy = F.col(y) == 1
    return (df.filter(F.col(y).isNotNull())
            .agg(F.count_if(pred & yy).alias("tp"), F.count_if(pred & ~yy).alias("fp"),
                 F.count_if(~pred & ~yy).alias("tn"), F.count_if(~pred & yy).alias("fn"),
                 F.avg(pred.cast("double")).alias("predicted_rate")))


# -------- threshold grid -----------------------------------------------------

def default_thresholds() -> list[float]:
    """The 99-point grid 0.01 .. 0.99 (identical doubles to numpy.linspace)."""
    return [float(t) for t in np.linspace(0.01, 0.99, 99)]


def _count_at_or_below(x: Column, cuts: list[float]) -> Column:
    """Number of cut values <= x (a codegen'd sum of comparisons; NULL -> 0)."""
    terms = [F.when(x >= F.lit(float(c)), 1).otherwise(0) for c in cuts]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return F.coalesce(out, F.lit(0))


def cost_curve(df: DataFrame, y: str = "default", s: str = "p_default",
               c_fn: float = COST_FN, c_fp: float = COST_FP, weight: str | None = None,
               thresholds: list[float] | None = None) -> DataFrame:
    """Expected cost at every threshold (reject iff score >= t).

    One aggregation: each row falls into bucket b = number of thresholds <= s,
    weighted positives/negatives are summed per bucket (at most len+1 rows),
    and fn/fp at threshold j are prefix/suffix sums over buckets.
    """
    ts = thresholds or default_thresholds()
    m = len(ts)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    sc = F.when(~F.isnan(F.col(s)), F.col(s))
    rows = df.filter(F.col(y).isNotNull())
    b = rows.select(_count_at_or_below(sc, ts).alias("b"),
                    F.when(F.col(y) == 1, w).otherwise(0.0).alias("wp"),
                    F.when(F.col(y) == 1, 0.0).otherwise(w).alias("wn"))
    per = b.groupBy("b").agg(F.sum("wp").alias("wp"), F.sum("wn").alias("wn"))
    spark = df.sparkSession
    grid = spark.createDataFrame([(j, float(t)) for j, t in enumerate(ts)], "j int, threshold double")
    buckets = spark.range(m + 1).select(F.col("id").cast("int").alias("b"))
    per = buckets.join(per, on="b", how="left").fillna(0.0, subset=["wp", "wn"])
    # <= m + 1 rows: the unpartitioned window runs over a bounded table
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy()
    per = per.select("b", F.sum("wp").over(upto).alias("fn"), F.sum("wn").over(upto).alias("tn"),
                     F.sum("wp").over(whole).alias("P"), F.sum("wn").over(whole).alias("N"))
    out = grid.join(F.broadcast(per), grid.j == per.b).drop("b")
    tp = F.col("P") - F.col("fn")
    fp = F.col("N") - F.col("tn")
    return out.select(
        "threshold",
        F.col("fn").cast("double").alias("fn"),
        fp.cast("double").alias("fp"),
        (F.lit(float(c_fn)) * F.col("fn") + F.lit(float(c_fp)) * fp).alias("cost"),
        F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0).alias("precision"),
        F.when(F.col("P") > 0, tp / F.col("P")).otherwise(0.0).alias("recall"),
    )


def optimal_threshold(curve: DataFrame) -> DataFrame:
    """Row of minimum cost; the lowest threshold wins ties."""
    return curve.orderBy(F.col("cost").asc(), F.col("threshold").asc()).limit(1)


def nearest_threshold(curve: DataFrame, t: float = 0.5) -> DataFrame:
    """Grid row closest to ``t`` (the naive baseline), lower threshold on ties."""
    return curve.orderBy(F.abs(F.col("threshold") - F.lit(float(t))).asc(), F.col("threshold").asc()).limit(1)


# -------- PSI ------------------------------------------------------------------

def psi_edges(expected: DataFrame, e: str, n_bins: int = 10, checkpoint: bool = True) -> list[float]:
    """Inner quantile edges of the expected distribution (n_bins - 1 values)."""
    probs = [float(q) for q in np.linspace(0, 1, n_bins + 1)[1:-1]]
    return quantile_list(expected, e, probs, checkpoint=checkpoint)


def psi_table(expected: DataFrame, e: str, actual: DataFrame, a: str,
              n_bins: int = 10, edges: list[float] | None = None, checkpoint: bool = True) -> DataFrame:
    """Per bin: expected and actual shares (floored) and the PSI term.

    Bin = number of inner edges <= x (left-closed bins, outer edges at
    +-infinity); all bins are present even when empty.
    """
    edges = edges if edges is not None else psi_edges(expected, e, n_bins, checkpoint)
    spark = expected.sparkSession

    def counts(df, col, name):
        x = F.col(col).cast("double")
        v = df.filter(x.isNotNull() & ~F.isnan(x))
        return v.groupBy(_count_at_or_below(x, edges).alias("bin")).agg(F.count(F.lit(1)).alias(name))

    bins = spark.range(n_bins).select(F.col("id").cast("int").alias("bin"))
    t = (bins.join(counts(expected, e, "n_expected"), "bin", "left")
         .join(counts(actual, a, "n_actual"), "bin", "left")
         .fillna(0, subset=["n_expected", "n_actual"]))
    # <= n_bins rows
    whole = Window.partitionBy()
    t = t.withColumns({
        "e_share": F.greatest(F.col("n_expected") / F.sum("n_expected").over(whole), F.lit(PSI_SHARE_FLOOR)),
        "a_share": F.greatest(F.col("n_actual") / F.sum("n_actual").over(whole), F.lit(PSI_SHARE_FLOOR)),
    })
    return t.withColumn("psi_term", (F.col("a_share") - F.col("e_share")) * F.log(F.col("a_share") / F.col("e_share")))


def psi(expected: DataFrame, e: str, actual: DataFrame, a: str, n_bins: int = 10,
        edges: list[float] | None = None, checkpoint: bool = True) -> DataFrame:
    """Population stability index between two score distributions (one row)."""
    return psi_table(expected, e, actual, a, n_bins, edges, checkpoint).agg(F.sum("psi_term").alias("psi"))


# -------- gains ----------------------------------------------------------------

def _decile_of(rank: Column, n: Column, n_bins: int) -> Column:
    """Equal-count bin (1-based) of a 0-based rank among n rows: the bin whose
    right-closed edge q_k = (n-1)*k/n_bins first reaches the rank."""
    qs = [float(q) for q in np.linspace(0, 1, n_bins + 1)[1:-1]]
    out = F.lit(1)
    for q in qs:
        out = out + F.when(rank.cast("double") > (n - 1).cast("double") * F.lit(q), 1).otherwise(0)
    return out


def gains_table(df: DataFrame, y: str = "default", s: str = "p_default", id_col: str = "application_id",
                n_bins: int = 10, checkpoint: bool = True) -> DataFrame:
    """Per decile (1 = highest scores): n, n_defaults, default_rate, score_min,
    score_max, lift, cum_defaults, cum_capture_rate.

    Rows are ranked by (score desc, id asc). Score ties are collapsed first;
    only the (at most n_bins - 1) tie groups that straddle a decile edge are
    ranked row by row, spread over buckets of the id.
    """
    v = _valid(df, y, s).select(F.col(s).cast("double").alias("_s"), F.col(y).cast("int").alias("_y"), F.col(id_col).alias("_id"))
    g = v.groupBy("_s").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_d"))
    pre = ordered_prefix(g, "_s", {"c": "_c"}, descending=True, checkpoint=checkpoint)
    n_tot = g.agg(F.sum("_c").alias("_n"), F.sum("_d").alias("_dtot")).withColumn("_k", F.lit(0))
    pre = (pre.withColumn("_k", F.lit(0)).join(F.broadcast(n_tot), on="_k").drop("_k")
           .withColumn("_r0", F.col("cum_c") - F.col("_c")))
    n = F.col("_n")
    pre = pre.withColumns({"_dlo": _decile_of(F.col("_r0"), n, n_bins),
                           "_dhi": _decile_of(F.col("cum_c") - 1, n, n_bins)})
    whole = (pre.filter(F.col("_dlo") == F.col("_dhi"))
             .select(F.col("_dlo").alias("decile"), "_c", "_d", F.col("_s").alias("_smin"), F.col("_s").alias("_smax")))
    straddle = pre.filter(F.col("_dlo") != F.col("_dhi")).select("_s", "_r0", "_n")
    # at most n_bins - 1 straddling score values
    rows = v.join(F.broadcast(straddle), on="_s", how="inner")
    # rank inside each straddling tie group by id, spread over id buckets
    ranked = ordered_prefix(rows, "_id", {"one": F.lit(1)}, by=["_s"], checkpoint=checkpoint)
    split = (ranked.withColumn("decile", _decile_of(F.col("_r0") + F.col("cum_one") - 1, F.col("_n"), n_bins))
             .groupBy("decile", "_s").agg(F.count(F.lit(1)).alias("_c"), F.sum("_y").alias("_d"))
             .select("decile", "_c", "_d", F.col("_s").alias("_smin"), F.col("_s").alias("_smax")))
    per = (whole.unionByName(split).groupBy("decile")
           .agg(F.sum("_c").alias("n"), F.sum("_d").alias("n_defaults"),
                F.min("_smin").alias("score_min"), F.max("_smax").alias("score_max")))
    tot = n_tot.select(F.col("_n").alias("_N"), F.col("_dtot").alias("_D"))
    per = per.withColumn("_k", F.lit(0)).join(F.broadcast(tot.withColumn("_k", F.lit(0))), on="_k").drop("_k")
    cum = Window.orderBy("decile").rowsBetween(Window.unboundedPreceding, 0)  # <= n_bins rows
    return (per.withColumn("default_rate", F.col("n_defaults") / F.col("n"))
            .withColumn("lift", F.col("default_rate") / (F.col("_D") / F.col("_N")))
            .withColumn("cum_defaults", F.sum("n_defaults").over(cum))
            .withColumn("cum_capture_rate", F.col("cum_defaults") / F.col("_D"))
            .select(F.col("decile").cast("int"), F.col("n").cast("bigint"), F.col("n_defaults").cast("bigint"),
                    "default_rate", "score_min", "score_max", "lift",
                    F.col("cum_defaults").cast("bigint"), "cum_capture_rate"))


# -------- reliability and histograms ------------------------------------------

def reliability_table(df: DataFrame, y: str = "default", p: str = "p_default", n_bins: int = 20,
                      p_decimals: int | None = None, checkpoint: bool = True) -> DataFrame:
    """Quantile-binned reliability: per non-empty bin, n, mean predicted and
    observed fraction. Bin = number of inner edges < p (right-closed)."""
    v = _valid(df, y, p)
    probs = [float(q) for q in (np.linspace(0, 1, n_bins + 1) * 100) / 100][1:-1]
    edges = quantile_list(v, p, probs, checkpoint=checkpoint)
    x = F.col(p).cast("double")
    terms = [F.when(x > F.lit(float(e)), 1).otherwise(0) for e in edges]
    binexpr = F.lit(0)
    for t in terms:
        binexpr = binexpr + t
    return (v.groupBy(binexpr.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), grid_mean(x, p_decimals).alias("mean_predicted"),
                 F.avg(F.col(y).cast("double")).alias("fraction_observed")))


def equal_width_bin(x: Column, lo: Column, hi: Column, n_bins: int) -> Column:
    """0-based bin of x among n_bins equal-width bins on [lo, hi] (last bin
    closed), checked against the edges lo + i * (hi - lo) / n_bins."""
    step = (hi - lo) / F.lit(float(n_bins))
    guess = F.least(F.greatest(F.floor((x - lo) / step), F.lit(0)), F.lit(n_bins - 1)).cast("int")
    edge = lambda i: F.when(i == n_bins, hi).otherwise(i.cast("double") * step + lo)
    down = F.when((guess > 0) & (x < edge(guess)), guess - 1).otherwise(guess)
    up = F.when((down < n_bins - 1) & (x >= edge(down + 1)), down + 1).otherwise(down)
    return F.when(hi > lo, up).otherwise(F.lit(0))


def with_equal_width_bin(df: DataFrame, x: Column, lo: str, hi: str, n_bins: int) -> DataFrame:
    """``df`` with ``bin`` as :func:`equal_width_bin` gives it, a column a step: as one expression, every step is
    worked out again wherever the next one names it."""
    edge = lambda i: F.when(i == n_bins, F.col(hi)).otherwise(i.cast("double") * F.col("_step") + F.col(lo))
    guess, down, v = F.col("_guess"), F.col("_down"), F.col("_v")
    return (df.withColumn("_v", x).withColumn("_step", (F.col(hi) - F.col(lo)) / F.lit(float(n_bins)))
            .withColumn("_guess", F.least(F.greatest(F.floor((v - F.col(lo)) / F.col("_step")), F.lit(0)), F.lit(n_bins - 1)).cast("int"))
            .withColumn("_down", F.when((guess > 0) & (v < edge(guess)), guess - 1).otherwise(guess))
            .withColumn("_up", F.when((down < n_bins - 1) & (v >= edge(down + 1)), down + 1).otherwise(down))
            .withColumn("bin", F.when(F.col(hi) > F.col(lo), F.col("_up")).otherwise(F.lit(0)))
            .drop("_v", "_step", "_guess", "_down", "_up"))


def score_histogram(df: DataFrame, s: str = "p_default", by: str | None = "default",
                    n_bins: int = 50) -> DataFrame:
    """Equal-width histogram of scores per class over each class's [min, max]:
    class, bin, n, density (count / (total * bin width))."""
    x = F.col(s).cast("double")
    v = df.filter(x.isNotNull() & ~F.isnan(x)).select((F.col(by) if by else F.lit(0)).alias("cls"), x.alias("_x"))
    rng = v.groupBy("cls").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"), F.count(F.lit(1)).alias("_t"))
    j = v.join(rng, on="cls")   # one row per class; Spark broadcasts it if it measures small
    h = (with_equal_width_bin(j, F.col("_x"), "_lo", "_hi", n_bins).groupBy("cls", "bin")
         .agg(F.count(F.lit(1)).alias("n"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"),
              F.first("_t").alias("_t")))
    width = F.when(F.col("_hi") > F.col("_lo"), (F.col("_hi") - F.col("_lo")) / n_bins).otherwise(F.lit(1.0))
    return h.select("cls", "bin", "n", (F.col("n") / (F.col("_t") * width)).alias("density"))


# -------- model-to-model comparison --------------------------------------------

LOWER_IS_BETTER = ("brier", "log_loss")


def compare_metric_rows(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """Long comparison of two one-row metric tables: metric, value_a, value_b,
    delta (b - a) and whether b is better (lower is better for Brier and
    log-loss, higher for the rest)."""
    cols = [c for c in a.columns if c in b.columns]
    stack = lambda df, v: df.selectExpr(
        f"stack({len(cols)}, {', '.join(f'{chr(39)}{c}{chr(39)}, cast(`{c}` as double)' for c in cols)}) as (metric, {v})")
    j = stack(a, f"value_{name_a}").join(stack(b, f"value_{name_b}"), "metric", "inner")
    d = F.col(f"value_{name_b}") - F.col(f"value_{name_a}")
    return j.withColumn("delta", d).withColumn(
        f"{name_b}_better", F.when(F.col("metric").isin(*LOWER_IS_BETTER), d < 0).otherwise(d > 0))


def compare_gains(a: DataFrame, b: DataFrame, name_a: str = "a", name_b: str = "b") -> DataFrame:
    """Decile-by-decile comparison of two gains tables (lift and capture)."""
    sel = lambda df, n: df.select("decile", F.col("lift").alias(f"lift_{n}"),
                                  F.col("cum_capture_rate").alias(f"capture_{n}"))
    j = sel(a, name_a).join(sel(b, name_b), "decile", "inner")
    return j.withColumn("lift_delta", F.col(f"lift_{name_b}") - F.col(f"lift_{name_a}")) \
            .withColumn("capture_delta", F.col(f"capture_{name_b}") - F.col(f"capture_{name_a}"))
