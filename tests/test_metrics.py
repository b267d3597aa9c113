import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import metrics as M
from riskspark.operators.ordered import exact_quantiles, ordered_prefix, quantile_list


def _frame(spark, y, s, ids=None):
    ids = ids if ids is not None else list(range(len(y)))
    return spark.createDataFrame([(int(a), float(b), int(i)) for a, b, i in zip(y, s, ids)],
                                 "default int, p_default double, id bigint")


def brute(y, s):
    y, s = np.asarray(y), np.asarray(s, float)
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    ths = np.unique(s)[::-1]
    ap, prev_r = 0.0, 0.0
    for t in ths:
        tp = ((s >= t) & (y == 1)).sum()
        fp = ((s >= t) & (y == 0)).sum()
        r = tp / len(pos)
        ap += (r - prev_r) * tp / (tp + fp)
        prev_r = r
    ks = max(abs(((pos <= t).sum() / len(pos)) - ((neg <= t).sum() / len(neg))) for t in np.unique(s))
    eps = np.finfo(float).eps
    pc = np.clip(s, eps, 1 - eps)
    ll = -np.mean(y * np.log(pc) + (1 - y) * np.log(1 - pc))
    return auc, ap, ks, np.mean((s - y) ** 2), ll


@pytest.mark.parametrize("seed", [0, 1])
def test_metric_row_matches_brute_force_with_ties(spark, seed):
    rng = np.random.RandomState(seed)
    n = 700
    y = rng.randint(0, 2, n)
    s = np.round(np.clip(0.3 * y + rng.rand(n) * 0.7, 0, 1), 2)       # many ties
    r = M.metric_row(_frame(spark, y, s)).first()
    auc, ap, ks, brier, ll = brute(y, s)
    assert r.roc_auc == pytest.approx(auc, abs=1e-12)
    assert r.pr_auc == pytest.approx(ap, abs=1e-12)
    assert r.ks == pytest.approx(ks, abs=1e-12)
    assert r.brier == pytest.approx(brier, abs=1e-12)
    assert r.log_loss == pytest.approx(ll, abs=1e-12)


def test_separable_and_one_class_and_monotone(spark):
    r = M.metric_row(_frame(spark, [0, 0, 1, 1], [.1, .2, .8, .9])).first()
    assert r.roc_auc == 1.0 and r.ks == 1.0 and r.pr_auc == 1.0
    one = M.rank_metrics(_frame(spark, [1, 1, 1], [.1, .5, .9])).first()
    assert one.roc_auc is None and one.ks is None
    rng = np.random.RandomState(3)
    y, s = rng.randint(0, 2, 300), rng.rand(300)
    a = M.rank_metrics(_frame(spark, y, s)).first()
    b = M.rank_metrics(_frame(spark, y, np.log(s) * 3 + 7)).first()
    assert a.ks == pytest.approx(b.ks) and a.roc_auc == pytest.approx(b.roc_auc) and 0 <= a.ks <= 1


def test_prefix_many_buckets_equals_cumsum(spark):
    rng = np.random.RandomState(5)
    v = rng.randint(0, 5, 400).astype(float)
    df = spark.createDataFrame([(float(i), float(x)) for i, x in enumerate(v)], "k double, v double")
    out = ordered_prefix(df, "k", {"v": "v"}, n_buckets=7).orderBy("k").collect()
    assert [r.cum_v for r in out] == list(np.cumsum(v))
    out_d = ordered_prefix(df, "k", {"v": "v"}, descending=True, n_buckets=5).orderBy(F.desc("k")).collect()
    assert [r.cum_v for r in out_d] == list(np.cumsum(v[::-1]))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.RandomState(7)
    x = np.round(rng.rand(501) * 10, 1)        # repeated values
    df = spark.createDataFrame([(float(a),) for a in x], "x double")
    probs = [float(q) for q in np.linspace(0, 1, 11)]
    got = quantile_list(df, "x", probs, n_buckets=6)
    assert got == [float(v) for v in np.quantile(x, probs)]
    grouped = exact_quantiles(df.withColumn("g", (F.col("x") > 5).cast("int")), "x", [0.5], by=["g"]).collect()
    for r in grouped:
        sub = x[x > 5] if r.g == 1 else x[x <= 5]
        assert r.quantile == pytest.approx(np.quantile(sub, 0.5), abs=1e-12)


def naive_cost(y, s, w, c_fn=5.0, c_fp=1.0):
    rows = []
    for t in np.linspace(0.01, 0.99, 99):
        pred = s >= t
        fn, fp, tp = w[~pred & (y == 1)].sum(), w[pred & (y == 0)].sum(), w[pred & (y == 1)].sum()
        rows.append((t, fn, fp, c_fn * fn + c_fp * fp, tp / (tp + fp) if tp + fp > 0 else 0.0,
                     tp / w[y == 1].sum() if w[y == 1].sum() > 0 else 0.0))
    return rows


def test_cost_curve_matches_scan_and_weights(spark):
    rng = np.random.RandomState(11)
    y, s = rng.randint(0, 2, 400), np.round(rng.rand(400), 2)
    w = rng.rand(400) * 100
    df = spark.createDataFrame([(int(a), float(b), float(c)) for a, b, c in zip(y, s, w)],
                               "default int, p_default double, w double")
    got = sorted(tuple(r) for r in M.cost_curve(df).collect())
    exp = naive_cost(y, s, np.ones(400))
    for g, e in zip(got, exp):
        assert g == pytest.approx(e, abs=1e-9)
    gw = sorted(tuple(r) for r in M.cost_curve(df, weight="w").collect())
    for g, e in zip(gw, naive_cost(y, s, w)):
        assert g == pytest.approx(e, rel=1e-9, abs=1e-9)
    g2 = sorted(tuple(r) for r in M.cost_curve(df.withColumn("w2", F.col("w") * 2), weight="w2").collect())
    assert [a[3] * 2 for a in gw] == pytest.approx([b[3] for b in g2])
    # a higher false-negative cost never raises the optimal threshold
    t5 = M.optimal_threshold(M.cost_curve(df, c_fn=5)).first().threshold
    t10 = M.optimal_threshold(M.cost_curve(df, c_fn=10)).first().threshold
    assert t10 <= t5


def test_psi_properties(spark):
    rng = np.random.RandomState(2)
    a = rng.rand(1000)
    e = spark.createDataFrame([(float(x),) for x in a], "p double")
    assert M.psi(e, "p", e, "p").first().psi == pytest.approx(0.0, abs=1e-12)
    sh1 = spark.createDataFrame([(float(min(x + 0.05, 1)),) for x in a], "p double")
    sh2 = spark.createDataFrame([(float(min(x + 0.2, 1)),) for x in a], "p double")
    p1, p2 = M.psi(e, "p", sh1, "p").first().psi, M.psi(e, "p", sh2, "p").first().psi
    assert 0 < p1 < p2
    # numpy reference: quantile edges, outer +-inf, floored shares
    edges = np.quantile(a, np.linspace(0, 1, 11)); edges[0], edges[-1] = -np.inf, np.inf
    b = np.minimum(a + 0.2, 1)
    ep = np.maximum(np.histogram(a, edges)[0] / 1000, 1e-6)
    ap = np.maximum(np.histogram(b, edges)[0] / 1000, 1e-6)
    assert p2 == pytest.approx(float(np.sum((ap - ep) * np.log(ap / ep))), abs=1e-12)


@pytest.mark.parametrize("n", [10, 12, 37, 100, 333])
def test_decile_rule_equals_qcut(spark, n):
    labels = pd.qcut(pd.RangeIndex(n), 10, labels=range(1, 11)).astype(int)
    df = spark.range(n).select(F.col("id").alias("r"))
    got = [r[0] for r in df.orderBy("r").select(M._decile_of(F.col("r"), F.lit(n), 10)).collect()]
    assert got == list(labels)


def test_gains_table_against_pandas(spark):
    rng = np.random.RandomState(9)
    n = 1000
    y = rng.randint(0, 2, n)
    s = np.round(rng.rand(n), 1)              # heavy ties straddling decile edges
    ids = rng.permutation(n)
    df = _frame(spark, y, s, ids)
    got = M.gains_table(df, id_col="id").orderBy("decile").collect()
    pdf = pd.DataFrame({"y": y, "s": s, "id": ids}).sort_values(["s", "id"], ascending=[False, True]).reset_index(drop=True)
    pdf["decile"] = pd.qcut(pdf.index, 10, labels=range(1, 11)).astype(int)
    g = pdf.groupby("decile").agg(n=("y", "size"), d=("y", "sum"), smin=("s", "min"), smax=("s", "max"))
    assert [r.n for r in got] == list(g.n)
    assert [r.n_defaults for r in got] == list(g.d)
    assert [r.score_min for r in got] == list(g.smin)
    assert got[-1].cum_capture_rate == pytest.approx(1.0)
    assert got[0].lift > 0


def test_reliability_and_groups(spark):
    rng = np.random.RandomState(4)
    n = 600
    s = rng.rand(n)
    y = (rng.rand(n) < s).astype(int)
    df = _frame(spark, y, s).withColumn("g", (F.col("id") % 3).cast("string"))
    rel = M.reliability_table(df).orderBy("bin").collect()
    edges = np.percentile(s, np.linspace(0, 1, 21) * 100)
    ids = np.searchsorted(edges[1:-1], s)
    assert [r.n for r in rel] == [int((ids == b).sum()) for b in sorted(set(ids))]
    grp = M.metrics_by_group(df, group="g", min_rows=201).collect()
    assert grp == []                                             # every group has 200 rows
    grp = M.metrics_by_group(df, group="g", min_rows=100).collect()
    assert [r.g for r in grp] == ["0", "1", "2"]
