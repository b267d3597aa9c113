"""Boosted trees: split search by brute force, partitions, resumed stages, saved models; the trial ledger."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from riskspark.operators import boosting as B
from riskspark.operators import tuning as T
from riskspark.operators.calibration import CalibratedModel, fit_calibrated

FEATURES = ["dti", "int_rate", "grade"]


@pytest.fixture(scope="module")
def loans(spark):
    rng = np.random.default_rng(4)
    n = 900
    dti, rate = rng.normal(15, 5, n), rng.normal(12, 3, n)
    grade = rng.choice(list("ABC"), n)
    p = 1 / (1 + np.exp(-(0.3 * (dti - 15) + 0.5 * (grade == "C") - 1)))
    pdf = pd.DataFrame({"loan_id": range(n), "issue_year": rng.integers(2010, 2015, n), "default": (rng.random(n) < p).astype(int),
                        "dti": np.where(rng.random(n) < 0.1, np.nan, dti), "int_rate": rate, "grade": np.where(rng.random(n) < 0.05, None, grade)})
    return spark.createDataFrame(pdf).withColumn("dti", F.nanvl("dti", F.lit(None))).repartition(5).cache()


def same(a, b):
    return len(a) == len(b) and all((x.feature == y.feature).all() and np.allclose(x.value, y.value) for x, y in zip(a, b))


def test_best_split_is_brute_force():
    rng = np.random.default_rng(1)
    for _ in range(20):
        n, bins = 40, 5
        codes, g, h = rng.integers(0, bins, (n, 3)), rng.normal(size=n), rng.random(n)
        sums = np.zeros((1, 3, bins, 2))
        for i in range(n):
            for f in range(3):
                sums[0, f, codes[i, f]] += (g[i], h[i])
        score = lambda m: g[m].sum() ** 2 / (h[m].sum() + 1.0)
        best = 0.0
        for f in range(3):
            for b in range(1, bins):
                for missing in (False, True):
                    left = (codes[:, f] <= b) & ((codes[:, f] > 0) | missing)
                    if min(h[left].sum(), h[~left].sum()) >= 2.0:
                        best = max(best, 0.5 * (score(left) + score(~left) - score(np.ones(n, bool))) - 0.01)
        got = B.best_splits(sums, 1.0, 0.01, 2.0)[0]
        assert got[0] == pytest.approx(best) if best else got is None


def test_partitions_give_the_same_trees(spark, loans, monkeypatch):
    one = B.fit_boosted(loans, FEATURES, params={"n_estimators": 3}).trees
    monkeypatch.setattr(B, "ROWS_PER_PARTITION", 200)
    monkeypatch.setattr(B, "FLAT_MERGE", 2)
    assert same(one, B.fit_boosted(loans, FEATURES, params={"n_estimators": 3}).trees)


def test_rows_go_to_as_many_tasks_as_can_run(spark, loans, monkeypatch):
    one = B.fit_boosted(loans, FEATURES, params={"n_estimators": 3}).trees
    monkeypatch.setattr(B, "ROWS_PER_PARTITION", 800)
    monkeypatch.setattr(B, "LEAST_ROWS", 100)
    spark.sparkContext.setJobGroup("dealt", "")
    try:
        many = B.fit_boosted(loans, FEATURES, params={"n_estimators": 3}).trees
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    last = [max(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("dealt")]
    tasks = [tracker.getStageInfo(i).numTasks for i in last]
    assert same(one, many) and tasks.count(4) >= 3 * 3  # a level is a job of four tasks, not two


def test_levels_take_the_margins_from_the_blocks(spark):
    rng = np.random.default_rng(3)
    block = {"codes": rng.integers(0, 5, (50, 2)).astype(np.uint8), "y": rng.integers(0, 2, 50).astype(float), "w": np.ones(50),
             "key": rng.integers(0, 2**60, 50), "margin": np.zeros(50)}
    tree = B.Tree.empty(1)
    tree.feature[0], tree.bin[0], tree.value[1], tree.value[2] = 1, 2, 0.5, -0.25
    held = B.following(spark.sparkContext.parallelize([block], 1), tree)
    margin = np.where(block["codes"][:, 1] == 0, -0.25, np.where(block["codes"][:, 1] <= 2, 0.5, -0.25))
    assert np.allclose(held.collect()[0]["margin"], margin) and held.is_cached
    sums = held.map(lambda b: B.level_sums(b, B.Tree.empty(1), 0, [0, 1], 6, 1, 0, 1.0)).collect()[0]
    g = 1 / (1 + np.exp(-margin)) - block["y"]
    for f in (0, 1):
        assert np.allclose(sums[0, f, :, 0], np.bincount(block["codes"][:, f], g, 6))
    held.unpersist()


def side_by_side(monkeypatch, rows_per_partition=400, least=100):
    for name, value in (("ROWS_PER_PARTITION", rows_per_partition), ("LEAST_ROWS", least), ("TOGETHER_LEAST", 1), ("CHUNK", 70)):
        monkeypatch.setattr(B, name, value)


def test_tasks_side_by_side_grow_a_stage_in_one_job(spark, loans, monkeypatch, tmp_path):
    """A stage of rounds is one job, whatever the levels, and gives the trees of a table of one partition."""
    params = {"n_estimators": 6, "max_depth": 4}
    one = B.fit_boosted(loans, FEATURES, params=params).trees
    side_by_side(monkeypatch)
    spark.sparkContext.setJobGroup("together", "")
    try:
        many = B.fit_boosted(loans, FEATURES, params=params, store=str(tmp_path / "fit")).trees
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    last = [max(tracker.getJobInfo(j).stageIds) for j in tracker.getJobIdsForGroup("together")]
    assert same(one, many) and all((a.bin == b.bin).all() and (a.missing_left == b.missing_left).all() for a, b in zip(one, many))
    assert [tracker.getStageInfo(i).numTasks for i in last].count(4) < 6  # before, 24 levels were as many jobs
    assert not list((tmp_path / "fit" / "sums").iterdir())  # what the tasks gave each other


def test_tasks_side_by_side_resume_and_may_have_no_rows(spark, loans, monkeypatch, tmp_path):
    side_by_side(monkeypatch)
    monkeypatch.setattr(B, "STAGE", 4)
    whole = B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "whole"))
    B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "parts"), stop_after=4)
    again = B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "parts"))
    assert len(again.trees) == 10 and same(whole.trees, again.trees)
    two = spark.createDataFrame([(i % 2, float(i % 2), 1.0, "A") for i in range(800)], "default int, dti double, int_rate double, grade string")
    tree = B.fit_boosted(two, FEATURES, params={"n_estimators": 1, "subsample": 1.0, "colsample_bytree": 1.0}).trees[0]  # all rows in two partitions
    assert tree.feature[0] == 0 and (tree.feature[1:] < 0).all() and tree.value[1] < 0 < tree.value[2]


def test_level_job_where_tasks_cannot_meet(spark, loans, monkeypatch):
    one = B.fit_boosted(loans, FEATURES, params={"n_estimators": 2}).trees
    side_by_side(monkeypatch)
    monkeypatch.setattr(B, "slots", lambda sc: 1)
    monkeypatch.setattr(B, "stage_together", None)
    assert same(one, B.fit_boosted(loans, FEATURES, params={"n_estimators": 2}).trees)
    monkeypatch.setattr(B, "slots", lambda sc: 4)
    monkeypatch.setattr(B, "local_path", lambda spark, path: None)
    assert same(one, B.fit_boosted(loans, FEATURES, params={"n_estimators": 2}).trees)


def test_sums_do_not_depend_on_the_dealing():
    """Sums in units are exact: those of a node's child by subtraction are those that its rows add up to."""
    rng = np.random.default_rng(8)
    n = 500
    block = {"codes": rng.integers(0, 6, (n, 3)).astype(np.uint8), "y": rng.integers(0, 2, n).astype(float), "w": rng.random(n) * 3,
             "key": rng.integers(0, 2**60, n), "margin": rng.normal(size=n)}
    unit, features = B.unit_of(n, 3.0), [0, 2]

    def levels(chunks):
        got = []
        for c in chunks:
            c.begin(1, 0, 0.8, unit)
        sums_at = B.level_by_level(chunks, features, lambda own, level: own, unit)
        tree = B.grown(lambda t, level: got.append(sums_at(t, level)) or got[-1], features, {**B.DEFAULT_PARAMS, "min_child_weight": 0.5})
        return got, tree

    (got, tree), (again, other) = (levels([B.Chunk(block, slice(i, i + k)) for i in range(0, n, k)]) for k in (n, 37))
    assert len(got) == 6 and all((a == b).all() for a, b in zip(got, again)) and same([tree], [other])
    codes, g, h = B.gradients(block, 1, 0, 0.8)
    for level, sums in enumerate(got):
        upper = B.Tree.empty(6)
        for name in ("feature", "bin", "missing_left"):
            getattr(upper, name)[:2 ** level - 1] = getattr(tree, name)[:2 ** level - 1]
        plain = B.node_sums(codes, g, h, upper.nodes(codes), level, features, B.BINS + 1)
        assert np.allclose(sums, plain, rtol=0, atol=1e-9)
        assert (sums[plain == 0] == 0).all()  # no rest where no rows are


def test_nodes_row_by_row(spark, loans):
    model = B.fit_boosted(loans, FEATURES, params={"n_estimators": 3, "max_depth": 4})
    codes = np.random.default_rng(2).integers(0, B.BINS + 1, (300, 3)).astype(np.uint8)
    margin = np.zeros(len(codes))
    for t in model.trees:
        for i, row in enumerate(codes):
            at = 0
            while t.feature[at] >= 0:
                b = row[t.feature[at]]
                at = 2 * at + 2 - int(t.missing_left[at] if b == 0 else b <= t.bin[at])
            margin[i] += t.value[at]
    assert (model.margins(codes) == margin).all()


def test_fit_resumes_where_it_stopped(spark, loans, tmp_path, monkeypatch):
    monkeypatch.setattr(B, "STAGE", 4)
    whole = B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "whole"))
    B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "parts"), stop_after=4)
    again = B.fit_boosted(loans, FEATURES, params={"n_estimators": 10}, store=str(tmp_path / "parts"))
    assert len(again.trees) == 10 and same(whole.trees, again.trees)
    read = B.read_trees(spark, str(tmp_path / "parts" / "stage-00008"))
    assert same(read, again.trees[8:])


def test_model_learns_scores_and_is_saved(spark, loans, tmp_path):
    model = fit_calibrated(loans.filter("issue_year < 2014"), loans.filter("issue_year = 2014"),
                           lambda df: B.fit_boosted(df, FEATURES, params={"n_estimators": 40, "max_depth": 3}))
    assert model.base.importance(spark).first()["feature"] == "dti"
    model.save(str(tmp_path / "m"))
    back = CalibratedModel.load(str(tmp_path / "m"))
    score = lambda m: [r[0] for r in m.score(loans).orderBy("loan_id").select("p_default").collect()]
    assert score(model) == score(back)
    from riskspark.operators.metrics import rank_metrics
    assert rank_metrics(model.score(loans), "default", "p_default").first()["roc_auc"] > 0.75


def test_one_class_and_unknown_levels(spark, loans):
    assert B.fit_boosted(loans.filter("default = 0"), FEATURES).trees == []
    model = B.fit_boosted(loans, FEATURES, params={"n_estimators": 2})
    odd = spark.createDataFrame([(None, float("nan"), "Z"), (1e9, -1e9, None)], "dti double, int_rate double, grade string")
    assert all(0 < r.p_raw < 1 for r in model.score_raw(odd).collect())


def test_ledger_runs_only_what_is_missing(spark, loans, tmp_path):
    ran = []

    class Scorer:
        def score_raw(self, df):
            return df.withColumn("p_raw", F.coalesce("dti", F.lit(0.0)))

    def fit(train, params):
        ran.append(params)
        return Scorer()

    ask = lambda n=None: T.random_search(loans, [], n_trials=3, fit=fit, ledger=str(tmp_path), at_most=n, subsample_frac=0.5)
    first = ask(3)
    assert len(ran) == 3 and [r.trial for r in first.filter("mean_auc is not null").collect()] == [0]
    whole = ask().collect()
    assert len(ran) == 6 and [r.place for r in whole] == [1, 2, 3]
    assert ask().collect() == whole and len(ran) == 6
    assert T.best_params(ask())["max_depth"] == T.sample_trials(3)[0]["max_depth"]  # equal scores: the first trial


def test_sample_is_the_smallest_hashes(spark, monkeypatch):
    monkeypatch.setattr(T, "BORDER_ROWS", 3)
    df = spark.range(5000).withColumnRenamed("id", "loan_id")
    got = {r.loan_id for r in T.exact_sample(df, 0.3, seed=7).collect()}
    import hashlib
    order = sorted(range(5000), key=lambda i: hashlib.md5(f"7:{i}".encode()).hexdigest()[:15])
    assert got == set(order[:1500])
    assert T.exact_sample(df, 1.0).count() == 5000 and T.exact_sample(df, 0.0).count() == 0 and T.exact_sample(df.limit(0), 0.5).count() == 0
    plan = T.exact_sample(df, 0.3)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_resumed_search_reads_its_folds(spark, tmp_path, monkeypatch):
    """Folds are made once a search, found by the rows they are made of, and hold what they held."""
    rows = [(i, 2000 + i % 5, int(i % 3 == 0), float(i * 7 % 50)) for i in range(300)]
    loans = spark.createDataFrame(rows, "loan_id long, issue_year int, default int, x double")
    made, plain = [], T.time_series_folds
    monkeypatch.setattr(T, "time_series_folds", lambda *a, **k: made.append(1) or plain(*a, **k))
    ask = lambda df: T.stored_folds(df, str(tmp_path), 2, 0.5, "loan_id", 42)
    first = sorted(ask(loans).collect())
    assert sorted(ask(loans.repartition(3)).collect()) == first and len(made) == 1
    assert first == sorted(plain(T.exact_sample(loans, 0.5, "loan_id", 42), 2).select(*ask(loans).columns).collect())
    ask(loans.withColumn("x", F.col("x") + 1))
    assert len(made) == 2
    folds = ask(loans)
    starts = T.fold_starts(folds)
    for fold in (0, 1):
        train, test = T.fold_frames(folds, fold, starts)
        assert train.agg(F.max("pos")).first()[0] + 1 == starts[fold] == test.agg(F.min("pos")).first()[0]


@pytest.mark.parametrize("name", ["gbt_calibrated_metrics", "gbt_feature_importance", "recalibration_report", "gbt_batch_scoring"])
def test_queries_write_their_loans_once(spark, monkeypatch, name):
    from riskspark.plans import extra as X
    from riskspark.plans.catalog import queries
    from riskspark.schema import CATEGORICAL_COLS, CLEAN_FEATURES_V2
    rng = np.random.default_rng(6)
    n, made = 400, []
    pdf = pd.DataFrame({c: rng.choice(list("ABCD"), n) if c in CATEGORICAL_COLS else rng.random(n).round(2) + 1 for c in CLEAN_FEATURES_V2})
    pdf = pdf.assign(default=rng.integers(0, 2, n), issue_year=1997 + np.arange(n) % 5, application_id=[str(i) for i in range(n)], not_read=1)
    whole = spark.createDataFrame(pdf)

    def table(spark, d, *cols):
        made.append(cols)
        return whole.select(*cols) if cols else whole

    monkeypatch.setattr(X.TB, "scored_table", table)
    monkeypatch.setattr(X, "fit_boosted", lambda df, features, store: B.fit_boosted(df, features, params={"n_estimators": 2}, store=store))
    rows = queries()[name](spark, "")
    assert len(made) == 1 and made[0] and "not_read" not in made[0]  # before: twice, with all columns
    got = rows.collect()
    tested = int((pdf["issue_year"] >= 2000).sum())
    if name == "gbt_batch_scoring":
        assert got[0]["n_rows"] == tested
    elif name == "recalibration_report":
        assert [r["n"] for r in got] == [int((pdf["issue_year"] > 2000).sum())] * 2
    else:
        assert got
