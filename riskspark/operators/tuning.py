"""Time-aware hyper-parameter search.

Folds are expanding windows in chronological order (issue year, then id):
with k splits, ``test_size = n // (k + 1)`` and fold i tests on block i of
the last k blocks while training on everything before it. Row positions come
from the distributed rank helper, never from a single-task window.

Each trial's fits are ordinary distributed Spark ML jobs; trials run from the
driver in a small thread pool so independent fits overlap.
"""

from __future__ import annotations

import itertools
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.operators.metrics import rank_metrics
from riskspark.operators.ordered import materialize, row_rank
from riskspark.schema import CV_FOLDS, DEFAULT_PARAMS, N_TRIALS, RANDOM_STATE, SEARCH_SPACE, SUBSAMPLE_FRAC, TARGET


def time_series_folds(df: DataFrame, n_splits: int = CV_FOLDS,
                      order: tuple[str, str] = ("issue_year", "loan_id"), checkpoint: bool = True) -> DataFrame:
    """Append ``pos`` (0-based chronological position), ``n`` and ``test_fold``
    (the fold whose test block holds the row, NULL if none)."""
    lead, rid = order
    ranked = row_rank(df, lead, rid, checkpoint=checkpoint)
    n = df.count()
    ts = n // (n_splits + 1)
    first = n - n_splits * ts
    fold = ((F.col("pos") - first) / F.lit(max(ts, 1))).cast("int")
    return (ranked.withColumnRenamed("rank", "pos").withColumn("n", F.lit(n))
            .withColumn("test_fold", F.when(F.col("pos") >= first, fold.cast("int"))))


def fold_starts(folded: DataFrame) -> dict[int, int]:
    """First position of every test fold."""
    rows = folded.filter(F.col("test_fold").isNotNull()).groupBy("test_fold").agg(F.min("pos").alias("start")).collect()
    return {r["test_fold"]: r["start"] for r in rows}  # a row a fold


def fold_frames(folded: DataFrame, fold: int, starts: dict[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """(train, test) of one expanding fold; ``starts``: ``fold_starts``, if they are known."""
    test = folded.filter(F.col("test_fold") == fold)
    start = (fold_starts(folded) if starts is None else starts).get(fold)
    train = folded.filter(F.col("pos") < F.lit(start))
    return train, test


#: Rows of a border bucket that are few enough to be ordered.
BORDER_ROWS = 100_000


def sample_hash(id_col: str, seed: int) -> Column:
    """15 hexadecimal digits that order the rows of a seeded sample."""
    return F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string"))), 1, 15)


def exact_sample(df: DataFrame, fraction: float, id_col: str = "loan_id", seed: int = RANDOM_STATE) -> DataFrame:
    """Exactly ``int(n * fraction)`` rows: those with the smallest seeded hashes of the id.

    No row is ranked. Rows are counted by the first digits of their hash; all in buckets below the one that holds
    the k-th are taken, and the border bucket is counted by further digits until it is small enough to be
    ordered. A pass gives 4,096 counts at most. Rows without an id are ordered last."""
    h = F.coalesce(sample_hash(id_col, seed), F.lit("g"))
    hashed = df.withColumn("_h", h)
    rest, border = None, hashed
    digits = 0
    while True:
        digits += 3
        counts = sorted(border.groupBy(F.substring("_h", 1, digits).alias("b")).count().collect())
        if rest is None:
            rest = int(sum(c for _, c in counts) * fraction)
        taken = 0
        for bucket, c in counts:
            if taken + c > rest:
                break
            taken += c
        else:
            bucket, c = None, 0
        rest -= taken
        if bucket is None or not rest or c <= BORDER_ROWS or digits >= 15:
            break
        border = hashed.filter(F.substring("_h", 1, digits) == bucket)
    if bucket is None:  # all rows
        return df
    whole = hashed.filter(F.substring("_h", 1, digits) < bucket)
    edge = hashed.filter(F.substring("_h", 1, digits) == bucket).orderBy("_h", id_col).limit(rest)
    return whole.unionByName(edge).drop("_h")


def parameter_grid(space: dict = SEARCH_SPACE) -> list[dict]:
    keys = sorted(space)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[space[k] for k in keys])]


def sample_trials(n_trials: int = N_TRIALS, space: dict = SEARCH_SPACE, seed: int = RANDOM_STATE) -> list[dict]:
    """Trial 0 = the defaults, then n_trials - 1 distinct grid points (seeded)."""
    grid = parameter_grid(space)
    rng = np.random.RandomState(seed)
    picks = rng.choice(len(grid), size=min(n_trials - 1, len(grid)), replace=False)
    return [dict(DEFAULT_PARAMS)] + [grid[i] for i in picks]


_LEDGER = ", ".join(["trial int", "fold int", *(f"{k} double" for k in sorted(SEARCH_SPACE)), "roc_auc double", "is_default boolean"])


class TrialLedger:
    """Finished fits of a search, one folder a (trial, fold) under ``path``.

    A finished fit is written at once and never again: a search that was ended goes on with what an anti join of
    its plan and the ledger leaves, in this session or another. A fit that was written twice (by two drivers)
    overwrites itself. Parameters are part of what is compared, so trials of another plan are not taken for done."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def rows(self) -> DataFrame:
        """(trial, fold, parameters, roc_auc, is_default) of what is finished."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], _LEDGER)
        return self.spark.read.schema(_LEDGER).option("recursiveFileLookup", "true").parquet(self.path)

    def plan(self, trials: list[dict], folds: int) -> DataFrame:
        keys = sorted(SEARCH_SPACE)
        rows = [(i, f, *[float(t[k]) for k in keys], None, i == 0) for i, t in enumerate(trials) for f in range(folds)]
        return self.spark.createDataFrame(rows, _LEDGER)

    def missing(self, trials: list[dict], folds: int) -> list[tuple[int, int]]:
        """(trial, fold) of the plan that are not in the ledger, in order."""
        on = ["trial", "fold", *sorted(SEARCH_SPACE)]
        left = self.plan(trials, folds).join(self.rows().select(*on), on, "left_anti")
        return [(r["trial"], r["fold"]) for r in left.orderBy("trial", "fold").collect()]

    def add(self, trial: int, fold: int, params: dict, roc_auc: float | None) -> None:
        row = (trial, fold, *[float(params[k]) for k in sorted(SEARCH_SPACE)], roc_auc, trial == 0)
        (self.spark.createDataFrame([row], _LEDGER).coalesce(1).write.mode("overwrite")
         .parquet(f"{self.path}/fit-{trial:04d}-{fold:02d}"))


def trial_results(fits: DataFrame, folds: int) -> DataFrame:
    """Trial table of a ledger's rows, best first: trial, parameters, mean_auc, std_auc (population), is_default,
    place. Trials whose folds are not all finished, or with a fold without both classes, have no mean and come last."""
    keys = sorted(SEARCH_SPACE)
    whole = F.count("roc_auc") == folds
    table = fits.groupBy("trial", *keys, "is_default").agg(
        F.when(whole, F.avg("roc_auc")).alias("mean_auc"), F.when(whole, F.stddev_pop("roc_auc")).alias("std_auc"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("mean_auc").desc_nulls_last(), "trial")  # as many rows as trials
    return (table.withColumn("place", F.row_number().over(order))
            .select("trial", *keys, "mean_auc", "std_auc", "is_default", "place").orderBy("place"))


def best_and_worst(results: DataFrame, best: int = 5, worst: int = 3) -> DataFrame:
    """The ``best`` and the ``worst`` ranked trials, with ``end`` saying which."""
    ranked = results.filter(F.col("mean_auc").isNotNull())
    top = ranked.orderBy("place").limit(best).withColumn("end", F.lit("best"))
    return top.unionByName(ranked.orderBy(F.desc("place")).limit(worst).withColumn("end", F.lit("worst")))


def stored_folds(df: DataFrame, folder: str, cv_folds: int, fraction: float, id_col: str, seed: int) -> DataFrame:
    """``time_series_folds`` of the seeded sample, written once in ``folder``: a search that goes on reads them. They are
    named by what they are made of, so other rows get folds of their own."""
    from riskspark.operators.boosting import exists
    spark = df.sparkSession
    h = F.xxhash64(*df.columns)
    facts = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(h).alias("x"), F.sum(F.shiftright(h, 32)).alias("s")).first()
    path = f"{folder}/folds-{cv_folds}-{fraction}-{seed}-{facts['n']}-{facts['x']}-{facts['s']}"
    if not exists(spark, path):
        sample = materialize(exact_sample(df, fraction, id_col, seed)) if fraction < 1 else df
        time_series_folds(sample, cv_folds, ("issue_year", id_col)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def random_search(df: DataFrame, features: list[str], n_trials: int = N_TRIALS, cv_folds: int = CV_FOLDS,
                  subsample_frac: float = SUBSAMPLE_FRAC, seed: int = RANDOM_STATE, y: str = TARGET,
                  id_col: str = "loan_id", parallelism: int = 2, fit=None, ledger: str | None = None,
                  at_most: int | None = None) -> DataFrame:
    """The trial table of a seeded random search (``trial_results``).

    Each finished fit goes to the ledger in folder ``ledger`` (default: one of its own in the checkpoint
    folder); a call runs the fits that the ledger lacks, ``at_most`` so many, so a search may be spread over several runs.
    The folds stand there too, and are not made again. A boosted fit keeps its stages beside the ledger and goes on with them. ``fit(train, params)`` gives a model or a
    scorer with ``score_raw``."""
    import uuid
    from riskspark.operators.boosting import fit_boosted
    from riskspark.operators.calibration import CalibratedModel
    from riskspark.session import ensure_checkpoint_dir
    spark = df.sparkSession
    ledger = ledger or f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledger-{uuid.uuid4().hex}"
    book = TrialLedger(spark, f"{ledger}/fits")
    trials = sample_trials(n_trials, seed=seed)
    todo = book.missing(trials, cv_folds)[:at_most]
    if todo:
        folded = stored_folds(df, ledger.rstrip("/"), cv_folds, subsample_frac, id_col, seed)
        starts = fold_starts(folded)

        def run(which: tuple[int, int]) -> None:
            trial, fold = which
            train, test = fold_frames(folded, fold, starts)
            if fit:
                model = fit(train, trials[trial])
            else:
                model = fit_boosted(train, features, y, trials[trial], seed, store=f"{ledger}/stages/{trial}-{fold}")
            scored = CalibratedModel(model, None).score(test)
            book.add(trial, fold, trials[trial], rank_metrics(scored, y, "p_default").first()["roc_auc"])

        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            list(pool.map(run, todo))
    return trial_results(book.rows(), cv_folds)


def best_params(results: DataFrame) -> dict:
    """Parameters of the best trial (bookkeeping columns stripped)."""
    r = results.orderBy(F.col("mean_auc").desc_nulls_last(), "trial").first().asDict()
    return {k: (int(r[k]) if k in ("max_depth", "n_estimators", "min_child_weight") else r[k]) for k in SEARCH_SPACE}
