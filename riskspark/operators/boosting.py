"""Boosted trees by second-order gradients over binned features, fitted in resumable stages.

Features are binned once: numeric columns at quantiles, categorical levels in the order of their
default rate, bin 0 for what is missing or unknown. The binned rows are written as one narrow table
(label, weight, key, one byte a feature) and read from there by every pass.

Every task adds up gradients and hessians by (node, feature, bin) over its rows, the sums are merged, and the best
split of each node is read from them; a leaf's value follows from its parent's sums. What a task sends for a level is
bounded by nodes x features x bins, whatever the number of rows. There are three ways to merge:

- a table of one partition has nothing to merge: one job grows a stage of trees;
- where all tasks can run at once, with ``TOGETHER_ROWS`` rows each at most, and the fit's folder is a (shared) file
  system's, one barrier job grows a stage. Its tasks hold their rows, give each other their sums as files in that folder
  (Spark's own ``allGather`` waits a second each time) and read the same splits from them. Gradients are whole
  multiples of a unit in which no sum is rounded, so that the sums don't depend on how the rows are
  dealt, and those of one child of a node are its parent's without the other's;
- otherwise each level of a tree is one Spark job, merged by a tree reduce. The rows are kept with their margins, which
  the first job of a round moves on by the last tree, so that no job works a finished tree out again.

The rows are dealt to as many tasks as can run at once.
A round draws its rows by a hash of their key, so a recomputed task draws the same ones.

After each ``STAGE`` rounds the new trees are appended to the fit's folder. A fit that is called again on that
folder (after a lost driver, say) reads the trees, works the margins out again in one pass, and goes on with
the next round; the trees are the same as those of a fit that ran through.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import os
import shutil
import time
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext, SparkContext, StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.operators.models import WEIGHT, split_features, with_class_weight
from riskspark.schema import DEFAULT_PARAMS, TARGET

#: Bins of a feature at most, without the one for missing values.
BINS = 64
#: Codes of a feature.
CODES = BINS + 1
#: Rounds between two writes of the trees.
STAGE = 20
#: Rows of a partition of the binned table at most (about).
ROWS_PER_PARTITION = 250_000
#: Rows of a partition below which more tasks don't shorten a job.
LEAST_ROWS = 25_000
#: Partitions beyond which the sums are merged in two steps, and tasks at most that give each other their sums.
FLAT_MERGE = 16
#: Rows of a table from which, and of a task up to which, tasks stay for a whole stage.
TOGETHER_LEAST, TOGETHER_ROWS = 100_000, 1_500_000
#: Seconds that such a task waits for the sums of another one.
PATIENCE = 900
#: Rows that such a task works on at a time, few enough for a core's cache.
CHUNK = 32_768


@dataclass
class Binning:
    """How raw columns become bins: cut points of numeric columns, bins of levels."""
    numeric: dict[str, list[float]]
    levels: dict[str, dict[str, int]]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.levels]

    def codes(self, pdf: pd.DataFrame) -> np.ndarray:
        out = np.zeros((len(pdf), len(self.features)), np.uint8)
        for j, c in enumerate(self.numeric):
            x = pd.to_numeric(pdf[c]).to_numpy(np.float64, na_value=np.nan)
            out[:, j] = np.where(np.isnan(x), 0, 1 + np.searchsorted(self.numeric[c], x, side="left"))
        for j, c in enumerate(self.levels, len(self.numeric)):
            out[:, j] = pdf[c].map(self.levels[c]).fillna(0).to_numpy(np.uint8)
        return out


def fit_binning(df: DataFrame, features: list[str], y: str = TARGET, bins: int = BINS) -> Binning:
    """Cut points from one aggregate over all numeric columns; levels by rising default rate, the
    ``bins`` most frequent of each column."""
    nums, cats = split_features(features)
    numeric: dict[str, list[float]] = {}
    if nums:
        probs = [i / bins for i in range(1, bins)]
        row = df.agg(*[F.percentile_approx(F.nanvl(F.col(c).cast("double"), F.lit(None)), probs, 100 * bins).alias(c) for c in nums]).first()
        numeric = {c: sorted(set(row[c] or [])) for c in nums}
    levels: dict[str, dict[str, int]] = {}
    for c in cats:  # at most ``bins`` rows a column
        top = (df.filter(F.col(c).isNotNull()).groupBy(F.col(c).alias("level"))
               .agg(F.count(F.lit(1)).alias("n"), F.avg(F.col(y).cast("double")).alias("rate"))
               .orderBy(F.desc("n"), "level").limit(bins).collect())
        ranked = sorted(top, key=lambda r: (r["rate"], r["level"]))
        levels[c] = {r["level"]: i + 1 for i, r in enumerate(ranked)}
    return Binning(numeric, levels)


@dataclass
class Tree:
    """A binary tree laid out by levels: node i has children 2i + 1 and 2i + 2. ``feature`` is -1 at leaves."""
    feature: np.ndarray
    bin: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = 2 ** (depth + 1) - 1
        return cls(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n, bool), np.zeros(n), np.zeros(n))

    def nodes(self, codes: np.ndarray) -> np.ndarray:
        """The node that each row ends in."""
        return self.ends(codes.ravel(), np.arange(len(codes)) * codes.shape[1])

    def ends(self, flat: np.ndarray, row: np.ndarray) -> np.ndarray:
        """``nodes`` of codes laid end to end, the rows beginning at ``row``."""
        at, steps = np.zeros(len(row), np.intp), self.steps()
        for _ in range((len(self.feature) + 1).bit_length() - 2):
            at = stepped(steps, flat, row, 1, at)
        return at

    def further(self, codes: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The nodes one level below ``at``; rows in a leaf stay there."""
        return stepped(self.steps(), codes.ravel(), np.arange(len(codes)) * codes.shape[1], 1, at)

    def steps(self) -> tuple[np.ndarray, np.ndarray]:
        """Per node the feature it asks for (any, of a leaf), per node and code the node that comes next."""
        node, inner = np.arange(len(self.feature))[:, None], self.feature[:, None] >= 0
        left = np.arange(CODES) <= self.bin[:, None]
        left[:, 0] = self.missing_left
        return np.maximum(self.feature, 0).astype(np.intp), np.where(inner, 2 * node + 2 - left, node).ravel()


def stepped(steps: tuple, flat: np.ndarray, row: np.ndarray, apart: int, at: np.ndarray) -> np.ndarray:
    """The nodes one level below ``at``. A row's code of feature f is ``flat[row + f * apart]``."""
    feature, following = steps
    place = feature.take(at)
    if apart != 1:
        place *= apart
    place += row
    place = at * CODES + flat.take(place)
    return following.take(place)


@dataclass
class BoostedTrees:
    """A fitted ensemble. ``score_raw`` appends ``p_raw``, the probability of a default."""
    binning: Binning
    trees: list[Tree]

    def margins(self, codes: np.ndarray) -> np.ndarray:
        return added(np.zeros(len(codes)), self.trees, codes)

    def score_raw(self, df: DataFrame, output_col: str = "p_raw") -> DataFrame:
        from pyspark.sql.functions import pandas_udf
        model = df.sparkSession.sparkContext.broadcast(self)
        cols = self.binning.features

        @pandas_udf("double")
        def p(pdf: pd.DataFrame) -> pd.Series:
            m = model.value
            return pd.Series(1 / (1 + np.exp(-m.margins(m.binning.codes(pdf)))))

        numeric = [F.col(c).cast("double").alias(c) for c in self.binning.numeric]
        return df.withColumn(output_col, p(F.struct(*numeric, *[F.col(c) for c in cols[len(numeric):]])))

    def importance(self, spark: SparkSession) -> DataFrame:
        """(feature, importance): share of all gain, falling."""
        total = np.zeros(len(self.binning.features))
        for t in self.trees:
            inner = t.feature >= 0
            np.add.at(total, t.feature[inner], t.gain[inner])
        share = (total / max(total.sum(), 1e-300)).tolist()
        rows = sorted(zip(self.binning.features, share, strict=True), key=lambda r: (-r[1], r[0]))
        return spark.createDataFrame(rows, "feature string, importance double")

    def save(self, spark: SparkSession, path: str) -> None:
        write_text(spark, f"{path}/binning", json.dumps({"numeric": self.binning.numeric, "levels": self.binning.levels}))
        write_trees(spark, f"{path}/trees", self.trees, 0)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedTrees:
        return cls(Binning(**json.loads(read_text(spark, f"{path}/binning"))), read_trees(spark, f"{path}/trees"))


_TREE = "tree int, feature array<int>, bin array<int>, missing_left array<boolean>, value array<double>, gain array<double>"


def write_trees(spark: SparkSession, path: str, trees: list[Tree], first: int) -> None:
    rows = [(first + i, t.feature.tolist(), t.bin.tolist(), t.missing_left.tolist(), t.value.tolist(), t.gain.tolist())
            for i, t in enumerate(trees)]
    spark.createDataFrame(rows, _TREE).coalesce(1).write.mode("overwrite").parquet(path)


def read_trees(spark: SparkSession, path: str) -> list[Tree]:
    rows = spark.read.schema(_TREE).parquet(path).dropDuplicates(["tree"]).orderBy("tree").collect()
    return [Tree(np.array(r["feature"], np.int32), np.array(r["bin"], np.int32), np.array(r["missing_left"], bool),
                 np.array(r["value"]), np.array(r["gain"])) for r in rows]


def write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect()).strip()


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder has been written to its end."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drawn(keys: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    """Which rows a round takes, by a hash of their keys."""
    if share >= 1:
        return np.ones(len(keys), bool)
    salt = int.from_bytes(hashlib.blake2b(f"{seed}:{round_}".encode(), digest_size=8).digest(), "little")
    x = keys.view(np.uint64) ^ np.uint64(salt)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(min(share * 2**64, 2**64 - 1))


def gradients(block: dict, seed: int, round_: int, share: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, gradients and hessians of the rows that a round takes."""
    use = drawn(block["key"], seed, round_, share)
    y, w = block["y"][use], block["w"][use]
    p = 1 / (1 + np.exp(-block["margin"][use]))
    return block["codes"][use], w * (p - y), w * p * (1 - p)


def node_sums(codes: np.ndarray, g: np.ndarray, h: np.ndarray, at: np.ndarray, level: int, features: list[int], bins: int) -> np.ndarray:
    """Gradients and hessians of rows in the nodes ``at``: [node of the level, feature, bin, 2]."""
    n_nodes = 2 ** level
    node = at - (n_nodes - 1)
    if (node < 0).any():  # leaves further up
        here = node >= 0
        codes, g, h, node = codes[here], g[here], h[here], node[here]
    first = node * bins
    out = np.empty((n_nodes, len(features), bins, 2))
    for i, f in enumerate(features):
        place = first + codes[:, f]
        for j, x in enumerate((g, h)):
            out[:, i, :, j] = np.bincount(place, x, n_nodes * bins).reshape(n_nodes, bins)
    return out


def level_sums(block: dict, growing: Tree, level: int, features: list[int], bins: int, seed: int, round_: int, share: float) -> np.ndarray:
    """``node_sums`` of a block's rows in a level of ``growing``."""
    codes, g, h = gradients(block, seed, round_, share)
    return node_sums(codes, g, h, growing.nodes(codes), level, features, bins)


def moved(block: dict, trees: list[Tree]) -> dict:
    """The block with the margins after ``trees``."""
    return {**block, "margin": added(block["margin"], trees, block["codes"])}


def added(margin: np.ndarray, trees: list[Tree], codes: np.ndarray) -> np.ndarray:
    """``margin`` and the trees' values, some rows at a time."""
    out = margin.copy()
    for i in range(0, len(codes), CHUNK):
        flat = codes[i:i + CHUNK].ravel()
        row, now = np.arange(0, len(flat), codes.shape[1]), out[i:i + CHUNK]
        for t in trees:
            now += t.value.take(t.ends(flat, row))
    return out


def best_splits(sums: np.ndarray, lam: float, gamma: float, min_weight: float) -> list[tuple | None]:
    """Per node the split of the largest gain: (gain, feature place, bin, missing left, sums left, sums right)."""
    out: list[tuple | None] = []
    for node in sums:
        total = node[0].sum(axis=0)
        score = lambda s: s[..., 0] ** 2 / (s[..., 1] + lam)
        missing = node[:, :1]
        upto = np.cumsum(node[:, 1:], axis=1)
        found = None
        for missing_left in (False, True):
            left = upto + missing if missing_left else upto
            right = total - left
            gain = 0.5 * (score(left) + score(right) - score(total)) - gamma
            gain[(left[..., 1] < min_weight) | (right[..., 1] < min_weight)] = -np.inf
            f, b = np.unravel_index(np.argmax(gain), gain.shape)
            if gain[f, b] > max(1e-12, found[0] if found else 0):
                found = (float(gain[f, b]), int(f), int(b) + 1, missing_left, left[f, b], right[f, b])
        out.append(found)
    return out


def fit_boosted(train: DataFrame, features: list[str], y: str = TARGET, params: dict | None = None, seed: int = 42,
                store: str | None = None, stop_after: int | None = None) -> BoostedTrees:
    """Fit, or go on with, the ensemble in folder ``store`` (default: one of its own in the checkpoint folder).

    Parameters have the names and defaults of the search space; positives weigh n_neg / n_pos. Rows
    without a label are left out; without rows of both classes there are no trees. ``stop_after``:
    rounds after which this call stops (the folder keeps them)."""
    from riskspark.session import ensure_checkpoint_dir
    p = {**DEFAULT_PARAMS, **(params or {})}
    spark = train.sparkSession
    store = store or f"{ensure_checkpoint_dir(spark).rstrip('/')}/boosted-{uuid.uuid4().hex}"
    if not exists(spark, f"{store}/rows"):
        data = with_class_weight(train.filter(F.col(y).isNotNull()), y, "scale_pos")
        binning = fit_binning(data, features, y)
        write_text(spark, f"{store}/binning", json.dumps({"numeric": binning.numeric, "levels": binning.levels}))
        numeric = [F.col(c).cast("double").alias(c) for c in binning.numeric]
        key = F.xxhash64(*[F.col(c) for c in binning.features])

        def pack(batches):
            for pdf in batches:
                codes = binning.codes(pdf)
                yield pd.DataFrame({"y": pdf["_y"], "w": pdf["_w"], "key": pdf["_key"], "codes": [c.tobytes() for c in codes]})

        (data.select(F.col(y).cast("double").alias("_y"), F.col(WEIGHT).alias("_w"), key.alias("_key"), *numeric, *binning.levels)
         .mapInPandas(pack, "y double, w double, key long, codes binary").write.mode("overwrite").parquet(f"{store}/rows"))
    binning = Binning(**json.loads(read_text(spark, f"{store}/binning")))
    width = len(binning.features)
    rows = spark.read.parquet(f"{store}/rows")
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.min("y").alias("low"), F.max("y").alias("high"), F.max("w").alias("w")).first()
    if not stats["n"] or stats["low"] == stats["high"]:
        return BoostedTrees(binning, [])
    n_parts = max(1, math.ceil(stats["n"] / ROWS_PER_PARTITION))
    if n_parts > 1:
        n_parts = max(n_parts, min(spark.sparkContext.defaultParallelism, stats["n"] // LEAST_ROWS))
    meet = local_path(spark, f"{store}/sums") if n_parts > 1 else None
    side_by_side = together(spark.sparkContext, stats["n"]) if meet else 0
    n_parts = side_by_side or n_parts

    trees: list[Tree] = []
    done = 0
    while done < p["n_estimators"] and exists(spark, f"{store}/stage-{done:05d}"):
        trees += read_trees(spark, f"{store}/stage-{done:05d}")
        done = len(trees)
    known = spark.sparkContext.broadcast(trees[:])

    def block(part):
        got = []
        while some := list(itertools.islice(part, CHUNK)):  # a row as Python objects is many times as large
            codes = np.frombuffer(b"".join(bytes(r[3]) for r in some), np.uint8).reshape(len(some), width)
            got.append({"codes": codes, "y": np.array([r[0] for r in some]), "w": np.array([r[1] for r in some]),
                        "key": np.array([r[2] for r in some], np.int64), "margin": np.zeros(len(some))})
        if got:
            yield moved({c: np.concatenate([g.pop(c) for g in got]) for c in [*got[0]]}, known.value)

    packed = rows.select("y", "w", "key", "codes")
    blocks = packed.repartition(n_parts, "key").rdd.mapPartitions(block).persist(StorageLevel.MEMORY_AND_DISK)
    last = min(int(p["n_estimators"]), stop_after or 10**9)
    try:
        while done < last:
            end = min(done + STAGE, last)
            if n_parts == 1:
                stage = blocks.map(lambda b: stage_of_one(b, done, end, width, p, seed)).collect()[0]  # noqa: B023
            elif side_by_side and slots(spark.sparkContext) >= n_parts:
                stage = stage_together(blocks, done, end, width, p, seed, unit_of(stats["n"], stats["w"]), meet)
            else:
                stage = stage_of_many(blocks, done, end, width, p, seed, n_parts)
            write_trees(spark, f"{store}/stage-{done:05d}", stage, done)
            trees += stage
            done += len(stage)
            if done < last:
                blocks = moved_on(blocks, stage)
    finally:
        blocks.unpersist()
    return BoostedTrees(binning, trees)


def moved_on(blocks, stage: list[Tree]):
    """The blocks with the margins after ``stage``."""
    new = blocks.map(lambda b: moved(b, stage)).persist(StorageLevel.MEMORY_AND_DISK)
    new.count()
    blocks.unpersist()
    return new


def picked(width: int, p: dict, seed: int, round_: int) -> list[int]:
    """The features that a round may split on."""
    n = max(1, int(width * float(p["colsample_bytree"])))
    return sorted(np.random.default_rng([seed, round_]).permutation(width)[:n].tolist())


def stage_of_many(blocks, first: int, last: int, width: int, p: dict, seed: int, n_parts: int) -> list[Tree]:
    """The trees of rounds ``first`` to ``last`` (without) that all partitions work on. The blocks of a round are those
    of the round before with its tree in their margins, kept when the round's first job makes them."""
    out: list[Tree] = []
    now, share = blocks, float(p["subsample"])
    try:
        for round_ in range(first, last):
            features, before = picked(width, p, seed, round_), now
            if out:
                now = following(before, out[-1])

            def sums_at(tree: Tree, level: int) -> np.ndarray:
                summed = now.map(lambda b: level_sums(b, tree, level, features, CODES, seed, round_, share))  # noqa: B023
                sums = summed.treeReduce(np.add, 2) if n_parts > FLAT_MERGE else np.sum(summed.collect(), axis=0)
                if not level and before is not blocks:  # noqa: B023
                    before.unpersist()  # noqa: B023
                return sums

            out.append(grown(sums_at, features, p))
    finally:
        if now is not blocks:
            now.unpersist()
    return out


def following(blocks, tree: Tree):
    """The blocks with the margins after ``tree``, kept when first read."""
    return blocks.map(lambda b: moved(b, [tree])).persist(StorageLevel.MEMORY_AND_DISK)


def stage_of_one(block: dict, first: int, last: int, width: int, p: dict, seed: int) -> list[Tree]:
    """The trees of rounds ``first`` to ``last`` (without) where one partition, of ``ROWS_PER_PARTITION`` rows at most,
    holds the table: there is nothing to merge, so one job grows the whole stage."""
    out: list[Tree] = []
    for round_ in range(first, last):
        features = picked(width, p, seed, round_)
        codes, g, h = gradients(block, seed, round_, float(p["subsample"]))
        at = np.zeros(len(g), np.int64)

        def sums_at(tree: Tree, level: int) -> np.ndarray:
            nonlocal at
            if level:
                at = tree.further(codes, at)  # noqa: B023
            return node_sums(codes, g, h, at, level, features, CODES)  # noqa: B023

        out.append(grown(sums_at, features, p))
        block = moved(block, out[-1:])
    return out


def slots(sc: SparkContext) -> int:
    """Tasks that can run at once, as far as a barrier job may count on them."""
    if sc.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    scala = sc._jsc.sc()
    return scala.maxNumConcurrentTasks(scala.resourceProfileManager().defaultResourceProfile())


def together(sc: SparkContext, n: int) -> int:
    """How many tasks hold a table of ``n`` rows for whole stages; 0 if they can't."""
    tasks = min(slots(sc), FLAT_MERGE, n // LEAST_ROWS)
    return tasks if tasks > 1 and TOGETHER_LEAST <= n <= tasks * TOGETHER_ROWS else 0


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path as Python opens it; None if it isn't one of a (local or mounted) file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = p.getFileSystem(spark._jsc.hadoopConfiguration())
    there = system.makeQualified(p).toUri()
    return there.getPath() if there.getScheme() == "file" else None


def exchanged(folder: str, step: str, own: np.ndarray, place: int, tasks: int) -> np.ndarray:
    """The sum of what all tasks give at this step. The first file of a task's that is there stays, also when Spark
    begins the stage again, so that all tasks read the same."""
    name = lambda i: f"{folder}/{step}-{i}"
    if not os.path.exists(name(place)):
        with open(f"{name(place)}.{uuid.uuid4().hex}", "wb") as f:
            f.write(own.tobytes())
        os.rename(f.name, name(place))
    out, until = np.zeros(own.shape), time.monotonic() + PATIENCE
    for i in range(tasks):
        while True:
            try:
                with open(name(i), "rb") as f:
                    out += np.frombuffer(f.read()).reshape(own.shape)
                break
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"no sums of task {i} in {folder}") from None
                time.sleep(0.001)
    return out


def unit_of(n: int, weight: float) -> float:
    """A power of two, so small that rounding to its multiples is of the size of rounding doubles, and so large that sums
    over ``n`` rows of weight ``weight`` at most are exact in doubles."""
    return 2.0 ** (math.ceil(math.log2(n * max(weight, 1.0))) - 52)


class Chunk:
    """Some rows of a task: codes feature by feature, and the node that each row has come to."""

    def __init__(self, block: dict, some: slice):
        self.codes = np.ascontiguousarray(block["codes"][some].T)
        self.y, self.w, self.key, self.margin = (block[c][some] for c in ("y", "w", "key", "margin"))
        self.row = np.arange(len(self.y))

    def begin(self, seed: int, round_: int, share: float, unit: float) -> None:
        """Gradients and hessians of a round, in units; 0 for rows that it doesn't take."""
        p = 1 / (1 + np.exp(-self.margin))
        w = np.where(drawn(self.key, seed, round_, share), self.w, 0.0) / unit
        self.g, self.h = np.rint(w * (p - self.y)), np.rint(w * p * (1 - p))
        self.at = np.zeros(len(self.y), np.intp)

    def step(self, steps: tuple) -> None:
        self.at = stepped(steps, self.codes.ravel(), self.row, len(self.row), self.at)

    def add_to(self, sums: np.ndarray, features: list[int], slot: np.ndarray | None = None) -> None:
        """Adds up the rows by (slot of their node, feature, bin, 2); rows of nodes whose slot is below 0 are left out."""
        g, h, first, these = self.g, self.h, None, None
        if slot is not None:
            first = slot.take(self.at)
            these = np.flatnonzero(first >= 0)
            first = first.take(these) * CODES
            g, h = g.take(these), h.take(these)
        n = len(sums) * CODES
        for i, f in enumerate(features):
            place = self.codes[f].astype(np.intp) if these is None else self.codes[f].take(these) + first
            for j, x in enumerate((g, h)):
                sums[:, i, :, j] += np.bincount(place, x, n).reshape(-1, CODES)


def stage_together(blocks, first: int, last: int, width: int, p: dict, seed: int, unit: float, meet: str) -> list[Tree]:
    """The trees of rounds ``first`` to ``last`` (without), grown by one job whose tasks run side by side and meet in a
    folder in ``meet``, which is made for the job."""
    folder, tasks = f"{meet}/{uuid.uuid4().hex}", blocks.getNumPartitions()
    os.makedirs(folder)

    def grow(part):
        place = BarrierTaskContext.get().partitionId()
        chunks = [Chunk(b, slice(i, i + CHUNK)) for b in part for i in range(0, len(b["y"]), CHUNK)]
        out: list[Tree] = []
        for round_ in range(first, last):
            features = picked(width, p, seed, round_)
            for c in chunks:
                c.begin(seed, round_, float(p["subsample"]), unit)

            def merged(own: np.ndarray, level: int) -> np.ndarray:
                return exchanged(folder, f"{round_}-{level}", own, place, tasks)  # noqa: B023

            out.append(grown(level_by_level(chunks, features, merged, unit), features, p))
            steps = out[-1].steps()
            for c in chunks:  # on from where the last level began
                c.step(steps)
                c.margin = c.margin + out[-1].value.take(c.at)
        if not place:
            yield out

    try:
        return blocks.barrier().mapPartitions(grow).collect()[0]
    finally:
        shutil.rmtree(folder, ignore_errors=True)


def level_by_level(chunks: list[Chunk], features: list[int], merged, unit: float):
    """``sums_at`` of a tree, level after level: what ``merged`` makes of the sums of each task's ``chunks``. A task adds up
    the child of a node in which it has fewer rows; the left children are merged."""
    own = whole = np.zeros((1, len(features), CODES, 2))

    def sums_at(tree: Tree, level: int) -> np.ndarray:
        nonlocal own, whole
        if not level:
            own = np.zeros(own.shape)
            for c in chunks:
                c.add_to(own, features)
            whole = merged(own, level)
            return whole * unit
        n, steps = 2 ** level, tree.steps()
        parents = np.flatnonzero(tree.feature[n // 2 - 1:n - 1] >= 0)
        rows = np.zeros(n, np.int64)
        for c in chunks:
            c.step(steps)
            rows += np.bincount(np.maximum(c.at - (n - 2), 0), minlength=n + 1)[1:]
        right_less = rows[2 * parents + 1] < rows[2 * parents]
        slot = np.full(2 * n - 1, -1, np.intp)
        slot[n - 1 + 2 * parents + right_less] = np.arange(len(parents))
        fewer = np.zeros((len(parents), *own.shape[1:]))
        for c in chunks:
            c.add_to(fewer, features, slot)
        left = np.where(right_less[:, None, None, None], own[parents] - fewer, fewer)
        own, whole = (of_children(x, parents, y, n) for x, y in ((own, left), (whole, merged(left, level))))
        return whole * unit

    return sums_at


def of_children(sums: np.ndarray, parents: np.ndarray, left: np.ndarray, n: int) -> np.ndarray:
    """The sums of a level's ``n`` nodes, from those of the level above and of the left children of its ``parents``."""
    out = np.zeros((n, *sums.shape[1:]))
    out[2 * parents], out[2 * parents + 1] = left, sums[parents] - left
    return out


def grown(sums_at, features: list[int], p: dict) -> Tree:
    """A tree, level by level, from ``sums_at(tree, level)``."""
    depth = int(p["max_depth"])
    tree = Tree.empty(depth)
    lam, rate = float(p["reg_lambda"]), float(p["learning_rate"])
    for level in range(depth):
        first, any_split = 2 ** level - 1, False
        sums = sums_at(tree, level)
        for i, split in enumerate(best_splits(sums, lam, float(p["gamma"]), float(p["min_child_weight"]))):
            at = first + i
            if level and tree.feature[(at - 1) // 2] < 0:
                continue  # the parent is a leaf
            if split is None:
                if not level:
                    g, h = sums[i, 0].sum(axis=0)
                    tree.value[at] = -rate * g / (h + lam)
                continue
            any_split = True
            tree.gain[at], f, tree.bin[at], tree.missing_left[at], left, right = split
            tree.feature[at] = features[f]
            for child, (g, h) in ((2 * at + 1, left), (2 * at + 2, right)):
                tree.value[child] = -rate * g / (h + lam)  # kept if the child stays a leaf
        if not any_split:
            break
    return tree
