"""Approximate nearest neighbours by learned partitions.

Fit, on at most ``SAMPLE`` distinct vectors (smallest hash; a documented bound):
the graph of each vector's ``NEIGHBOURS`` nearest is cut into equal parts
(halved along the principal axis again and again, then improved by moving
vectors to the part of most of their neighbours while it has room), and a
small network learns which parts the neighbours of a vector are in. Index:
every distinct vector goes to its most probable part. Search: a query goes to
its most probable parts, as many as hold ``MASS`` of the probability, and all
vectors there are ranked by exact cosine in double precision.

Equal vectors are stored once, with the ``k + 1`` smallest ids that have them
(no others can be among a query's ``k`` nearest), and equal queries are
searched once. A part is cut into blocks of about ``BLOCK`` vectors by a hash,
as many as its size asks for, and a part's queries into slices of about ``SLICE``.

Defined cases: vectors that are null, empty, zero, hold null or non-finite
components, or have another length than the most frequent one take no part;
rows with a null id take no part; rows equal in id and vector count once, other
rows of one id each (a query leaves out all rows of its own id); an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import checkpointed, table

SAMPLE = 6000
NEIGHBOURS = 12
HIDDEN = 96
EPOCHS = 60
MASS = 0.96
#: Vectors of a part that the number of parts aims at, and the most parts.
PART_ROWS = 1500
MAX_PARTS = 64
BLOCK = 20_000
SLICE = 5_000


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow or underflow of squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Indices (rows x k) of the nearest other rows of unit vectors ``x``."""
    out = np.empty((len(x), k), np.int64)
    for i in range(0, len(x), 500):
        s = x[i:i + 500] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 500] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, slack: float = 0.1, sweeps: int = 6) -> np.ndarray:
    """A part per row; no part has over (1 + slack) times its share."""
    part = np.zeros(len(x), np.int64)
    made = 1
    while made < parts:
        for p in range(made):
            rows = np.flatnonzero(part == p)
            centred = x[rows] - x[rows].mean(axis=0)
            axis = np.linalg.svd(centred, full_matrices=False)[2][0] if len(rows) > 1 else x[0]
            order = rows[np.argsort(centred @ axis, kind="stable")]
            part[order[len(order) // 2:]] = p + made
        made *= 2
    room = int((1 + slack) * -(-len(x) // parts))
    size = np.bincount(part, minlength=parts)
    both = [list(g) for g in graph]
    for i, g in enumerate(graph):
        for j in g:
            both[j].append(i)
    rng = np.random.default_rng(0)
    for _ in range(sweeps):
        for i in rng.permutation(len(x)):
            votes = np.bincount(part[both[i]], minlength=parts)
            votes[(size >= room) & (np.arange(parts) != part[i])] = -1
            best = int(votes.argmax())
            if votes[best] > votes[part[i]]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
    return part


class Router:
    """One hidden layer; gives the probability of each part."""

    def __init__(self, dim: int, parts: int, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, 1.0, (dim, HIDDEN)), np.zeros(HIDDEN),
                  rng.normal(0, HIDDEN ** -0.5, (HIDDEN, parts)), np.zeros(parts)]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return self._forward(x)[1]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = np.maximum(x @ self.w[0] + self.w[1], 0)
        z = h @ self.w[2] + self.w[3]
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return h, p / p.sum(axis=1, keepdims=True)

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = EPOCHS, batch: int = 128) -> None:
        rng = np.random.default_rng(1)
        m, v = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step, total = 0, epochs * -(-len(x) // batch)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                rows = order[i:i + batch]
                h, p = self._forward(x[rows])
                g = (p - target[rows]) / len(rows)
                gh = (g @ self.w[2].T) * (h > 0)
                grads = [x[rows].T @ gh, gh.sum(axis=0), h.T @ g, g.sum(axis=0)]
                step += 1
                rate = 5e-3 * (1 - (step - 1) / total)
                for w, d, a, b in zip(self.w, grads, m, v, strict=True):
                    a += 0.1 * (d - a)
                    b += 0.001 * (d * d - b)
                    w -= rate * ((a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8) + 1e-4 * w)


def fit_router(sample: np.ndarray, n_distinct: int) -> Router | None:
    """None if one part is enough: then all vectors are searched."""
    parts = 1
    while parts < MAX_PARTS and parts * PART_ROWS < n_distinct and parts * 64 <= len(sample):
        parts *= 2
    if parts == 1:
        return None
    x = unit(sample)
    graph = neighbour_graph(x, NEIGHBOURS)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    target[np.arange(len(x)), part] = 1.0
    for j in range(NEIGHBOURS):
        target[np.arange(len(x)), part[graph[:, j]]] += 1.0
    router = Router(x.shape[1], parts)
    router.fit(x, target / target.sum(axis=1, keepdims=True))
    return router


def probed(p: np.ndarray, mass: float = MASS) -> list[list[int]]:
    """The most probable parts of each row up to ``mass`` of the probability."""
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), axis=1) - np.take_along_axis(p, order, 1)
    return [o[b < mass].tolist() for o, b in zip(order, before, strict=True)]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vec): finite, non-zero vectors of the most frequent length."""
    vec = F.col(vector_col).cast("array<double>")
    bound = F.lit(float("inf"))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), vec.alias("vec")).filter(
        F.col("id").isNotNull() & F.col("vec").isNotNull()
        & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < bound)) & F.exists("vec", lambda x: x != 0))
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(F.size("vec") == (sizes["n"] if sizes else 0))


def search(vectors: DataFrame, queries, k: int, id_col: str = "vec_id", vector_col: str = "embedding",
           mass: float = MASS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row for which the
    column expression ``queries`` (of ``id``) holds."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).distinct()
    first = Window.partitionBy("vec").orderBy("id")
    few = rows.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= k + 1)
    stored = few.groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    stored = checkpointed(stored.withColumn("key", F.monotonically_increasing_id()))
    n = stored.count()
    sample = stored.orderBy(F.xxhash64("vec"), "key").limit(SAMPLE).select("vec").toPandas()["vec"]
    router = fit_router(np.array(sample.tolist(), float), n) if n else None
    parts = len(router.w[3]) if router else 1

    def route(how_many: str):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                if router is None:
                    yield pdf.assign(part=0)
                    continue
                p = router.probabilities(unit(np.array(pdf["vec"].tolist(), float).reshape(len(pdf), -1)))
                if how_many == "one":
                    yield pdf.assign(part=p.argmax(axis=1))
                else:
                    yield pdf.assign(part=probed(p, mass)).explode("part").astype({"part": "int32"})
        return run

    indexed = checkpointed(stored.mapInPandas(route("one"), "vec array<double>, ids array<long>, key long, part int"))
    asked = rows.filter(queries).join(stored.select("vec", "key"), "vec").select(F.col("id").alias("query_id"), "key")
    asked = checkpointed(asked)
    wanted = stored.join(asked.select("key").distinct(), "key", "left_semi").select("vec", "key")
    routed = checkpointed(wanted.mapInPandas(route("many"), "vec array<double>, key long, part int"))

    # (part, its blocks, its slices): `parts` rows at most
    blocks = indexed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    slices = routed.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / SLICE).cast("int").alias("slices"))
    shape = {r["part"]: (r["blocks"], r["slices"]) for r in blocks.join(slices, "part").collect()}
    if not shape:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks_of, slices_of = (F.create_map(*[F.lit(x) for p, s in shape.items() for x in (p, s[i])]) for i in (0, 1))
    hashed = lambda n: F.pmod(F.xxhash64("key"), n).cast("int")
    right = (indexed.filter(F.col("part").isin(list(shape)))
             .withColumn("block", hashed(F.try_element_at(blocks_of, F.col("part"))))
             .withColumn("slice", F.explode(F.sequence(F.lit(0), F.try_element_at(slices_of, F.col("part")) - 1))))
    left = (routed.filter(F.col("part").isin(list(shape)))
            .withColumn("slice", hashed(F.try_element_at(slices_of, F.col("part"))))
            .withColumn("block", F.explode(F.sequence(F.lit(0), F.try_element_at(blocks_of, F.col("part")) - 1))))

    def nearest(q: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        """For each query the ids that can be among its ``k`` nearest others in this block."""
        if q.empty or v.empty:
            return pd.DataFrame({"key": [], "vec_id": [], "score": []}).astype({"key": "int64", "vec_id": "int64"})
        a = np.array(q["vec"].tolist(), float)
        b = unit(np.array(v["vec"].tolist(), float))
        low = np.array([x[0] for x in v["ids"]])
        keys, ids, scores = [], [], []
        for i in range(0, len(a), 200):
            s = unit(a[i:i + 200]) @ b.T
            for row, key in zip(s, q["key"].iloc[i:i + 200], strict=True):
                take = 2 * k
                while True:  # more if one id has most of the nearest vectors
                    if len(row) > take:
                        edge = np.partition(row, len(row) - take)[len(row) - take]
                        near = np.flatnonzero(row >= edge - 1e-12)
                    else:
                        near = np.arange(len(row))
                    held = Counter(one for j in near for one in v["ids"].iat[j])
                    if len(near) == len(row) or sum(min(n, k) for n in held.values()) >= 2 * k:
                        break
                    take *= 4
                near = near[np.lexsort((low[near], -row[near]))]
                for j in near:
                    for one in v["ids"].iat[j]:
                        keys.append(key)
                        ids.append(one)
                        scores.append(min(1.0, max(-1.0, row[j])))
        out = pd.DataFrame({"key": keys, "vec_id": ids, "score": scores})
        out = out.sort_values(["key", "score", "vec_id"], ascending=[True, False, True])
        return out.groupby(["key", "vec_id"]).head(k).groupby("key").head(2 * k)

    found = (left.groupBy("part", "block", "slice").cogroup(right.groupBy("part", "block", "slice"))
             .applyInPandas(nearest, "key long, vec_id long, score double"))
    # k rows of an id at most, so that 2 k rows hold k of other ids than the query's own
    of_id = Window.partitionBy("key", "vec_id").orderBy(F.desc("score"))
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("n", F.row_number().over(of_id)).filter(F.col("n") <= k)
    found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= 2 * k).drop("n")
    last = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.join(found, "key").filter(F.col("vec_id") != F.col("query_id"))
            .withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, 5)
