"""Ranked lexical search over a length-stratified index.

Terms are runs of ASCII letters and digits and of all other code points beyond ASCII,
only A-Z lower-cased. A document's normaliser m depends on its length only, so
documents are dealt by ranges of m: a shard of the index holds few strata (documents of equal m),
each with its postings by term and, within a term, by tf. The impact of a term on a document
depends on (tf, m) alone and is worked out once for each tf of a stratum. For a query, the
largest impact of each term in a stratum bounds what a document there can score: strata are visited from the
highest bound down, and those whose bound is below the ``k``-th score found so far are not visited. What
a task has found stays its threshold for its later shards, so a task gives at most ``k`` rows a query. Where the documents
are many, the first ``k`` of ``FIRST_ROWS`` of them are found before: no document below a query's
``k``-th score there can be among its best, so tasks give few rows however many they are.

Queries are a stated set, taken in blocks of ``QUERY_BLOCK``: the terms and weights of
a block are known to every task, whatever the corpus. Postings are made for the block's terms; document
counts, lengths and frequencies cover all documents.

Defined cases: a null or empty text has no terms and is no document for N; a query without
terms, or whose terms no document holds, has no result; queries with one id are one query of all their terms; a null query
id is an id; documents are rows: rows with equal ids are ranked each for itself, null ids after all others; ties go to
the smaller id; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import checkpointed, released, table, text_or_empty

#: Rows of a query's result.
TOP = 50
#: Queries whose terms are known to a task at a time.
QUERY_BLOCK = 2_000
#: Documents of one range of normalisers (about), which a task searches in shards of a batch.
RANGE_ROWS = 40_000
#: Documents (about, by a hash of their place) whose best give every task its first thresholds.
FIRST_ROWS = 20_000
#: Documents that a query's first visit to a shard looks at (whole strata).
FIRST_VISIT = 256

_TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: bytes) -> list[bytes]:
    """The terms of a text in UTF-8; bytes lower-case A-Z alone, and all code points beyond ASCII are bytes from 0x80."""
    return _TERM.findall(text.lower())


def query_terms(items: DataFrame) -> DataFrame:
    """(place, term) of every query (place, text), once each."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(i, t) for i, x in zip(pdf["place"], pdf["text"], strict=True) for t in set(terms_of(x))]
            yield pd.DataFrame(found, columns=["place", "term"])

    return items.select("place", text_or_empty().cast("binary").alias("text")).mapInPandas(
        run, "place long, term binary").distinct()


def term_rows(docs: DataFrame, vocabulary: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """(no_id, id, n, terms, tfs) of every document with a term: its length, and the terms of ``vocabulary``
    (by place) with their occurrences."""
    rows = docs.select(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), F.lit(0)).cast("long").alias("id"),
                       text_or_empty(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {t: i for i, t in enumerate(vocabulary)}
        for pdf in batches:
            n, terms, tfs = [], [], []
            for text in pdf["text"]:
                words = terms_of(text)
                held = Counter(filter(None.__ne__, map(place.get, words)))
                n.append(len(words))
                terms.append(np.fromiter(held.keys(), np.int32, len(held)))
                tfs.append(np.fromiter(held.values(), np.int32, len(held)))
            yield pd.DataFrame({"no_id": pdf["no_id"], "id": pdf["id"], "n": n, "terms": terms, "tfs": tfs})[np.array(n) > 0]

    return rows.mapInPandas(run, "no_id boolean, id long, n long, terms array<int>, tfs array<int>")


class Shard:
    """Documents of few strata: postings ordered by (term, stratum, tf), with impacts and bounds."""

    def __init__(self, m: np.ndarray, terms: np.ndarray, tfs: np.ndarray, n_terms: int):
        self.strata, self.stratum = np.unique(m, return_inverse=True)
        self.rows = np.bincount(self.stratum)
        lengths = np.array([len(t) for t in terms])
        doc = np.repeat(np.arange(len(m)), lengths)
        term, tf = np.concatenate(terms), np.concatenate(tfs).astype(np.int64)
        order = np.lexsort((tf, self.stratum[doc], term))
        self.doc, term, tf = doc[order], term[order], tf[order]
        self.at = self.stratum[self.doc]
        new = np.ones(len(term), bool)
        new[1:] = (term[1:] != term[:-1]) | (self.at[1:] != self.at[:-1]) | (tf[1:] != tf[:-1])
        groups = np.flatnonzero(new)  # of one term, stratum and tf
        self.group_impact = 1_000_000_000 * tf[groups] // (1000 * tf[groups] + 20 * self.strata[self.at[groups]])
        self.impact = np.repeat(self.group_impact, np.diff(np.append(groups, len(term))))
        self.group_at = self.at[groups]
        self.begin = np.searchsorted(term, np.arange(n_terms + 1))
        self.group_begin = np.searchsorted(term[groups], np.arange(n_terms + 1))

    def bounds(self, terms: list[int], weights: list[int]) -> np.ndarray:
        """What a document of each stratum can score at most."""
        bound = np.zeros(len(self.strata), np.int64)
        for t, w in zip(terms, weights, strict=True):
            a, b = self.group_begin[t], self.group_begin[t + 1]
            if a < b:  # a stratum's groups stand by rising tf, so by rising impact: the last is the largest
                at = self.group_at[a:b]
                last = np.flatnonzero(np.append(at[1:] != at[:-1], True))
                bound[at[last]] += w * self.group_impact[a:b][last]
        return bound

    def search(self, terms: list[int], weights: list[int], ids: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents (by row) and scores of at least ``least``, among them the ``k`` best of the shard that have it."""
        bound = self.bounds(terms, weights)
        order = np.argsort(-bound, kind="stable")
        score = np.zeros(len(self.stratum), np.int64)
        found = np.zeros(0, np.int64)
        visit, begin = FIRST_VISIT, 0
        while begin < len(order) and bound[order[begin]] >= max(least, 1):
            end = begin + 1 + int(np.searchsorted(np.cumsum(self.rows[order[begin:]]), visit))
            now = np.zeros(len(self.strata), bool)
            now[order[begin:end]] = True
            now &= bound >= max(least, 1)
            for t, w in zip(terms, weights, strict=True):
                a, b = self.begin[t], self.begin[t + 1]
                if a < b:
                    here = now[self.at[a:b]]
                    score[self.doc[a:b][here]] += w * self.impact[a:b][here]
            found = np.flatnonzero(score >= max(least, 1))
            if len(found) > k:
                found = best(score[found], ids[found], k, found)
                least = max(least, int(score[found].min()))
            begin, visit = end, visit * 4
        return found, score[found]


def best(scores: np.ndarray, ids: np.ndarray, k: int, rows: np.ndarray) -> np.ndarray:
    """The ``k`` of ``rows`` with the highest scores, ties by id."""
    return rows[np.lexsort((ids, -scores))[:k]]


def searched(rows: DataFrame, queries: dict, k: int, n_terms: int, floor: dict[int, int]) -> DataFrame:
    """(place, no_id, id, score): the best ``k`` documents a task finds for each query. Rows: those of
    ``term_rows`` with m, dealt and ordered by m; queries: place to (terms, weights); floor: scores that are
    known to be reached by ``k`` documents."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for pdf in batches:
            shard = Shard(pdf["m"].to_numpy(), pdf["terms"].to_numpy(), pdf["tfs"].to_numpy(), n_terms)
            # rows without an id stand behind all others
            ids = np.where(pdf["no_id"], np.int64(2**63 - 1), pdf["id"])
            own = np.stack((pdf["no_id"].to_numpy().astype(np.int64), pdf["id"].to_numpy()), axis=1)
            for q, (terms, weights) in queries.items():
                scores, who = kept.get(q, (np.zeros(0, np.int64), np.zeros((0, 2), np.int64)))
                least = max(floor.get(q, 0), int(scores.min()) if len(scores) >= k else 0)
                found, new = shard.search(terms, weights, ids, least, k)
                if len(found):
                    scores, who = np.concatenate((scores, new)), np.concatenate((who, own[found]))
                    top = np.lexsort((who[:, 1], who[:, 0], -scores))[:k]
                    kept[q] = scores[top], who[top]
        for q, (scores, who) in kept.items():
            yield pd.DataFrame({"place": q, "no_id": who[:, 0] == 1, "id": who[:, 1], "score": scores})

    return rows.mapInPandas(run, "place long, no_id boolean, id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """item, rank, id, score: the ``k`` best documents of each query that score above 0."""
    spark = docs.sparkSession
    asked = items.select(item_col).distinct()
    n_blocks = max(1, math.ceil(asked.count() / QUERY_BLOCK))
    results = []
    for block in range(n_blocks):
        mine = F.pmod(F.xxhash64(F.col(item_col).cast("string")), F.lit(n_blocks)) == block
        ids = [r[0] for r in asked.filter(mine).collect()]  # a block of the stated queries
        place = spark.createDataFrame([(i, x) for i, x in enumerate(ids)], f"place long, {item_col} {asked.dtypes[0][1]}")
        asked_text = items.filter(mine).select(F.col(item_col).alias("asked"), F.col(item_text_col).alias("text"))
        numbered = asked_text.join(F.broadcast(place), F.col("asked").eqNullSafe(F.col(item_col)))
        held = query_terms(numbered).collect()
        vocabulary = sorted({bytes(r["term"]) for r in held})
        rows = checkpointed(term_rows(docs, vocabulary, id_col, text_col))
        count = rows.agg(F.count(F.lit(1)).alias("N"), F.sum("n").alias("L")).first()
        if not count["N"] or not held:
            released(rows)
            continue
        df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
        weight = {t: math.floor(1000 * math.log((2 * count["N"] + 2) / (2 * f + 1))) for t, f in df.items()}
        of = {t: i for i, t in enumerate(vocabulary)}
        queries: dict[int, tuple[list[int], list[int]]] = {}
        for r in held:
            t = of[bytes(r["term"])]
            if weight.get(t, 0) > 0:
                terms, weights = queries.setdefault(r["place"], ([], []))
                terms.append(t)
                weights.append(weight[t])
        m = F.expr(f"100 - 50 + ((50 * n * {count['N']}L) div {count['L']}L)")
        n_ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(count["N"] / RANGE_ROWS))
        held_rows = rows.filter(F.size("terms") > 0).withColumn("m", m).withColumn("row", F.monotonically_increasing_id())
        top = Window.partitionBy("place").orderBy(F.desc("score"), "no_id", "id")

        def ranked_in(part: DataFrame, n: int, floor: dict[int, int]) -> DataFrame:
            # the row's place parts rows of one m and id, so that none of these is a hot range
            ranged = part.repartitionByRange(n, "m", "id", "row").sortWithinPartitions("m").select("no_id", "id", "m", "terms", "tfs")
            found = searched(ranged, queries, k, len(vocabulary), floor)
            return found.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k)

        floor, some = {}, count["N"] // FIRST_ROWS
        if some > 1:
            first = ranked_in(held_rows.filter(F.pmod(F.xxhash64("row"), F.lit(some)) == 0), max(1, n_ranges // some), {})
            floor = {r["place"]: r["score"] for r in first.filter(F.col("rank") == k).select("place", "score").collect()}
        ranked = ranked_in(held_rows, n_ranges, floor)
        results.append(checkpointed(ranked.join(F.broadcast(place), "place").select(
            F.col(item_col), F.col("rank").cast("int").alias("rank"),
            F.when(~F.col("no_id"), F.col("id")).alias(id_col), "score")))
        released(rows)
    if not results:
        return spark.createDataFrame([], f"{item_col} {asked.dtypes[0][1]}, rank int, {id_col} long, score long")
    out = results[0]
    for r in results[1:]:
        out = out.union(r)
    return out


def op12_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = r"""
with toks as (
  select doc, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select row_number() over () as doc, doc_id, text from documents)),
tf as (select doc, doc_id, term, cast(count(*) as bigint) as tf from toks group by all),
len as (select doc, cast(sum(tf) as bigint) as n from tf group by doc),
tot as (select cast(count(*) as bigint) as nd, cast(sum(n) as bigint) as l from len),
df as (select term, cast(count(*) as bigint) as df from tf group by term),
w as (select term, cast(floor(1000e0 * ln(cast(2 * nd + 2 as double) / cast(2 * df + 1 as double))) as bigint) as w from df, tot),
items as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark),
norm as (select doc, 100 - 50 + ((50 * n * nd) // l) as m from len, tot),
scores as (
  select item_id, doc, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) as bigint) as score
  from items join w using (term) join tf using (term) join norm using (doc)
  group by item_id, doc, doc_id),
ranked as (
  select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank from scores where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 50
"""
