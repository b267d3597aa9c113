"""Best-fit packing with conflicts.

Texts are packed into bins of ``capacity`` words. The texts are dealt by a hash
of their id into shards of about ``SHARD_ROWS`` pieces, whose number follows the
count of pieces; a shard is packed by one task, longest piece first. Open bins
are kept in order of what room they have left; each carries a bitmap of the
sources and a bitmap of the duplicate clusters it holds. A piece goes into the
tightest bin with room for it whose bitmaps clear it: the search starts at the
first bin with enough room and goes on through its successors until a
compatible one is found, or a new bin is opened.

A text longer than a bin is cut into pieces; all full pieces have a bin of
their own, and the rest is packed like a text. Texts with equal content are one
duplicate cluster (or those with equal ``cluster_col``).

Defined cases: a null text is the empty text, which takes no room but is placed;
a null source conflicts with nothing; a repeated row is a text of its own (its
copies are a cluster, so they are kept apart); an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import Counter

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table, text_or_empty

CAPACITY = 2048
SHARD_ROWS = 2000
SCHEMA = "doc_id long, piece long, n_pieces long, n_words long, shard long, bin long, position long, bin_words long"


def pack(lengths: list[int], sources: list[int], clusters: list[int], capacity: int) -> list[int]:
    """The bin of each piece; -1 as a source or cluster conflicts with nothing.
    Pieces must fit ``capacity``; they are placed in the given order."""
    room: list[tuple[int, int]] = []  # (room left, bin), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    bins = []
    for n, source, cluster in zip(lengths, sources, clusters, strict=True):
        s = 1 << source if source >= 0 else 0
        c = 1 << cluster if cluster >= 0 else 0
        k = bisect_left(room, (n, -1))
        while k < len(room) and (held_sources[room[k][1]] & s or held_clusters[room[k][1]] & c):
            k += 1
        if k < len(room):
            left, b = room.pop(k)
        else:
            left, b = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[b] |= s
        held_clusters[b] |= c
        insort(room, (left - n, b))
        bins.append(b)
    return bins


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text",
                   source_col: str = "source", cluster_col: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece (from 0) of n_pieces, n_words, shard, bin within the
    shard, position in the bin, bin_words (all words of the bin)."""
    text = text_or_empty(text_col)
    words = F.regexp_count(text, F.lit(r"\S+")).cast("long")
    cluster = F.col(cluster_col).cast("string") if cluster_col else F.hex(F.xxhash64(text))
    items = docs.select(F.col(id_col).cast("long").alias("doc_id"), words.alias("words"),
                        F.col(source_col).cast("string").alias("source"), cluster.alias("cluster"))
    full = F.floor((F.greatest(F.col("words"), F.lit(1)) - 1) / capacity)  # pieces that fill a bin
    pieces = (items.withColumn("n_pieces", full + 1)
              .select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_pieces") - 1)).alias("piece"))
              .withColumn("n_words", F.when(F.col("piece") < F.col("n_pieces") - 1, capacity)
                          .otherwise(F.col("words") - capacity * (F.col("n_pieces") - 1)).cast("long")))
    shards = max(1, math.ceil(docs.count() / SHARD_ROWS))  # rows of texts, read from the files' footers
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster"), F.lit(shards)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["n_words", "doc_id", "piece", "cluster", "source"], ascending=[False, True, True, True, True],
                              na_position="last", kind="stable").reset_index(drop=True)
        often = Counter(pdf["cluster"])
        number = {c: i for i, c in enumerate(c for c, n in often.items() if n > 1)}  # bits for clusters that can conflict
        sources = pd.factorize(pdf["source"])[0].tolist()
        pdf["bin"] = pack(pdf["n_words"].tolist(), sources, [number.get(c, -1) for c in pdf["cluster"]], capacity)
        pdf["position"] = pdf.groupby("bin").cumcount()
        pdf["bin_words"] = pdf.groupby("bin")["n_words"].transform("sum")
        return pdf[[c.split()[0] for c in SCHEMA.split(", ")]]

    return dealt.groupBy("shard").applyInPandas(run, SCHEMA)


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))
