"""Near duplicates by Order MinHash.

A text's words (lower-cased runs of letters and digits) give runs of ``K`` words;
the n-th occurrence of a run is labelled with n. Each of ``SKETCHES`` hash functions
takes the ``L`` smallest labelled runs and keeps them in the order in which they
stand in the text; the hash of that ordered tuple is the sketch. Two texts
whose labelled runs have a Jaccard index s, in the same order, agree on a sketch
with a probability of about s^L: at s = 0.8, 1 pair of long texts in
10 million agrees on none.

Equal texts are one node. Texts that share a sketch are a bucket. The member of
a bucket that shares most buckets with others leads it, and every other member
is paired with the leader only, so a bucket of n gives n - 1 pairs. A pair is a
link if the Jaccard index is ``SIMILARITY`` at least (of labelled runs) and so is
the similarity of a banded alignment of the words (1 - edits / longer length).
Links are joined into components. Buckets whose members are then still in
several components are looked at again. Those of up to ``SMALL`` members pair all
members of different components (``SMALL`` - 1 pairs a member at most). The members
of larger ones go through a prefix filter, which is exact: of two texts with a
Jaccard index of ``SIMILARITY`` at least, each has a common run among its rarest
(1 - ``SIMILARITY``) n + 1, so only texts that share one of those are paired, and
where their lengths and the run's places leave room for that index. Buckets of
such runs are taken in rounds: those of up to ``SMALL`` members pair all, the others
give up 1, ``SMALL``, ``SMALL``^2 ... leaders a round, which are paired with all members of other components, until
every bucket has one component. Members of a bucket's largest component lead none: every pair across has
another end, so a group of copies makes no pairs of its own. Pairs in one component are never made again, and a pair is
aligned only if it agrees on ``AGREE`` sketches (a pair of long texts at 0.8 fails that once in
400,000). Texts of few runs agree on fewer sketches (those of up to ``L`` runs only if all
runs are equal), so all texts of up to ``SHORT`` runs go through the prefix filter, and
pairs of them are aligned without regard to sketches.

Result: a row per row of the input, with ``class_id`` (the smallest id in its
class), ``class_size`` and ``keep`` (true for one row of each class).

Defined cases: a null text is the empty text; texts without words are alike only
if equal; texts of fewer than ``K`` words have one run of all their words; rows
with a null id belong to the class of their text and are kept only if no row
of it has an id; repeated ids are rows of their own, of which one is kept; an empty
table gives an empty result; other columns are not read (``drop_near_copies``
keeps the columns it is given).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import checkpointed, narrow, released, table, text_or_empty

K = 5
L = 5
SKETCHES = 40
SIMILARITY = 0.8
SMALL = 16
AGREE = 2
#: Runs of a text up to which it is compared by the prefix filter, whatever its sketches.
SHORT = 20
#: Members of a bucket that are joined in one portion with what holds for the bucket.
PORTION = 256
#: Words whose hashes a task remembers; the memory starts anew beyond them.
WORD_MEMORY = 150_000
#: Sketched cells (sketches x runs) held at a time.
CELLS = 500_000

#: A word of a text that is compared with another: 32 bits of its hash.
WORD = np.uint32

_WORDS = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SEEDS = np.random.default_rng(20).integers(1, 2**63, 2 * 64, dtype=np.uint64) | np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """Hashes of the words of texts, with a bounded memory."""

    def __init__(self):
        self.memory: dict[str, int] = {}

    def __call__(self, text: str) -> np.ndarray:
        from xxhash import xxh3_64_intdigest
        words = _WORDS.findall(text.lower())
        memory = self.memory
        found = list(map(memory.get, words))
        if None in found:
            new = {w for w, h in zip(words, found, strict=True) if h is None}
            if len(memory) + len(new) > WORD_MEMORY:
                memory.clear()
                new = set(words)
            for w in new:
                memory[w] = xxh3_64_intdigest(w)
            found = list(map(memory.__getitem__, words))
        return np.array(found, np.uint64)


def labelled_runs(words: np.ndarray, k: int = K) -> np.ndarray:
    """Hashes of the runs of ``k`` words, each with the number of its occurrence."""
    n = len(words) - k + 1
    if not len(words):
        return np.zeros(0, np.uint64)
    if n < 1:
        n, k = 1, len(words)
    runs = np.zeros(n, np.uint64)
    for j in range(k):
        runs = mixed(runs * _MIX + words[j:j + n].astype(np.uint64))
    order = np.argsort(runs, kind="stable")
    ordered = runs[order]
    begins = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    if begins.all():
        return runs
    at = np.arange(n)
    nth = np.empty(n, np.uint64)
    nth[order] = (at - np.maximum.accumulate(np.where(begins, at, 0))).astype(np.uint64)
    return np.where(nth > 0, mixed(runs + nth * _MIX), runs)


def sketch(runs: np.ndarray, sketches: int = SKETCHES, size: int = L) -> np.ndarray:
    """The ordered-minimum sketches of labelled runs (none for no runs)."""
    n = len(runs)
    if not n:
        return np.zeros(0, np.uint64)
    out = np.empty(sketches, np.uint64)
    step = max(1, CELLS // n)
    for i in range(0, sketches, step):
        to = min(sketches, i + step)
        seeds, shifts = _SEEDS[i:to, None], _SEEDS[64 + i:64 + to, None]
        values = (runs[None, :] ^ shifts) * seeds
        values ^= values >> np.uint64(32)
        values *= _MIX
        if n > size:
            places = np.argpartition(values, size - 1, axis=1)[:, :size]
            places.sort(axis=1)  # text order
        else:
            places = np.broadcast_to(np.arange(n), (to - i, n))
        h = np.arange(i + 1, to + 1, dtype=np.uint64)
        for j in range(places.shape[1]):
            h = mixed(h * _MIX + runs[places[:, j]])
        out[i:to] = h
    return out


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two arrays of labelled runs, which are distinct."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    total = len(a) + len(b) - common
    return common / total if total else 1.0


def banded_edits(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Edit distance of two word arrays if it is at most ``band``, else band + 1. Only the
    diagonals of a band around the main one are followed; the band is doubled until the
    distance lies within it."""
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[:short] != b[:short])
    head = int(differs[0]) if len(differs) else short
    a, b = a[head:], b[head:]
    short = min(len(a), len(b))
    differs = np.flatnonzero(a[len(a) - short:][::-1] != b[len(b) - short:][::-1])
    tail = int(differs[0]) if len(differs) else short
    a, b = a[:len(a) - tail].astype(np.int64), b[:len(b) - tail].astype(np.int64)
    if abs(len(a) - len(b)) > band:
        return band + 1
    if not len(a) or not len(b):
        return max(len(a), len(b))
    width = max(16, abs(len(a) - len(b)))
    while True:
        width = min(width, band)
        edits = _within(a, b, width)
        if edits <= width or width >= band:
            return edits
        width *= 2


def _within(a: np.ndarray, b: np.ndarray, width: int) -> int:
    """Edit distance if at most ``width``, else width + 1: per diagonal the furthest place
    in ``a`` that 0, 1, 2 ... edits reach."""
    n, m = len(a), len(b)
    d = np.arange(-width, width + 1)
    padded = np.concatenate([np.full(width, -1), b, np.full(width + n, -1)])
    beside = np.lib.stride_tricks.sliding_window_view(padded, n)[:2 * width + 1]  # row of d: b[i + d]
    stops = np.full((len(d), n + 1), n, np.int32)
    step = max(1, CELLS // n)
    for k in range(0, len(d), step):  # the next place on the diagonal where the words differ
        part = np.where(beside[k:k + step] != a, np.arange(n, dtype=np.int32), np.int32(n))
        stops[k:k + step, :n] = np.minimum.accumulate(part[:, ::-1], axis=1)[:, ::-1]
    none = -2 * (n + m + width)
    first, last = np.maximum(0, -d), np.minimum(n, m - d)
    rows, goal = np.arange(len(d)), m - n + width
    reach = np.full(len(d), none)
    reach[width] = stops[width, 0]
    if 0 <= goal < len(d) and reach[goal] >= n:
        return 0
    for edits in range(1, width + 1):
        new = reach + 1  # a word changed
        new[:-1] = np.maximum(new[:-1], reach[1:] + 1)  # taken out of a
        new[1:] = np.maximum(new[1:], reach[:-1])  # put into a
        new = np.minimum(new, last)
        ok = (new >= first) & (last >= first)
        reach = np.where(ok, stops[rows, np.clip(new, 0, n)], none)
        if reach[goal] >= n:
            return edits
    return width + 1


def alike(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether two word arrays are near copies: by their runs, then by alignment."""
    longer = max(len(a), len(b))
    if not min(len(a), len(b)) or min(len(a), len(b)) < similarity * (longer - K):
        return False
    if jaccard(labelled_runs(a), labelled_runs(b)) < similarity:
        return False
    return banded_edits(a, b, int((1 - similarity) * longer + 1e-9)) <= (1 - similarity) * longer + 1e-9


def node_of(text: Column) -> Column:
    """128 bits of the text's digest: equal texts are one node."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def sketches_of(docs: DataFrame) -> DataFrame:
    """(node, sketches, n_runs) of the distinct texts of (node, text)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words, done = Words(), set()
        for pdf in batches:
            pdf = pdf[~pdf["node"].isin(done) & ~pdf["node"].duplicated()]
            if len(done) < WORD_MEMORY:
                done.update(pdf["node"])
            found, sizes = [], []
            for t in pdf["text"]:
                runs = labelled_runs(words(t))
                found.append(sketch(runs).view(np.int64))
                sizes.append(len(runs))
            yield pd.DataFrame({"node": pdf["node"], "sketches": found, "n_runs": sizes})

    per_task = docs.mapInPandas(run, "node binary, sketches array<long>, n_runs int")
    return per_task.groupBy("node").agg(F.first("sketches").alias("sketches"), F.first("n_runs").alias("n_runs"))


def with_facts(buckets: DataFrame, facts: DataFrame) -> DataFrame:
    """Members (bucket, node, mates, size) joined with a row per bucket (bucket, size, ...). The
    members of a large bucket are dealt to portions, each with its copy of that row, so that
    no task gets them all; there are at most a ``PORTION``-th as many copies as members."""
    portions = F.ceil(F.col("size") / PORTION)
    dealt = buckets.withColumn("portion", F.pmod(F.xxhash64("node"), portions))
    copies = facts.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), portions - 1))).drop("size")
    return dealt.join(copies, ["bucket", "portion"]).drop("portion")


def led_pairs(buckets: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Distinct (a, b), a the leader of a bucket and b another member; with ``parts``
    (node, part) only those not in one component. Buckets: (bucket, node, mates, size)."""
    leaders = buckets.groupBy("bucket").agg(F.max(F.struct("mates", "node")).alias("top"), F.max("size").alias("size")).select(
        "bucket", "size", F.col("top.node").alias("a"))
    pairs = with_facts(buckets, leaders).filter(F.col("node") != F.col("a")).select("a", F.col("node").alias("b"))
    return across(pairs.distinct(), parts)


def across(pairs: DataFrame, parts: DataFrame | None) -> DataFrame:
    """Pairs whose ends are in different components."""
    if parts is None:
        return pairs
    of = lambda n: parts.select(F.col("node").alias(n), F.col("part").alias(f"part_{n}"))
    return pairs.join(of("a"), "a").join(of("b"), "b").filter("part_a != part_b").select("a", "b")


def small_pairs(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """All pairs across components within buckets of at most ``SMALL`` members."""
    sets = buckets.groupBy("bucket").agg(F.sort_array(F.collect_list("node")).alias("nodes")).select("nodes").distinct()
    first = sets.select("nodes", F.posexplode("nodes").alias("i", "a"))
    pairs = first.select("a", F.explode(F.slice("nodes", F.col("i") + 2, F.size("nodes"))).alias("b"))
    return across(pairs.distinct(), parts)


def room_for(n_a: Column, place_a: Column, n_b: Column, place_b: Column) -> Column:
    """Whether texts of ``n_a`` and ``n_b`` runs whose first common run stands at these places (from 1)
    can have a Jaccard index of ``SIMILARITY``: of the runs from there on all may be common."""
    most = F.least(n_a - place_a, n_b - place_b) + 1
    return most >= SIMILARITY / (1 + SIMILARITY) * (n_a + n_b) - 1e-9


def rare_buckets(nodes: DataFrame, texts: DataFrame, parts: DataFrame) -> DataFrame:
    """(bucket, node, mates, n_runs, place, size) for the first runs of each of ``nodes`` (node, mates), in an
    order of all runs: those of one component first (they make no pair), then the rarer, then the
    smaller. Two texts with a Jaccard index of ``SIMILARITY`` have a common run among them.
    Members that have no room for that index with any text at least as long as the shortest of the bucket
    are left out."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for node, part, mates, words in zip(pdf["node"], pdf["part"], pdf["mates"], pdf["words"], strict=True):
                runs = labelled_runs(np.frombuffer(words, WORD)).view(np.int64)
                keep = len(runs) - int(np.ceil(SIMILARITY * len(runs) - 1e-9)) + 1
                yield pd.DataFrame({"node": [node] * len(runs), "part": part, "mates": mates, "bucket": runs,
                                    "n_runs": len(runs), "keep": keep})

    runs = nodes.join(parts, "node").join(texts, "node").mapInPandas(
        run, "node binary, part binary, mates long, bucket long, n_runs int, keep int")
    runs = checkpointed(runs)
    across_parts = (runs.groupBy("bucket").agg(F.count(F.lit(1)).alias("often"), F.min("part").alias("low"), F.max("part").alias("high"))
                    .filter("low != high").select("bucket", "often"))
    of_node = Window.partitionBy("node")
    joined = (runs.select("bucket", "node", "mates", "n_runs", "keep").join(across_parts, "bucket")
              .withColumn("later", F.count(F.lit(1)).over(of_node))
              .withColumn("place", F.col("n_runs") - F.col("later") + F.row_number().over(of_node.orderBy("often", "bucket"))))
    rare = checkpointed(joined.filter(F.col("place") <= F.col("keep")).select(
        "bucket", "node", "mates", "n_runs", "place", F.col("often").alias("size")))
    released(runs)
    least = rare.groupBy("bucket").agg(F.max("size").alias("size"), F.min("n_runs").alias("least"))
    # the room is largest with a text of as many runs as follow, or with the next longer one
    best = F.greatest("least", F.col("n_runs") - F.col("place") + 1)
    able = room_for(F.col("n_runs"), F.col("place"), best, F.lit(1))
    return with_facts(rare, least).filter(able).drop("least")


def leading(buckets: DataFrame, parts: DataFrame, leaders: int) -> DataFrame:
    """``buckets`` of ``rare_buckets`` with the ``part`` of each member and ``leads``, true for up to ``leaders`` members
    of each outside its largest part: those of the most mates among the members that a hash deals to each place."""
    placed = buckets.join(parts, "node")
    shares = placed.groupBy("bucket", "part").agg(F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    largest = shares.groupBy("bucket").agg(F.max(F.struct("n", "part")).alias("top"), F.max("size").alias("size")).select(
        "bucket", "size", F.col("top.part").alias("largest"))
    dealt = (with_facts(placed, largest).filter("part != largest")
             .withColumn("slot", F.pmod(F.xxhash64("node", F.lit(leaders)), F.lit(leaders))))
    tops = dealt.groupBy("bucket", "slot").agg(F.max(F.struct("mates", "node")).alias("top"))
    tops = tops.select("bucket", F.col("top.node").alias("node"), F.lit(True).alias("leads"))
    return placed.join(tops, ["bucket", "node"], "left").withColumn("leads", F.coalesce("leads", F.lit(False)))


def many_led_pairs(marked: DataFrame) -> DataFrame:
    """Distinct (a, b) in different components, a a leader of ``leading`` and b another member of its
    bucket that leaves room for the similarity; two leaders are paired once."""
    leaders = marked.filter("leads").select("bucket", "size", F.col("node").alias("a"), F.col("part").alias("part_a"),
                                            F.col("n_runs").alias("n_a"), F.col("place").alias("place_a"))
    met = with_facts(marked, leaders).filter(F.col("part_a") != F.col("part")).filter(~F.col("leads") | (F.col("a") < F.col("node")))
    met = met.filter(room_for(F.col("n_a"), F.col("place_a"), F.col("n_runs"), F.col("place")))
    return met.select("a", F.col("node").alias("b")).distinct()


def verified(pairs: DataFrame, texts: DataFrame, sketched: DataFrame) -> DataFrame:
    """The pairs that are near copies. ``texts``: (node, words), words as 32-bit hashes."""
    of = lambda n, df, *cs: df.select(F.col("node").alias(n), *[F.col(c).alias(f"{c}_{n}") for c in cs])
    short = F.greatest("n_runs_a", "n_runs_b") <= SHORT
    same = F.size(F.filter(F.zip_with("sketches_a", "sketches_b", lambda x, y: x == y), lambda x: x))
    # the leaders (a) first, so that the last shuffle is by the other member, of which none is hot
    likely = (pairs.join(of("a", sketched, "sketches", "n_runs"), "a").join(of("b", sketched, "sketches", "n_runs"), "b")
              .filter(short | (same >= AGREE)).select("a", "b"))
    both = likely.join(of("a", texts, "words"), "a").join(of("b", texts, "words"), "b")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            ok = [alike(np.frombuffer(x, WORD), np.frombuffer(y, WORD))
                  for x, y in zip(pdf["words_a"], pdf["words_b"], strict=True)]
            yield pdf.loc[ok, ["a", "b"]]

    return both.mapInPandas(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(node, part) of all nodes in ``links``: part is the smallest node of the component.
    Each round takes the smallest part next to a node, then the part of that part."""
    edges = checkpointed(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    parts = last = checkpointed(edges.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("part")))
    while True:
        near = (edges.join(parts.select(F.col("node").alias("b"), "part"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("part").alias("beside")))
        lower = parts.join(near, "node").select("node", "part", F.least("part", "beside").alias("now"))
        jump = parts.select(F.col("node").alias("now"), F.col("part").alias("further"))
        new = checkpointed(lower.join(jump, "now").select(
            "node", F.least("now", "further").alias("part"), (F.least("now", "further") != F.col("part")).alias("moved")))
        moved = new.agg(F.max("moved").alias("m")).first()["m"]
        released(last)
        last, parts = new, new.select("node", "part")
        if not moved:
            released(edges)
            return parts


def joined_parts(parts: DataFrame, links: DataFrame) -> DataFrame:
    """``parts`` (node, part) after ``links`` (a, b) between its nodes."""
    of = lambda n: parts.select(F.col("node").alias(n), F.col("part").alias(f"part_{n}"))
    between = checkpointed(links.join(of("a"), "a").join(of("b"), "b").filter("part_a != part_b")
                           .select(F.col("part_a").alias("a"), F.col("part_b").alias("b")).distinct())
    if between.isEmpty():
        released(between)
        return parts
    onto = components(between).select(F.col("node").alias("part"), F.col("part").alias("whole"))
    return checkpointed(parts.join(onto, "part", "left").select("node", F.coalesce("whole", "part").alias("part")))


def settled(rare: DataFrame, pairs: DataFrame, parts: DataFrame, texts: DataFrame, sketched: DataFrame) -> DataFrame:
    """``parts`` after ``pairs`` and after all pairs of the buckets of ``rare_buckets``. A member that has
    led its bucket has met all others there and is taken out of it."""
    spark = parts.sparkSession
    leaders, marked = 1, None
    while True:
        mixed_rows = checkpointed(still_mixed(rare, parts))
        if marked is not None:
            released(marked)
        large = mixed_rows.filter(F.col("size") > SMALL)
        pairs = pairs.union(small_pairs(mixed_rows.filter(F.col("size") <= SMALL), parts))
        more = not large.isEmpty()
        if more:
            marked = checkpointed(leading(large, parts, leaders))
            pairs = pairs.union(many_led_pairs(marked))
        parts = joined_parts(parts, verified(pairs.distinct(), texts, sketched))
        released(mixed_rows)
        if not more:
            return parts
        rare = marked.filter(~F.col("leads")).drop("leads", "part")
        pairs = spark.createDataFrame([], pairs.schema)
        leaders *= SMALL


def near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, part) of every distinct text that has a near copy (and maybe of others, which are
    parts of their own), part being the component."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    base = docs.select(node_of(text).alias("node"), text.alias("text"))
    sketched = checkpointed(sketches_of(base))
    member = sketched.select("node", F.posexplode("sketches").alias("s", "bucket")).select("bucket", "node")
    sizes = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = checkpointed(member.join(sizes, "bucket"))
    # a near copy shares `AGREE` buckets with its partner
    mates = shared.groupBy("node").agg(F.sum("n").alias("mates"), F.count(F.lit(1)).alias("m")).filter(F.col("m") >= AGREE).drop("m")
    buckets = checkpointed(shared.join(mates, "node").select("bucket", "node", "mates", F.col("n").alias("size")))

    # the words of the texts in buckets, as hashes, once for all rounds
    short = sketched.filter(F.col("n_runs").between(1, SHORT)).select("node")
    involved = checkpointed(mates.select("node").union(short).distinct())
    released(shared)
    n_involved = involved.count()
    wanted = base.join(narrow(involved, n_involved), "node", "left_semi").dropDuplicates(["node"])

    def hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words()
        for pdf in batches:
            yield pd.DataFrame({"node": pdf["node"], "words": [words(t).astype(WORD).tobytes() for t in pdf["text"]]})

    texts = checkpointed(wanted.mapInPandas(hashes, "node binary, words binary"))
    signed = checkpointed(sketched.join(narrow(involved, n_involved), "node", "left_semi")
                          .withColumn("sketches", F.transform("sketches", lambda x: F.shiftright(x, 32).cast("int"))))
    links = checkpointed(verified(led_pairs(buckets, None), texts, signed))
    found = components(links)
    # members without a link are components of their own
    parts = checkpointed(involved.join(found, "node", "left").select("node", F.coalesce("part", "node").alias("part")))
    open_ = checkpointed(still_mixed(buckets, parts))
    pairs = small_pairs(open_.filter(F.col("size") <= SMALL), parts)
    large = open_.filter(F.col("size") > SMALL).select("node", "mates")
    sifted = large.union(short.select("node", F.lit(0).cast("long").alias("mates"))).groupBy("node").agg(F.max("mates").alias("mates"))
    return settled(rare_buckets(sifted, texts, parts), pairs, parts, texts, signed)


def still_mixed(buckets: DataFrame, parts: DataFrame) -> DataFrame:
    """The rows of the buckets with members in several components, size being the members that
    are left."""
    mixed_up = (buckets.join(parts, "node").groupBy("bucket").agg(
        F.count(F.lit(1)).alias("left"), F.max("size").alias("size"), F.min("part").alias("low"),
        F.max("part").alias("high")).filter("low != high"))
    rows = with_facts(buckets, mixed_up.select("bucket", "size", "left"))
    return rows.select(*[c for c in buckets.columns if c != "size"], F.col("left").alias("size"))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, class_id, class_size, keep of every row."""
    found = near_copies(docs, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("id"), node_of(text_or_empty(text_col)).alias("node"))
    placed = (rows.join(found, "node", "left").select("id", F.coalesce("part", "node").alias("part"))
              .withColumn("row", F.monotonically_increasing_id()))
    placed = checkpointed(placed)
    first = placed.groupBy("part").agg(
        F.min("id").alias("class_id"), F.count(F.lit(1)).alias("class_size"),
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "row")).alias("kept"))
    return placed.join(first, "part").select(
        F.col("id").alias(id_col), "class_id", "class_size", (F.col("row") == F.col("kept.row")).alias("keep"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classes(table(spark, sf_dir, "documents"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each class: the one with the smallest id (rows equal in
    id and text are one), its columns as they were."""
    found = near_copies(docs)
    node = node_of(text_or_empty())
    placed = (docs.select(F.col("doc_id").alias("id"), node.alias("node")).join(found, "node", "left")
              .select("id", "node", F.coalesce("part", "node").alias("part")))
    best = placed.groupBy("part").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "node")).alias("best"))
    best = best.select(F.col("best.id").alias("best_id"), F.col("best.node").alias("best_node"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").alias("id"), node.alias("node"))
    kept = rows.join(best, (F.col("node") == F.col("best_node")) & F.col("id").eqNullSafe(F.col("best_id")), "left_semi")
    return kept.dropDuplicates(["id", "node"]).select("row.*")
