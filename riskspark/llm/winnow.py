"""Document fingerprints by winnowing, in DataFrame functions only.

A text is lower-cased and cut into words (letters and digits). Each word has a
hash; each run of ``K`` words a polynomial hash of them modulo a prime; of every
window of ``W`` runs the smallest hash is chosen, the rightmost of equal ones,
and kept with its position. So every passage of ``K + W - 1`` words that two
texts share gives them a common chosen hash. A text of fewer than ``W`` runs keeps
them all, one of fewer than ``K`` words one hash of them all, and a text without
words the hash of the text itself.

Hash and position share one long (hash in the upper, reversed position in the
lower half), so the smallest long is the rightmost smallest hash. The minimum of
a window is folded by doubling: of 2, of 4, of ``W`` runs.

Defined cases: a null text is the empty text, whose fingerprint is empty and
like only to another empty one (1.0); a repeated row is a document of its own;
rows follow by doc_id (null first), then hash of the text; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskspark.llm.common import table, text_or_empty

K = 5
W = 8
#: Fixed values of the hash: a Mersenne prime and a base below it.
PRIME = (1 << 31) - 1
BASE = 1_000_003
LOW = (1 << 32) - 1


def chosen(text: Column) -> Column:
    """Array of the chosen (hash, position) longs of ``text``, by position."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(PRIME)))
    power = [pow(BASE, K - 1 - j, PRIME) for j in range(K)]

    def gram(h: Column, i: Column) -> Column:  # i from 1; each product is below 2^62
        total = (F.get(h, i - 1) * F.lit(power[0])) % PRIME
        for j in range(1, K):
            total = total + (F.get(h, i - 1 + j) * F.lit(power[j])) % PRIME
        return (total % PRIME) * F.lit(LOW + 1) + (F.lit(LOW) - i)

    def over(value: Column, make) -> Column:  # names a value, so that it is worked out once
        return F.get(F.transform(F.array(value), make), F.lit(0))

    def halves(a: Column, step: int) -> Column:  # the minimum of each element and the one `step` on
        size = F.size(a) - step
        return F.when(size < 1, a).otherwise(F.zip_with(
            F.slice(a, 1, F.greatest(size, F.lit(0))), F.slice(a, step + 1, F.greatest(size, F.lit(0))), lambda x, y: F.least(x, y)))

    def select(h: Column) -> Column:
        n = F.size(h) - (K - 1)
        all_in_one = F.array(F.pmod(F.xxhash64(F.array_join(h.cast("array<string>"), " ")), F.lit(PRIME))
                             * F.lit(LOW + 1) + F.lit(LOW - 1))
        grams = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: gram(h, i))
        many = over(grams, lambda g: over(halves(g, 1), lambda a: over(halves(a, 2), lambda b: halves(b, 4))))
        return (F.when(F.size(h) == 0, F.array().cast("array<bigint>")).when(n < 1, all_in_one)
                .when(n < W, F.array_distinct(grams)).otherwise(F.array_distinct(many)))

    picked = over(hashes, select)
    bare = F.array(F.pmod(F.xxhash64(text), F.lit(PRIME)) * F.lit(LOW + 1) + F.lit(LOW))
    return F.when(text == "", F.array().cast("array<bigint>")).otherwise(
        over(picked, lambda p: F.when(F.size(p) == 0, bare).otherwise(p)))


def positions(picks: Column) -> Column:
    """(hash, position) of chosen longs, the position counting runs from 1 (0: the whole text)."""
    return F.transform(picks, lambda x: F.struct(
        F.shiftright(x, 32).alias("hash"), (F.lit(LOW) - x.bitwiseAND(F.lit(LOW))).alias("position")))


def as_string(picks: Column) -> Column:
    """``hash@position`` in hex, in order of position."""
    return F.array_join(F.transform(positions(picks), lambda x: F.concat(F.hex(x["hash"]), F.lit("@"), F.hex(x["position"]))), " ")


def hashes_of(picks: Column) -> Column:
    return F.array_distinct(F.transform(picks, lambda x: F.shiftright(x, 32)))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two arrays of distinct hashes; 1 if both are empty."""
    common = F.size(F.array_intersect(a, b))
    total = F.size(a) + F.size(b) - common
    return F.when(total == 0, F.lit(1.0)).otherwise(common / total).cast("double")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``picks`` (array of hash, position) of every row."""
    return docs.select(F.col(id_col), positions(chosen(text_or_empty(text_col))).alias("picks"))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows (id, text) of ``docs`` with ``picks`` and with ``next_text`` and ``next_picks`` of
    the row that follows by id, then hash of the text; the first follows the last. Rows are dealt
    into ranges of id, whose cuts only steer the balance; the last row of a range is joined
    to the first row of the next (one row per range)."""
    n = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = docs.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n).alias("cuts")).first()["cuts"] or []
    cuts = F.lit(sorted(set(at))) if at else F.array().cast("array<bigint>")
    part = F.when(F.col("id").isNull(), 0).otherwise(F.size(F.filter(cuts, lambda c: c < F.col("id"))))
    dealt = docs.withColumn("range", part).withColumn("tie", F.xxhash64("text"))
    with_picks = dealt.withColumn("picks", chosen(F.col("text")))
    w = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "tie")
    led = with_picks.withColumn("follower", F.lead(F.struct("text", "picks")).over(w))

    first = dealt.groupBy("range").agg(F.min(F.struct("id", "tie")).alias("first"))  # at most n + 1 rows
    ring = Window.orderBy("range")
    everything = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("range").over(ring), F.max("range").over(everything))
    first = first.select("range", before.alias("before"), "first.id", "first.tie")
    same = (dealt["range"] == first["range"]) & dealt["id"].eqNullSafe(first["id"]) & (dealt["tie"] == first["tie"])
    heads = (dealt.join(F.broadcast(first), same).select(first["before"].alias("range"), dealt["text"])
             .dropDuplicates(["range"]).select("range", F.struct("text", chosen(F.col("text")).alias("picks")).alias("head")))
    joined = led.join(heads, "range", "left").withColumn("follower", F.coalesce("follower", "head"))
    return joined.select("id", "text", "picks", F.col("follower.text").alias("next_text"), F.col("follower.picks").alias("next_picks"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
    rows = with_next(docs)
    size = F.length("text")
    rows = (rows.withColumn("n_chars", size.cast("long"))
            .withColumn("edited", F.concat(F.left("text", size - F.floor(size / 4).cast("int")),
                                           F.left("next_text", F.floor(size / 4).cast("int"))))
            .select("id", "n_chars", "edited", "picks", "next_picks")
            .withColumn("edited_picks", chosen(F.col("edited"))))
    rows = rows.select("*", hashes_of(F.col("picks")).alias("own"))
    return rows.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_string(F.col("picks")).alias("fingerprint"), as_string(F.col("edited_picks")).alias("edited_fingerprint"),
        likeness(F.col("own"), hashes_of(F.col("edited_picks"))).alias("near_edited"),
        likeness(F.col("own"), hashes_of(F.col("next_picks"))).alias("near_next"))
