"""Spelling variants of a corpus's words, by a bit-sliced position index.

A vocabulary is a set of bits, one for each word; for every (position, letter) the index
holds the set of the words with that letter there. A word is asked letter by letter: the zero-error
set keeps the words that agree so far; where a word's next letter differs it moves, once, into the
one-error sets, of which there are three: replaced (compared at the same position from there on),
and one position behind (the word lacks a letter) or ahead (it has one more). All words of the vocabulary are
followed at once by and / or on long integers.

Spark deals the vocabulary out so that no index grows with it. Two words that differ by one letter have
a place of difference p (the length of their common prefix) and agree on all letters before and, one
shifted, behind it. For a class c (the length of the shorter) the places 0 to c are cut into
intervals; a block holds the words that agree on all letters outside of an interval, and finds the pairs whose
p lies in it, so every pair is found in one block. Blocks of over ``BLOCK`` words cut their interval in halves, again and
again if need be; a block whose interval is one place holds as many words as there are two
letters at most. Blocks are dealt by hash to groups of about ``GROUP`` words, each with one index.

A word's form is its near word of largest count, if that is ``RATIO`` times its own at least; the root
follows forms to the last (by doubling the steps, as forms are ever more frequent).

Defined cases: a null text has no words; a null id is the empty string in the hash; repeated rows count
each; of near words with equal counts the smallest in code-point order is the form; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import defaultdict

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import checkpointed, narrow, released, table

#: Code points of a word, and its occurrences, at least.
MIN_LENGTH = 7
MIN_COUNT = 2
#: How many times as frequent as a word its form is, at least.
RATIO = 10
#: A run loses a letter if this divides the hash of its document's id and itself.
NOISE = 31
#: Words of a block beyond which its interval is halved; words of a group (about).
BLOCK = 1024
GROUP = 1024

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of the words with their occurrences."""
    # a run shorter than MIN_LENGTH can't give a word; longer ones are matched whole
    run = F.explode(F.regexp_extract_all(F.col(text_col), F.lit(f"([A-Za-zÀ-ÿ]{{{MIN_LENGTH},}})"), F.lit(1)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", _UPPER, _LOWER).alias("run"))
    runs = runs.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
    place = F.pmod("h", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), place), F.substring(F.col("run"), place + 2, F.char_length("run")))
    word = F.when(F.col("h") % NOISE == 0, shorter).otherwise(F.col("run"))
    return (runs.select(word.alias("word")).filter(F.char_length("word") >= MIN_LENGTH)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_COUNT))


def keyed(rows: DataFrame) -> DataFrame:
    """(word, n, c, low, high) with ``key``: class, interval, and the letters that a pair with its place
    of difference in the interval has in common."""
    tail = F.greatest(F.col("c") - 1 - F.col("high"), F.lit(0))
    return rows.withColumn("key", F.concat_ws(
        ":", "c", "low", "high", F.substring(F.col("word"), F.lit(1), F.col("low")),
        F.when(tail > 0, F.substring(F.col("word"), F.char_length("word") - tail + 1, tail)).otherwise(F.lit(""))))


def halves(rows: DataFrame) -> DataFrame:
    """Every row with each half of its interval."""
    middle = F.floor((F.col("low") + F.col("high") + 1) / 2).cast("int")
    parts = F.array(F.struct(F.col("low"), (middle - 1).alias("high")), F.struct(middle.alias("low"), F.col("high")))
    return rows.select("word", "n", "c", F.explode(parts).alias("at")).select("word", "n", "c", "at.low", "at.high")


def blocks(words: DataFrame, block: int = BLOCK, shortest: int = 1) -> DataFrame:
    """(word, n, c, low, high, key) of all blocks of two words and more. ``shortest``: code points that every
    word has."""
    m = F.char_length("word")
    # the shorter of a pair, or the longer
    classes = F.filter(F.array(m, m - 1), lambda c: c >= shortest)
    todo = halves(words.select("word", "n", F.explode(classes).alias("c")).select(
        "word", "n", "c", F.lit(0).alias("low"), F.col("c").alias("high")))
    done, written = None, []
    while True:
        rows = checkpointed(keyed(todo))
        sizes = checkpointed(rows.groupBy("key").agg(
            F.count(F.lit(1)).alias("size"), (F.first("high") - F.first("low")).alias("width")).filter("size > 1"))
        written += [rows, sizes]
        cut = (F.col("size") > block) & (F.col("width") > 0)
        some = rows.join(sizes.filter(~cut).select("key"), "key")
        done = some if done is None else done.unionByName(some)
        large = sizes.filter(cut).select("key")
        n_large = large.count()
        if not n_large:
            break
        todo = halves(rows.join(narrow(large, n_large), "key"))
    out = checkpointed(done)
    released(*written)
    return out


def near_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """(word, found, form_n, form) for the rows of some blocks: a row's near words in its block, counted, and the
    best of them."""
    words, counts, keys = pdf["word"].tolist(), pdf["n"].tolist(), pdf["key"].tolist()
    index: dict[tuple[int, str], int] = defaultdict(int)
    block: dict[str, int] = defaultdict(int)
    sized: dict[int, int] = defaultdict(int)
    for j, (word, key) in enumerate(zip(words, keys, strict=True)):
        bit = 1 << j
        block[key] |= bit
        sized[len(word)] |= bit
        for i, letter in enumerate(word):
            index[i, letter] |= bit
    at = index.get
    out = []
    for j, (word, key, c, low, high) in enumerate(zip(words, keys, pdf["c"].tolist(), pdf["low"].tolist(), pdf["high"].tolist(), strict=True)):
        same = block[key] & ~(1 << j)
        replaced = behind = ahead = 0
        for i in range(low, len(word)):
            letter = word[i]
            here = at((i, letter), 0)
            differ = 0
            if i <= high:
                differ = same & ~here
                same &= here
            behind = behind & at((i - 1, letter), 0) | differ
            ahead = (ahead | differ) & at((i + 1, letter), 0)
            replaced = replaced & here | differ
            if not (replaced or behind or ahead or same):
                break
        else:
            if len(word) <= high:  # the other word goes on for one letter
                ahead |= same
        near = (replaced & sized[c] | ahead & sized[c + 1]) if len(word) == c else behind & sized[c]
        if near:
            found, top = near.bit_count(), None
            while near:
                bit = near & -near
                near ^= bit
                other = bit.bit_length() - 1
                mark = (-counts[other], words[other])
                top = mark if top is None or mark < top else top
            out.append((word, found, -top[0], top[1]))
    return pd.DataFrame(out, columns=["word", "found", "form_n", "form"])


def variants(words: DataFrame, block: int = BLOCK, ratio: int = RATIO, shortest: int = 1) -> DataFrame:
    """word, form, root, n, n_near, form_n of every one of ``words`` (word, n), which are distinct."""
    words = checkpointed(words)
    rows = blocks(words, block, shortest)
    n_groups = max(1, math.ceil(rows.count() / GROUP))
    found = (rows.withColumn("group", F.pmod(F.xxhash64("key"), F.lit(n_groups)))
             .groupBy("group").applyInPandas(near_words, "word string, found long, form_n long, form string"))
    best = found.groupBy("word").agg(F.sum("found").alias("n_near"), F.min(F.struct(
        (-F.col("form_n")).alias("less"), F.col("form"))).alias("best"))
    formed = (words.join(best, "word", "left").withColumn("top", -F.col("best.less"))
              .withColumn("is_form", F.coalesce(F.col("top") >= ratio * F.col("n"), F.lit(False)))
              .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                      F.when(F.col("is_form"), F.col("best.form")).alias("form"),
                      F.when(F.col("is_form"), F.col("top")).alias("form_n")))
    formed = checkpointed(formed)
    released(rows, words)
    roots = last_forms(formed.filter("form is not null").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def last_forms(steps: DataFrame) -> DataFrame:
    """(word, root): where the steps from word to root lead in the end. Every round doubles the steps taken."""
    steps = checkpointed(steps)
    while True:
        on = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = checkpointed(steps.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        moved = new.filter("moved").limit(1).count()
        released(steps)
        steps = new
        if not moved:
            return steps.select("word", "root")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents")), shortest=MIN_LENGTH)
