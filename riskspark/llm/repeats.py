"""Repeated passages across documents, found by recompression and cut out.

A text's words are symbols. Each of ``LEVELS`` rounds renames its sequence of symbols:
in every ``RUNS_EVERY``-th, a run of one symbol becomes a symbol named by (symbol, length); then a pair of
neighbours becomes one if the round's hash puts the first on the left side and the second
on the right. No symbol grows beyond ``CAP`` words. Names are hashes of what they stand
for, so they are global: equal stretches of words get equal symbols wherever they
stand, but for symbols near their ends, which see their surroundings. How far a symbol
saw is tracked exactly (``low``, ``high``: the words that its name and place depend on),
so a window of words that covers these holds that symbol in every text with that window.

The Spark rounds: (1) each distinct text is parsed, and a row of its symbols is
written; (2) symbols are counted over all texts: the smallest and largest document id of each name;
(3) the shared ones are joined back, and a window that covers a symbol of one document only
can't repeat, so it is put aside; (4) the windows that are left, about as many as do repeat, are verified:
128 bits of their words' hash, the smallest id of each, joined back; (5) the
words of the windows that start in a document with a smaller id are cut out.
Names that collide make more windows go through (4), never fewer.

Defined cases: a null text has no words; texts of fewer than ``WINDOW`` words keep
all; of equal texts the smallest id keeps its words; rows of equal ids take nothing
from each other; null ids count as larger than all others (and take nothing from each other); equal rows
get equal results, a row each; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from riskspark.llm.common import checkpointed, narrow, released, table, text_or_empty
from riskspark.llm.near_dedup import node_of

#: Words of a window.
WINDOW = 50
LEVELS = 7
#: Rounds from one that names runs to the next (all name pairs): a symbol that is in no run has to see both
#: neighbours to know it, so each of these widens what symbols depend on.
RUNS_EVERY = 4
#: Words of a symbol at most.
CAP = 12
#: Words that a task parses at a time (a longer text is parsed as a whole).
WORDS_AT_ONCE = 100_000
#: Windows that a task gives out at a time (those of one text at least).
WINDOWS_AT_ONCE = 50_000
#: Words whose hashes a task remembers; the memory starts anew beyond them.
WORD_MEMORY = 100_000

_MIX = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(0xD6E8FEB86659FD93)
_INVERSE = np.uint64(pow(int(_BASE), -1, 2**64))
_SALTS = np.random.default_rng(13).integers(1, 2**63, 64, dtype=np.uint64)
#: Texts whose windows are joined by broadcast (their ranges are some 80 bytes a text).
BROADCAST_TEXTS = 200_000
#: The id of rows without one: larger than any other.
NO_ID = 2**63 - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every bit of ``x``."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Hashes(dict):
    """64-bit hashes of words (bytes), with a bounded memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_MEMORY:
            self.clear()
        h = self[word] = xxh3_64_intdigest(word)
        return h

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class Symbols:
    """The symbols of texts laid end to end: name, number of words, text, and the words
    [low, high) that name and place depend on. A place before the first or behind the last
    word of a text stands for "no neighbour", which no window covers."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n = len(words)
        self.name, self.text, self.size = words.copy(), text, np.ones(n, np.int64)
        self.low, self.high = np.arange(n), np.arange(1, n + 1)

    def _beside(self) -> np.ndarray:
        """Whether a symbol and the next are of one text."""
        return self.text[1:] == self.text[:-1]

    def _seen(self, left: np.ndarray, right: np.ndarray) -> None:
        """The symbols marked ``left`` saw the one before, those marked ``right`` the next."""
        low, high, n = self.low.copy(), self.high.copy(), len(self.name)
        beside = self._beside()
        for marked, step in ((left, -1), (right, 1)):
            at = np.flatnonzero(marked)
            there = at + step
            inside = (there >= 0) & (there < n)
            inside[inside] = beside[np.minimum(at[inside], there[inside])]
            to, there = at[inside], there[inside]
            low[to] = np.minimum(low[to], self.low[there])
            high[to] = np.maximum(high[to], self.high[there])
            if step < 0:
                low[at[~inside]] -= 1
            else:
                high[at[~inside]] += 1
        self.low, self.high = low, high

    def _fold(self, begins: np.ndarray, names: np.ndarray) -> None:
        """Symbols from one of ``begins`` to the next become one, called ``names``."""
        at = np.flatnonzero(begins)
        self.name, self.text = names[at], self.text[at]
        self.size = np.add.reduceat(self.size, at)
        self.low, self.high = np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at)

    def runs(self) -> None:
        n = len(self.name)
        same = self._beside() & (self.name[1:] == self.name[:-1])
        begins = np.concatenate(([True], ~same))
        at = np.flatnonzero(begins)
        lengths = np.diff(np.append(at, n))
        of = np.repeat(np.arange(len(at)), lengths)
        run = lengths[of] > 1
        # a run, also of one, saw all of itself and what stands on either side
        self._seen(begins, np.concatenate((begins[1:], [True])))
        low, high = np.minimum.reduceat(self.low, at), np.maximum.reduceat(self.high, at)
        self.low, self.high = np.where(run, low[of], self.low), np.where(run, high[of], self.high)
        fits = run & (lengths[of] * self.size <= CAP)
        names = np.where(fits, mixed(self.name * _MIX + lengths[of].astype(np.uint64)), self.name)
        self._fold(begins | ~fits, names)

    def pairs(self, level: int) -> None:
        left = (mixed(self.name ^ _SALTS[level]) & np.uint64(1)).astype(bool)
        full = self.size >= CAP  # those can't be in a pair, whatever stands beside them
        meets = np.concatenate((self._beside() & left[:-1] & ~left[1:] & (self.size[:-1] + self.size[1:] <= CAP), [False]))
        self._seen(~left & ~full, left & ~full)
        names = self.name.copy()
        at = np.flatnonzero(meets)
        names[at] = mixed(mixed(self.name[at] + _SALTS[level]) ^ (self.name[at + 1] * _BASE))
        self._fold(~np.concatenate(([False], meets[:-1])), names)


def recompress(words: np.ndarray, text: np.ndarray, levels: int = LEVELS) -> Symbols:
    """The symbols of texts laid end to end (``text``: the text of each word) after all rounds."""
    symbols = Symbols(words, text)
    if len(words):
        for level in range(levels):
            if level % RUNS_EVERY == 0:
                symbols.runs()
            symbols.pairs(level)
    return symbols


def symbol_ranges(words: np.ndarray, sizes: np.ndarray, window: int = WINDOW) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each of the texts laid end to end (hashes of their words, and how many each has): names of its symbols, and
    the first and last window (by the place where it begins) that holds each symbol. Symbols that no window
    holds are left out."""
    s = recompress(words, np.repeat(np.arange(len(sizes)), sizes))
    begin = np.cumsum(sizes) - sizes
    first = np.maximum(s.high - begin[s.text] - window, 0)
    last = np.minimum(s.low - begin[s.text], sizes[s.text] - window)
    held = (first <= last) & (s.high - begin[s.text] <= sizes[s.text])
    name, text, first, last = s.name[held], s.text[held], first[held], last[held]
    cuts = np.searchsorted(text, np.arange(1, len(sizes)))
    return list(zip(np.split(name, cuts), np.split(first, cuts), np.split(last, cuts), strict=True))


def covered(first: np.ndarray, last: np.ndarray, n: int) -> np.ndarray:
    """Which of the places 0 to n - 1 lie in a range from ``first`` to ``last``."""
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, last + 1, -1)
    return np.cumsum(steps[:n]) > 0


def window_hashes(words: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window, from hashes of the words."""
    n = len(words)
    up, down = np.full(n, _BASE), np.full(n, _INVERSE)
    up[0] = down[0] = 1
    up, down = np.cumprod(up), np.cumprod(down)
    out = []
    for h in (words, mixed(words * _MIX)):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(h * down)))
        out.append(mixed((sums[window:] - sums[:-window]) * up[:n - window + 1]).view(np.int64))
    return out[0], out[1]


def parsed_texts(docs: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(no_id, id, digest, n_words, whole, names, first, last, bare) of each row: the digest of its text and
    of its words joined by a space; its symbols, and whether a window holds none of them. A text that a task
    meets again has no symbols there."""
    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).isNull().alias("no_id"), F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"),
                       node_of(text).alias("digest"), text.cast("binary").alias("text"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, done = Hashes(), set()
        for pdf in batches:
            begin = 0
            while begin < len(pdf):  # so many rows as have about WORDS_AT_ONCE words
                n, end, words = 0, begin, []
                while end < len(pdf) and (n < WORDS_AT_ONCE or end == begin):
                    words.append(pdf["text"].iloc[end].split())
                    n += len(words[-1])
                    end += 1
                part = pdf.iloc[begin:end]
                begin = end
                new = [d not in done and len(w) >= window for d, w in zip(part["digest"], words, strict=True)]
                if len(done) < WORD_MEMORY:
                    done.update(part["digest"])
                met = [w for w, k in zip(words, new, strict=True) if k]
                flat = hashes([x for w in met for x in w])
                found = iter(symbol_ranges(flat, np.array([len(w) for w in met], np.int64), window))
                out = []
                for w, k in zip(words, new, strict=True):
                    whole = hashlib.sha256(b" ".join(w)).hexdigest()
                    if not k:
                        out.append((len(w), whole, None, None, None, False))
                        continue
                    name, first, last = next(found)
                    bare = not covered(first, last, len(w) - window + 1).all()
                    out.append((len(w), whole, name.view(np.int64), first.astype(np.int32), last.astype(np.int32), bare))
                out = pd.DataFrame(out, columns=["n_words", "whole", "names", "first", "last", "bare"])
                yield pd.concat([part[["no_id", "id", "digest"]].reset_index(drop=True), out], axis=1)

    return rows.mapInPandas(run, "no_id boolean, id long, digest binary, n_words long, whole string, "
                                 "names array<long>, first array<int>, last array<int>, bare boolean")


def open_windows(owners: DataFrame, shared: DataFrame, window: int) -> DataFrame:
    """(digest, id, ranges) of the texts with windows that may repeat: those that hold no symbol of one
    document only. ``ranges``: first and last place of each stretch of such windows, in turn."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for n, first, last, places in zip(pdf["n_words"], pdf["first"], pdf["last"], pdf["places"], strict=True):
                own = np.ones(len(first), bool)
                if places is not None:
                    own[np.asarray(places, np.int64)] = False
                out = ~covered(np.asarray(first, np.int64)[own], np.asarray(last, np.int64)[own], int(n) - window + 1)
                turns = np.flatnonzero(np.diff(np.concatenate(([0], out.astype(np.int8), [0]))))
                turns[1::2] -= 1
                found.append(turns.astype(np.int32))
            some = [len(f) > 0 for f in found]
            yield pd.DataFrame({"digest": pdf["digest"][some], "id": pdf["id"][some],
                                "ranges": [f for f in found if len(f)]})

    rows = (owners.select("digest", "id", "n_words", "first", "last", "bare").join(shared, ["digest", "id"], "left")
            .filter(F.col("bare") | F.col("places").isNotNull()))
    return rows.mapInPandas(run, "digest binary, id long, ranges array<int>")


def candidate_places(ranges: np.ndarray) -> np.ndarray:
    ranges = np.asarray(ranges, np.int64)
    return np.concatenate([np.arange(a, b + 1) for a, b in zip(ranges[::2], ranges[1::2], strict=True)])


def stretches(hashes: Hashes, words: list[bytes], ranges: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the windows of ``candidate_places``; words outside of them are not looked at."""
    found = [window_hashes(hashes(words[a:b + window]), window) for a, b in zip(ranges[::2], ranges[1::2], strict=True)]
    return np.concatenate([one for one, _ in found]), np.concatenate([two for _, two in found])


def verified_windows(texts: DataFrame, window: int) -> DataFrame:
    """(digest, id, ones, twos): hashes of the windows of a text that also begin in a document of a smaller id."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for pdf in batches:
            ones, twos, ids, digests = [], [], [], []
            for id_, digest, ranges, text in zip(pdf["id"], pdf["digest"], pdf["ranges"], pdf["text"], strict=True):
                one, two = stretches(hashes, text.split(), ranges, window)
                # a window that a text repeats is one row (or a few, if hashes collide)
                order = np.argsort(one)
                one, two = one[order], two[order]
                new = np.append(True, (one[1:] != one[:-1]) | (two[1:] != two[:-1]))
                ones.append(one[new])
                twos.append(two[new])
                ids += [id_] * len(ones[-1])
                digests += [digest] * len(ones[-1])
                if len(ids) >= WINDOWS_AT_ONCE:
                    yield pd.DataFrame({"one": np.concatenate(ones), "two": np.concatenate(twos), "id": ids, "digest": digests})
                    ones, twos, ids, digests = [], [], [], []
            if ids:
                yield pd.DataFrame({"one": np.concatenate(ones), "two": np.concatenate(twos), "id": ids, "digest": digests})

    windows = texts.mapInPandas(run, "one long, two long, id long, digest binary")
    least = windows.groupBy("one", "two").agg(F.min("id").alias("least"), F.max("id").alias("most")).filter("least < most")
    later = windows.join(least.drop("most"), ["one", "two"]).filter("id > least")
    return later.groupBy("digest", "id").agg(F.collect_list("one").alias("ones"), F.collect_list("two").alias("twos"))


def cut_texts(texts: DataFrame, repeated: DataFrame, window: int) -> DataFrame:
    """(digest, id, removed, kept) of the texts with windows to cut out: words removed, digest of what is left."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for pdf in batches:
            removed, kept = [], []
            for text, ranges, ones, twos in zip(pdf["text"], pdf["ranges"], pdf["ones"], pdf["twos"], strict=True):
                words = text.split()
                one, two = stretches(hashes, words, ranges, window)
                known = set(zip(ones.tolist(), twos.tolist(), strict=True))
                at = candidate_places(ranges)[[pair in known for pair in zip(one.tolist(), two.tolist(), strict=True)]]
                out = covered(at, at + window - 1, len(words))
                removed.append(int(out.sum()))
                kept.append(hashlib.sha256(b" ".join(w for w, o in zip(words, out.tolist(), strict=True) if not o)).hexdigest())
            yield pd.DataFrame({"digest": pdf["digest"], "id": pdf["id"], "removed": removed, "kept": kept})

    rows = texts.join(repeated, ["digest", "id"])
    return rows.mapInPandas(run, "digest binary, id long, removed long, kept string").dropDuplicates(["digest", "id"])


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """id, n_words, n_removed, kept_sha256 of every row, after the words of each window of ``window`` words
    that also begins in a document with a smaller id are taken out."""
    parsed = checkpointed(parsed_texts(docs, id_col, text_col, window))
    # equal texts: the smallest id owns the text, the other rows lose all of it
    copies = checkpointed(parsed.groupBy("digest").agg(F.min("id").alias("owner"), F.count(F.lit(1)).alias("rows"))
                          .filter("rows > 1").select("digest", "owner"))
    copies = narrow(copies, copies.count())
    placed = parsed.join(copies, "digest", "left").withColumn("owner", F.coalesce("owner", "id"))
    owners = parsed.filter("names is not null").join(copies, "digest", "left").filter(F.coalesce("owner", "id") == F.col("id"))
    symbols = owners.select("digest", "id", F.posexplode("names").alias("place", "name"))
    shared = (symbols.groupBy("name").agg(F.min("id").alias("least"), F.max("id").alias("most"))
              .filter("least < most").select("name"))
    shared = symbols.join(shared, "name").groupBy("digest", "id").agg(F.collect_set("place").alias("places"))
    ranges = checkpointed(open_windows(owners, shared, window))
    text = text_or_empty(text_col)
    rows = docs.select(F.coalesce(F.col(id_col), F.lit(NO_ID)).cast("long").alias("id"), node_of(text).alias("digest"),
                       text.cast("binary").alias("text"))
    n_open = ranges.count()
    texts = checkpointed(rows.join(F.broadcast(ranges) if n_open <= BROADCAST_TEXTS else ranges, ["digest", "id"]))
    cut = checkpointed(cut_texts(texts, verified_windows(texts, window), window))
    released(texts, ranges)
    cut = narrow(cut, cut.count())
    copy = (F.col("owner") < F.col("id")) & (F.col("n_words") >= window)
    return placed.drop("names", "first", "last", "bare").join(cut, ["digest", "id"], "left").select(
        F.when(~F.col("no_id"), F.col("id")).alias(id_col), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))


def op13_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
with words as (
  select rowid as doc, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from
    (select row_number() over () as rowid, doc_id, text from documents)),
windows as (
  select doc, doc_id, i, array_to_string(list_slice(w, i, i + 49), ' ') as body
  from words, unnest(range(1, greatest(len(w) - 48, 1))) as t(i)),
least as (select body, min(doc_id) as least from windows group by body),
later as (
  select doc, i from windows join least using (body) where least < coalesce(doc_id, 9223372036854775807)),
parts as (select doc, j, w[j] as word from words, unnest(range(1, len(w) + 1)) as t(j)),
marked as (
  select parts.doc, j, word, max(i) over (partition by parts.doc order by j rows between 49 preceding and current row) is not null as gone
  from parts left join later on later.doc = parts.doc and later.i = parts.j),
cut as (
  select doc, count_if(gone) as n_removed, string_agg(word, ' ' order by j) filter (not gone) as kept
  from marked group by doc)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from words left join cut using (doc)
"""
