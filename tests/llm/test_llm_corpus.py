"""Spelling variants, ranked search and repeated passages against brute force and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from riskspark.llm import ranked_search, repeats, spelling

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def by_sql(sql):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return sorted(con.execute(sql).fetchall(), key=repr)


def odd(spark, rows_, types="doc_id long, text string"):
    """Rows with extra columns under names that the operators use inside."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows_, types)
    for c in ("id", "word", "n", "m", "term", "terms", "digest", "place", "rank", "score", "key", "names"):
        df = df.withColumn(c, F.lit("x"))
    return df


# spelling

def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    p = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[p + 1:] == b[p + 1:] if len(a) == len(b) else a[p:] == b[p + 1:]


def variants_of(counts):
    form, near = {}, {}
    for w, n in counts.items():
        near[w] = [o for o in counts if one_edit(w, o)]
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        if best and counts[best] >= 10 * n:
            form[w] = best
    def root(w):
        while w in form:
            w = form[w]
        return w
    return sorted(((w, form.get(w), root(w), n, len(near[w]), counts[form[w]] if w in form else None) for w, n in counts.items()), key=repr)


def test_vocabulary_is_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = Counter()
    for r in docs.collect():
        for w in re.findall("[A-Za-zÀ-ÿ]+", r.text or ""):
            w = w.translate(LOWER)
            h = zlib.crc32(f"{r.doc_id}:{w}".encode())
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += len(w) >= 7
    want = sorted((w, n) for w, n in counts.items() if n >= 2)
    assert rows(spelling.vocabulary(docs)) == want


@pytest.mark.parametrize("block", [3, 1024])
def test_variants_are_brute_force(spark, block):
    rng = random.Random(block)
    counts = {}
    for _ in range(60):  # families of words, with short ones, long runs of one letter and letters beyond ASCII
        base = "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
        for _ in range(8):
            w = list(base)
            for _ in range(rng.randint(0, 2)):
                i = rng.randint(0, len(w))
                w[i:i + rng.randint(0, 1)] = [rng.choice("abéz")] * rng.randint(0, 1)
            if w:
                counts["".join(w)] = rng.choice([1, 2, 20, 25, 300, 4000])
    got = spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), block=block)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows(got) == variants_of(counts)


def test_forms_lead_to_the_last(spark):
    counts = {"abcdefgh": 1, "abcdefgx": 10, "abcdefyx": 100, "abcdezyx": 1000, "abcdexyx": 1000, "qqqqqqqq": 5}
    got = {r.word: r.root for r in spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}
    assert got["abcdefgh"] == "abcdexyx" and got["abcdezyx"] == "abcdezyx" and got["qqqqqqqq"] == "qqqqqqqq"


def test_spelling_edges(spark):
    text = "Wonderful wonderful WONDERFUL wonderfull Étonnant Étonnant short"
    docs = odd(spark, [(1, text), (1, text), (2, None), (3, ""), (None, "wonderful " * 5000)])
    got = {r.word: r for r in spelling.variants(spelling.vocabulary(docs)).collect()}
    assert "Étonnant" in got and "étonnant" not in got  # A-Z alone are lower-cased
    assert got["wonderful"].n >= 5000 or got["wonderful"].n == 6
    assert rows(spelling.variants(spelling.vocabulary(docs.limit(0)))) == []


# search

def test_search_is_sql(spark):
    from riskspark.llm.common import table
    want = by_sql(ranked_search.OP12_SQL)
    got = ranked_search.search(table(spark, SF, "documents"), table(spark, SF, "benchmark"))
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert rows(got) == want


def test_thresholds_and_strata_lose_nothing(spark, monkeypatch):
    """Small first visits, a first pass for thresholds, several blocks of queries and few rows a shard."""
    from riskspark.llm.common import table
    monkeypatch.setattr(ranked_search, "FIRST_VISIT", 2)
    monkeypatch.setattr(ranked_search, "FIRST_ROWS", 60)
    monkeypatch.setattr(ranked_search, "QUERY_BLOCK", 17)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "9")
    try:
        got = rows(ranked_search.search(table(spark, SF, "documents"), table(spark, SF, "benchmark")))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == by_sql(ranked_search.OP12_SQL)


def test_bounds_hold():
    import numpy as np
    rng = np.random.default_rng(5)
    terms = [np.unique(rng.integers(0, 12, rng.integers(1, 8))) for _ in range(200)]
    tfs = [rng.integers(1, 6, len(t)) for t in terms]
    m = rng.integers(50, 60, 200)
    shard = ranked_search.Shard(m, np.array(terms, object), np.array(tfs, object), 12)
    for asked in ([0], [1, 5, 7], list(range(12))):
        weights = [100 * (t + 1) for t in asked]
        score = np.array([sum(w * (10**9 * f // (1000 * f + 20 * mm)) for t, w in zip(asked, weights) for tt, f in zip(ts, fs) if tt == t)
                          for ts, fs, mm in zip(terms, tfs, m.tolist())])
        bound = shard.bounds(asked, weights)
        assert all(score[shard.stratum == s].max() <= bound[s] for s in range(len(bound)))
        found, got = shard.search(asked, weights, np.arange(200), 0, 10)
        order = sorted(range(200), key=lambda i: (-score[i], i))[:10]
        assert dict(zip(found.tolist(), got.tolist())) == {i: score[i] for i in order if score[i] > 0}


def test_search_edges(spark):
    docs = odd(spark, [(2, "Cat É sat"), (1, "cat É sat"), (1, "cat É sat"), (None, "cat É sat"), (3, None), (4, ""), (5, "dog " * 9000), (6, "...")])
    items = odd(spark, [(7, "CAT"), (7, "É"), (8, None), (None, "dog"), (9, "é absent")], "item_id long, text string")
    got = ranked_search.search(docs, items).collect()
    assert [(r.rank, r.doc_id) for r in sorted(got, key=lambda r: r.rank) if r.item_id == 7] == [(1, 1), (2, 1), (3, 2), (4, None)]
    assert [(r.rank, r.doc_id) for r in got if r.item_id is None] == [(1, 5)]
    assert {r.item_id for r in got} == {7, None}
    assert ranked_search.search(docs.limit(0), items).collect() == [] and ranked_search.search(docs, items.limit(0)).collect() == []


# repeats

def cut(docs, window):
    """(doc_id, n_words, n_removed, kept) of each (doc_id, text)."""
    split = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
    least = defaultdict(lambda: float("inf"))
    order = lambda i: float("inf") if i is None else i
    for i, t in docs:
        w = split(t)
        for k in range(len(w) - window + 1):
            body = tuple(w[k:k + window])
            least[body] = min(least[body], order(i))
    out = []
    for i, t in docs:
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if least[tuple(w[k:k + window])] < order(i):
                gone[k:k + window] = [True] * window
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repeats_are_sql(spark):
    from riskspark.llm.common import table
    got = repeats.cut_repeats(table(spark, SF, "documents"))
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert rows(got) == by_sql(repeats.OP13_SQL)


@pytest.mark.parametrize("window", [10, 50])
def test_repeats_are_brute_force(spark, window):
    """Few words, long runs, periods and shared passages of about a window, at all places."""
    rng = random.Random(window)
    word = lambda k: rng.choice(["a", "b", "A", "é", " "][:k])
    passages = [[word(5) for _ in range(window + d)] for d in (-1, 0, 1, 7, 40)] + [["a"] * 90, ["a", "b"] * 50, ["a", "b", "a"] * 40]
    docs = []
    for i in range(120):
        w = []
        for _ in range(rng.randint(0, 4)):
            w += [f"w{rng.randint(0, 400)}" for _ in range(rng.randint(0, 30))] if rng.random() < 0.6 else [word(2) for _ in range(rng.randint(0, 20))]
            p = rng.choice(passages)
            a = rng.randint(0, 3)
            w += p[a:len(p) - rng.randint(0, 3)]
        docs.append((rng.choice([i, i, i, 7, None]), rng.choice([" ", "\n", "\t \x0b"]).join(w)))
    docs += docs[:9] + [(i, t) for i, (_, t) in enumerate(docs[20:40])] + [(500, None), (501, "")]
    got = repeats.cut_repeats(odd(spark, docs), window=window)
    assert rows(got) == cut(docs, window)


def test_windows_hold_the_same_symbols_wherever_they_stand():
    """What a symbol's range promises: a window that it covers has it in every text."""
    import numpy as np
    rng = np.random.default_rng(3)
    for _ in range(40):
        passage = rng.integers(0, rng.choice([2, 5, 1000]), 60).astype(np.uint64)
        around = [np.concatenate((rng.integers(0, 5, rng.integers(0, 40)).astype(np.uint64), passage, rng.integers(0, 5, rng.integers(0, 40)).astype(np.uint64)))
                  for _ in range(2)]
        at = [next(i for i in range(len(a)) if (a[i:i + 60] == passage).all()) for a in around]
        held = []
        for words, begin in zip(around, at):
            (name, first, last), = repeats.symbol_ranges(words, np.array([len(words)]))
            ok = (first <= begin) & (begin <= last)
            held.append(sorted(name[ok].tolist()))
        # ranges cut at a text's ends may hold more symbols, never others
        assert held[0] == held[1]


def test_repeats_edges(spark):
    long = " ".join(f"w{i}" for i in range(60))
    docs = [(1, long), (1, long), (2, long + " end"), (None, long), (None, long), (3, None), (4, ""), (5, "one"), (6, ("x " * 30000).strip()), (7, "x " * 50)]
    got = repeats.cut_repeats(odd(spark, docs))
    assert rows(got) == cut(docs, 50)
    assert repeats.cut_repeats(odd(spark, docs).limit(0)).collect() == []


def test_pipeline_gives_python_workers_small_batches(spark, tmp_path):
    """Whole texts go to Python a few at a time, whatever the session's batches are."""
    import corpus_pipeline
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    docs = spark.range(0, 5_000, 1, 1).selectExpr("id as doc_id", "concat('text ', id) as text", "'a' as source")
    corpus_pipeline.packing_stage(spark, docs, str(tmp_path))
    sizes = docs.mapInPandas(lambda pdfs: (pdf[["doc_id"]].assign(doc_id=len(pdf)) for pdf in pdfs), "doc_id long").distinct().collect()
    assert max(r.doc_id for r in sizes) <= corpus_pipeline.BATCH_ROWS < 10_000
