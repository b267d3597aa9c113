"""The operators' methods against brute force, exact round trips and held-out accuracy."""

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from riskspark.llm import ann, bpe, lang_id, license_scan, near_dedup, packing, toxicity, winnow

SF = "/root/testdata/sf0.001"


def documents(spark):
    return [(r["doc_id"], r["text"] or "") for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]


def test_rare_buckets_keep_long_texts_beside_short_ones(spark):
    """Every run of two near copies also stands alone in a text of one run, for which the copies have no room."""
    words = near_dedup.Words()
    text = [f"w{i}" for i in range(24)]
    texts = [" ".join(text), " ".join([*text[:23], "other"])] + [" ".join(text[i:i + 5]) for i in range(20)]
    assert near_dedup.alike(words(texts[0]), words(texts[1]))
    rows = [(bytes([i]), words(t).astype(near_dedup.WORD).tobytes()) for i, t in enumerate(texts)]
    nodes = spark.createDataFrame([(n, 0) for n, _ in rows], "node binary, mates long")
    parts = spark.createDataFrame([(n, n) for n, _ in rows], "node binary, part binary")
    got = near_dedup.rare_buckets(nodes, spark.createDataFrame(rows, "node binary, words binary"), parts).collect()
    buckets = [{r["bucket"] for r in got if bytes(r["node"]) == bytes([i])} for i in (0, 1)]
    assert buckets[0] & buckets[1]
    short = {r["n_runs"] for r in got if bytes(r["node"]) > bytes([1])}
    assert short <= {1}


def test_a_group_of_copies_makes_no_pairs_of_its_own(spark):
    """A bucket with a large component and two texts beside it: only they lead."""
    nodes = [bytes([i]) for i in range(60)]
    rows = [(7, n, 1000 - i, 20, 1, len(nodes)) for i, n in enumerate(nodes)]
    buckets = spark.createDataFrame(rows, "bucket long, node binary, mates long, n_runs int, place int, size long")
    parts = spark.createDataFrame([(n, nodes[0] if i < 58 else n) for i, n in enumerate(nodes)], "node binary, part binary")
    marked = near_dedup.leading(buckets, parts, 16)
    leads = {bytes(r["node"]) for r in marked.filter("leads").collect()}
    assert leads and leads <= set(nodes[58:])
    pairs = {frozenset((bytes(r["a"]), bytes(r["b"]))) for r in near_dedup.many_led_pairs(marked).collect()}
    want = {frozenset((a, b)) for a in leads for b in nodes if a != b}
    assert pairs == want


def test_near_dedup_is_brute_force(spark):
    rows = documents(spark)
    words = near_dedup.Words()
    runs = [near_dedup.labelled_runs(words(t)) for _, t in rows]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if rows[i][1] == rows[j][1] or (len(runs[i]) and len(runs[j]) and near_dedup.jaccard(runs[i], runs[j]) >= 0.8
                                            and near_dedup.alike(words(rows[i][1]), words(rows[j][1]))):
                part[max(find(i), find(j))] = min(find(i), find(j))
    want = {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}
    got = entry.queries()["op1_near_dedup"](spark, SF).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert sum(r["keep"] for r in got) == len(set(want.values()))


def test_near_copies_of_a_large_group_join(spark):
    """Edited copies of one text, and texts that only share a passage."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    passage = [f"p{k}" for k in range(60)]
    rows = []
    for i in range(120):
        copy = list(base)
        for k in rng.sample(range(200), 3):
            copy[k] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(copy)))
    for i in range(120, 240):
        rows.append((i, " ".join(passage + [f"y{rng.randrange(10**9)}" for _ in range(40)])))
    rows.append((240, " ".join(base)))
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    by = {r["doc_id"]: r for r in got}
    assert {by[i]["class_id"] for i in range(120)} == {0} and by[240]["class_id"] == 0
    assert all(by[i]["class_size"] == 1 for i in range(120, 240))


def near_classes(rows):
    """The class of each row by brute force."""
    words = near_dedup.Words()
    found = [words(t) for _, t in rows]
    runs = [near_dedup.labelled_runs(w) for w in found]
    part = list(range(len(rows)))

    def find(x):
        while part[x] != x:
            x = part[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if find(i) != find(j) and near_dedup.jaccard(runs[i], runs[j]) >= 0.8 and near_dedup.alike(found[i], found[j]):
                part[max(find(i), find(j))] = min(find(i), find(j))
    return {rows[i][0]: rows[find(i)][0] for i in range(len(rows))}


def test_family_without_its_base_is_brute_force(spark):
    """Copies at about 0.8 of each other, with no text near them all to lead a bucket."""
    rng = random.Random(1)
    base = [f"w{rng.randrange(3000)}" for _ in range(200)]
    rows = []
    for i in range(150):
        copy = list(base)
        for k in rng.sample(range(200), rng.randint(2, 4)):
            copy[k] = f"x{rng.randrange(10**9)}"
        rows.append((i, " ".join(copy)))
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == near_classes(rows)


def test_short_texts_are_brute_force(spark):
    """Texts of 1 to 30 words, each also with one word before or after it."""
    rng = random.Random(2)
    texts = []
    for n in list(range(1, 31)) * 4:
        t = [f"v{rng.randrange(10**6)}" for _ in range(n)]
        texts += [t, ["more"] + t if rng.random() < 0.5 else t + ["more"]]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    want = near_classes(rows)
    assert all(want[i] == want[i + 1] for i in range(0, len(rows), 2) if 8 <= len(texts[i]))
    got = near_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_banded_edits_is_edit_distance():
    rng = random.Random(0)

    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    for _ in range(500):
        a = [rng.randrange(4) for _ in range(rng.randrange(14))]
        b = [x for x in a if rng.random() > 0.15]
        b.insert(rng.randrange(len(b) + 1), 7)
        band, want = rng.randrange(9), plain(a, b)
        assert near_dedup.banded_edits(np.array(a), np.array(b), band) == (want if want <= band else band + 1)


def test_bpe_round_trip_and_library():
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = P.path(bpe.TOKENIZER)
    codec, tok = bpe.Codec(open(path, "rb").read()), Tokenizer.from_file(path)
    rng = random.Random(2)
    alphabet = "aaabbb  eetheing   \n\t.,!'sdé中🎉 \x1c\x85 À1234½<|endoftext|>==="
    for _ in range(1500):
        text = "".join(rng.choice(alphabet) if rng.random() < 0.8 else rng.choice([" the", "<|endoftext|>", "isn't", "aaaaaaaa", "       ", "́"])
                       for _ in range(rng.randrange(40)))
        ids = codec.encode(text)
        assert ids.tolist() == tok.encode(text, add_special_tokens=False).ids
        assert codec.decode(ids) == text


def test_bpe_memories_stay_bounded(monkeypatch):
    """Two small generations of words and a small table give the same ids; frequent words outlive a change; workers that
    decode build no automaton."""
    P = pytest.importorskip("public_tokenizers")
    spec = open(P.path(bpe.TOKENIZER), "rb").read()
    codec = bpe.Codec(spec)
    monkeypatch.setattr(bpe, "WORD_MEMORY", 50)
    monkeypatch.setattr(bpe, "TABLE_MEMORY", 300)
    small, plain = bpe.Codec(spec), codec.automaton.encode_word
    walked = []
    monkeypatch.setattr(small.automaton, "encode_word", lambda w: walked.append(w) or plain(w))
    rng = random.Random(3)
    for _ in range(300):
        text = " the" + "".join(" " + "".join(rng.choices("abcdetho", k=rng.randrange(1, 9))) for _ in range(10))
        ids = small.encode(text)
        assert ids.tolist() == codec.encode(text).tolist()
        assert max(len(small.memory), len(small.older)) <= 50
        assert bpe.decoded(bpe._labels(spec), ids) == text
    assert walked.count(b" the") == 1
    with monkeypatch.context() as m:
        m.setattr(bpe, "Automaton", None)
        bpe._LABELS.clear()
        assert bpe._labels(spec) == codec.automaton.labels


def test_bpe_gadgets_on_small_merges():
    """All words over few letters, against merging by rank."""
    from itertools import product
    merges = [["a", "a"], ["a", "b"], ["aa", "a"], ["ab", "a"], ["b", "b"], ["aa", "ab"], ["aba", "b"], ["aa", "aa"]]
    names = ["a", "b", *["".join(m) for m in merges]]
    vocab = {x: i for i, x in enumerate(dict.fromkeys(names))}
    auto = bpe.Automaton({"vocab": vocab, "merges": merges})
    rank = {tuple(m): i for i, m in enumerate(merges)}
    for n in range(1, 9):
        for word in product("ab", repeat=n):
            parts = list(word)
            while True:
                best = min(((rank[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in rank), default=None)
                if best is None:
                    break
                pair, out, i = merges[best[0]], [], 0
                while i < len(parts):  # all places of the pair, from the left
                    if parts[i:i + 2] == pair:
                        out.append("".join(pair))
                        i += 2
                    else:
                        out.append(parts[i])
                        i += 1
                parts = out
            assert auto.encode_word("".join(word).encode()) == [vocab[p] for p in parts]


def test_license_base_is_brute_force(spark):
    got = {r["doc_id"]: r for r in entry.queries()["op3_licenses"](spark, SF).collect()}
    for doc_id, text in documents(spark):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
        places = [(i, label) for phrase, label in license_scan.PHRASES.items() for i in range(len(words))
                  if words[i:i + len(phrase.split())] == phrase.split()]
        r = got[doc_id]
        assert (r["n_words"], r["n_base"]) == (len(words), len(places))
        assert (r["first_word"], r["last_word"]) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert r["base_labels"] == ",".join(sorted({x for _, x in places}))
        assert {x for _, x in places} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_license_rules_and_suppression():
    s = license_scan.Scanner()
    assert len(s.rules) > 200
    labels = lambda t: [x[3] for x in s.scan(t)["detections"]]
    assert labels("SPDX-License-Identifier: MIT") == ["mit"]
    assert labels("Licensed under the Apache License, Version 2.0.") == ["apache-2.0"]  # contains the shorter names
    assert labels("GNU General Public License, version 3") == ["gpl-3.0"]
    assert labels("a clean text about a permit") == []
    assert license_scan.resolve([(1, 0, 10, "a", 1.0), (2, 2, 8, "b", 1.0), (1, 3, 5, "c", 1.0), (2, 2, 8, "b", 1.0)]) == [
        (1, 0, 10, "a", 1.0), (2, 2, 8, "b", 1.0)]


def test_packing_is_best_fit_with_conflicts():
    def plain(lengths, sources, clusters, capacity):
        bins, out = [], []
        for n, s, c in zip(lengths, sources, clusters, strict=True):
            fit = [(b[0], i) for i, b in enumerate(bins) if b[0] >= n and not (s >= 0 and s in b[1]) and not (c >= 0 and c in b[2])]
            i = min(fit)[1] if fit else len(bins)
            if not fit:
                bins.append([capacity, set(), set()])
            bins[i][0] -= n
            bins[i][1].add(s)
            bins[i][2].add(c)
            out.append(i)
        return out

    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(40)
        lengths = sorted((rng.randrange(0, 30) for _ in range(n)), reverse=True)
        sources, clusters = [rng.randrange(-1, 5) for _ in range(n)], [rng.randrange(-1, 8) for _ in range(n)]
        assert packing.pack(lengths, sources, clusters, 30) == plain(lengths, sources, clusters, 30)


def test_packing_keeps_every_word(spark):
    rows = entry.queries()["op5_packing"](spark, SF).collect()
    words = defaultdict(int)
    room = defaultdict(int)
    for r in rows:
        words[r["doc_id"]] += r["n_words"]
        room[r["shard"], r["bin"]] += r["n_words"]
    assert words == {d: len(re.findall(r"\S+", t)) for d, t in documents(spark)}
    assert max(room.values()) <= packing.CAPACITY and all(r["bin_words"] == room[r["shard"], r["bin"]] for r in rows)


def test_winnowing_is_brute_force(spark):
    rows = [(d, t) for d, t in documents(spark) if len(t) < 4000][:40]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashes = {r["w"]: r["h"] for r in df.select(F.explode(F.split(F.lower("text"), r"[^\p{L}\p{N}]+")).alias("w"))
              .select("w", F.pmod(F.xxhash64("w"), F.lit(winnow.PRIME)).alias("h")).distinct().collect()}
    got = {r["doc_id"]: [(p["hash"], p["position"]) for p in r["picks"]] for r in winnow.fingerprints(df).collect()}
    for doc_id, text in rows:
        h = [hashes[w] for w in re.findall(r"[^\W_]+", text.lower()) if w in hashes]
        grams = [sum(h[i + j] * pow(winnow.BASE, winnow.K - 1 - j, winnow.PRIME) for j in range(winnow.K)) % winnow.PRIME
                 for i in range(len(h) - winnow.K + 1)]
        if len(grams) < winnow.W:
            continue
        want = []
        for i in range(len(grams) - winnow.W + 1):
            at = max(range(i, i + winnow.W), key=lambda k: (-grams[k], k))  # the rightmost smallest
            if not want or want[-1][1] != at + 1:
                want.append((grams[at], at + 1))
        assert got[doc_id] == want


def test_shared_passage_is_always_found(spark):
    rng = random.Random(4)
    make = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    passage = make(winnow.K + winnow.W - 1)
    rows = [(i, " ".join(make(rng.randrange(30)) + passage + make(rng.randrange(30)))) for i in range(30)]
    picks = [{p["hash"] for p in r["picks"]} for r in winnow.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()]
    assert all(a & b for a in picks for b in picks)


def test_toxicity_held_out():
    """Trained on half of made-up texts, right on the other half."""
    rng = np.random.default_rng(0)
    x = (rng.random((400, 30)) < 0.3).astype(np.float32)
    y = np.stack([x[:, 0] > 0, (x[:, 1] > 0) | (x[:, 0] * x[:, 2] > 0)], axis=1).astype(float)
    chain = toxicity.fit_chain([np.flatnonzero(r) for r in x[:200]], y[:200], np.arange(200) % toxicity.FOLDS, ("a", "b"), {str(i): i for i in range(30)})
    p = chain.predict([np.flatnonzero(r).tolist() for r in x[200:]])
    assert ((p[:, 0] > 0.5) == y[200:, 0]).mean() > 0.97 and ((p[:, 1] > 0.5) == y[200:, 1]).mean() > 0.9
    assert len(chain.models[1][2]) == 1 and chain.models[1][2][0] != 0  # the second model weighs the first's probability


def test_toxic_documents_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    chain = toxicity.train(docs, labels.filter("doc_id % 2 = 0"))
    rows = toxicity.predict(docs.select("doc_id", "text"), chain).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    said = [(r["p_toxic"] >= toxicity.THRESHOLD, r["toxic"] == 1) for r in rows]
    assert sum(a and not b for a, b in said) <= 0.005 * len(said)
    assert sum(a and b for a, b in said) >= 0.75 * sum(b for _, b in said)  # of about 2,000 training rows


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    net = lang_id.new_network(["a", "b", "c"], 4)
    for name in ("out", "bias"):
        setattr(net, name, getattr(net, name).astype(float))
    net.inputs, net.states = [x.astype(float) for x in net.inputs], [x.astype(float) for x in net.states]
    data, mask, y = rng.integers(97, 110, (7, 5)), np.ones((7, 5)), np.array([0, 1, 2, 1, 0])
    _, grads = lang_id.gradients(net, data, mask, y)
    for p, g in zip(net.params(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        p[at] += 1e-3
        up = lang_id.gradients(net, data, mask, y)[0]
        p[at] -= 2e-3
        down = lang_id.gradients(net, data, mask, y)[0]
        p[at] += 1e-3
        assert abs((up - down) / 2e-3 - g[at]) < 1e-3 * max(1, abs(g[at]))


def test_language_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = entry.queries()["op10_language"](spark, sf).join(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r["held_out"]]
    assert len(got) == 1000 and len(held) > 150
    assert sum(r["lang_pred"] == r["lang"] for r in held) >= 0.95 * len(held)


def test_search_recall(spark):
    sf = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").orderBy("vec_id").collect()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = defaultdict(set)
    for r in entry.queries()["op9_neighbours"](spark, sf).collect():
        found[r["query_id"]].add(r["vec_id"])
    hits = 0
    for q, got in found.items():
        s = x @ x[np.searchsorted(ids, q)]
        s[np.searchsorted(ids, q)] = -2
        hits += len(got & set(ids[np.lexsort((ids, -s))[:5]].tolist()))
    assert hits >= 0.9 * 5 * len(found) and len(found) == sum(ids % 50 == 0)


def test_router_parts_are_balanced():
    x = ann.unit(np.random.default_rng(0).normal(size=(1000, 8)))
    part = ann.balanced_parts(x, ann.neighbour_graph(x, 5), 8)
    assert np.bincount(part, minlength=8).max() <= 1.1 * 125 + 1


def license_example(items, rng, space):
    """A text that a parsed license expression matches."""
    from re import _constants as sre
    out = ""
    for op, value in items:
        if op is sre.LITERAL:
            out += chr(value)
        elif op is sre.SUBPATTERN:
            out += license_example(value[-1], rng, space)
        elif op is sre.BRANCH:
            out += license_example(rng.choice(value[1]), rng, space)
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
            out += "".join(license_example(value[2], rng, space) for _ in range(rng.randint(value[0], min(value[1], value[0] + 1))))
        elif op is sre.IN:
            kind, what = value[0]
            out += space if kind is sre.CATEGORY else chr(what[0] if kind is sre.RANGE else what)
        elif op is sre.ANY:
            out += "q"
    return out


def test_license_keywords_lose_no_match():
    from re import _parser
    rng, scanner = random.Random(3), license_scan.Scanner()
    for rule in scanner.rules:
        tree = _parser.parse(rule.pattern.pattern)
        for k in range(12):
            text = license_example(tree, rng, " \n"[k % 2]).encode("latin-1").decode()
            low = text.encode()
            assert rule.pattern.search(low), (rule, text)
            gated = scanner.scan(text)["detections"]
            found = [(r.priority, *m.span(), r.label, r.weight) for r in scanner.rules for m in r.pattern.finditer(low)]
            assert gated == license_scan.resolve(found), text
    for text, label in (("Creative Commons Attribution 4.0", "cc-by-4.0"), ("This End-User License Agreement", "proprietary")):
        assert label in {d[3] for d in scanner.scan(text)["detections"]}
