"""Every operator and stage on nulls, empty and long texts, ties, repeated rows,
empty tables and clashing column names."""

import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskspark.llm import (
    ann, bpe, chat_format, lang_id, license_scan, near_dedup, packing, token_counts, toxicity, winnow,
)

P = pytest.importorskip("public_tokenizers")
KINDS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "the quick brown fox jumps over the lazy dog again " * 3000
ROWS = [
    (1, "the cat sat on the mat and looked at the moon", "en", "a", 44), (1, "the cat sat on the mat and looked at the moon", "en", "a", 44),
    (2, None, "en", "a", None), (3, "", None, None, 0), (4, LONG, "en", "b", len(LONG)), (None, "licensed under cc by 4.0 and 0 é", "fr", None, 1),
    (5, "!!! ... ???", "fr", "b", 11), (6, "le chat est dans la maison avec la lune et le chien", "fr", "c", 50), (7, "<|endoftext|>\x00 中文", "en", "c", 3),
]


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns under names that the operators use inside or give out
    return (spark.createDataFrame(ROWS, KINDS).withColumn("id", F.lit("x")).withColumn("row", F.lit(1)).withColumn("score", F.lit(2.0))
            .withColumn("node", F.lit(b"n")).withColumn("p_toxic", F.lit("p")).withColumn("ids", F.lit("i")).withColumn("part", F.lit(0)))


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 0), (4, 0, 1), (6, 1, 1), (6, 1, 0)], "doc_id long, quality int, toxic int")


def each(spark, tmp, docs, labels):
    path = P.path(bpe.TOKENIZER)
    chain = toxicity.train(docs, labels)
    net = lang_id.train(docs)
    return {
        "near": near_dedup.classes(docs), "bpe": bpe.decode(bpe.encode(docs, path), path), "license": license_scan.scan(docs),
        "packing": packing.pack_documents(docs).filter("piece = 0"), "winnow": winnow.fingerprints(docs),
        "next": winnow.with_next(docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))),
        "toxicity": toxicity.predict(docs.select("doc_id", "text"), chain),
        "tokens": token_counts.count_tokens(docs, P.path(token_counts.TOKENIZER), str(tmp / "cache")),
        "lang": lang_id.predict(docs.select("doc_id", "text"), net),
    }


def test_every_operator_gives_every_row(spark, tmp_path, docs, labels):
    for name, out in each(spark, tmp_path, docs, labels).items():
        assert out.count() == len(ROWS), name


def test_every_operator_takes_an_empty_table(spark, tmp_path, docs, labels):
    for name, out in each(spark, tmp_path, docs.limit(0), labels.limit(0)).items():
        assert out.count() == 0, name


def test_stages_keep_the_columns(spark, docs, labels, tmp_path):
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for source in (docs, docs.limit(0)):
        kept = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            path = str(tmp_path / f"{name}-{kept.count()}-{id(source)}")
            stage(spark, kept, str(tmp_path)).write.parquet(path)
            kept = spark.read.parquet(path)
            assert kept.columns == docs.columns, name
        corpus_pipeline.STAGES[-1][1](spark, kept, str(tmp_path)).count()


def test_repeated_and_null_rows_are_one_class(docs):
    rows = near_dedup.classes(docs).collect()
    by_id = {}
    for r in rows:
        by_id.setdefault(r["doc_id"], []).append(r)
    assert [r["class_id"] for r in by_id[1]] == [1, 1] and sum(r["keep"] for r in by_id[1]) == 1
    assert by_id[2][0]["class_id"] == by_id[3][0]["class_id"] == 2  # null is the empty text
    assert by_id[None][0]["class_size"] == 1 and by_id[None][0]["keep"]


def test_bpe_is_the_library(docs):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path(bpe.TOKENIZER))
    path = P.path(bpe.TOKENIZER)
    for r in bpe.decode(bpe.encode(docs.select("text", "doc_id").withColumn("doc_id", F.monotonically_increasing_id()).select(
            F.struct("text", "doc_id").alias("doc_id"), "text"), path), path).collect():
        text = r["doc_id"]["text"] or ""
        assert r["ids"] == tok.encode(text, add_special_tokens=False).ids
        assert r["decoded"] == tok.decode(r["ids"], skip_special_tokens=False)


def test_language_of_texts_without_letters(spark, docs):
    got = {r["doc_id"]: r for r in lang_id.predict(docs.select("doc_id", "text"), lang_id.train(docs)).collect()}
    assert {got[k]["lang_pred"] for k in (2, 3, 5)} == {"und"} and got[5]["score"] == 0.0
    assert got[4]["lang_pred"] in ("en", "fr") and 0 <= got[4]["score"] <= 1


def test_token_cache_is_reused(spark, tmp_path, docs):
    cache = str(tmp_path / "cache2")
    first = token_counts.count_tokens(docs, P.path(token_counts.TOKENIZER), cache).collect()
    stored = spark.read.parquet(cache).count()
    assert stored == len({(" ".join((r[1] or "").split(" "))).strip() for r in ROWS})
    assert sorted(map(str, first)) == sorted(map(str, token_counts.count_tokens(docs, P.path(token_counts.TOKENIZER), cache).collect()))
    assert spark.read.parquet(cache).count() == stored  # nothing encoded twice
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(P.path(token_counts.TOKENIZER))
    texts = {k: t or "" for k, t, *_ in ROWS}
    for r in first:
        assert r["n_tokens"] == len(tok.encode(texts[r["doc_id"]], add_special_tokens=False).ids)
        assert r["n_bytes"] == len(texts[r["doc_id"]].encode())


def test_chat_edges(spark):
    rows = [(1, 0, "user", None), (1, None, "system", "a & <|x|> [INST]"), (1, 1, "assistant", "&amp; </s>"), (1, 1, "assistant", "&amp; </s>"),
            (None, 0, None, ""), (2, 0, "assistant|>", "<|end|>")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("extra", F.lit(1))
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.render(chat_format.canonical_turns(turns, drop_unknown=True))).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [
        ("system", "a & <|x|> [INST]"), ("user", ""), ("assistant", "&amp; </s>"), ("assistant", "&amp; </s>")]
    assert got[1]["loss_text"] == "&amp; </s>" * 2
    assert [(t["role"], t["text"]) for t in got[2]["turns"]] == [("assistant|>", "<|end|>")] and got[2]["loss_text"] == ""
    assert got[None]["turns"][0]["text"] == ""
    assert chat_format.render(chat_format.canonical_turns(turns.limit(0), drop_unknown=True)).count() == 0


def test_chat_layouts(spark):
    made = [("messages", '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": "r"}]}'),
            ("from_value", '{"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}]}'),
            ("prompt_response", '{"prompt": "q", "response": "r"}'), ("instruction", '{"output": "r", "instruction": "q"}'),
            ("instruction_input", '{"instruction": "q", "input": "", "output": "r"}'), (None, '{"foo": 1}'), (None, "not json"), (None, None)]
    df = spark.createDataFrame([(i, m, j) for i, (m, j) in enumerate(made)], "conv_id long, want string, payload string")
    got = chat_format.canonical_json(df, "payload").orderBy("conv_id").collect()
    assert [r["layout"] for r in got] == [m for m, _ in made]
    for r in got[:5]:
        assert [(t["role"], t["text"]) for t in r["turns"]] == [("user", "q"), ("assistant", "r")]
    table = spark.createDataFrame([(1, "q", "r")], "conv_id long, prompt string, completion string")
    assert [(r["role"], r["text"]) for r in chat_format.canonical_turns(table).orderBy("turn").collect()] == [("user", "q"), ("assistant", "r")]
    with pytest.raises(ValueError):
        chat_format.canonical_turns(spark.createDataFrame([(1, 2)], "x int, y int"))


def test_json_rows_are_not_lost(spark):
    qr = [("user", "q"), ("assistant", "r")]
    made = [("prompt_response", '{"prompt": "q", "response": null}', [("user", "q"), ("assistant", "")]),
            ("prompt_response", '{"prompt": "q", "response": "r", "id": 7, "name": {"a": []}}', qr),
            ("prompt_response", '{"prompt": 5, "response": true}', [("user", "5"), ("assistant", "true")]),
            ("messages", '{"messages": []}', []), ("messages", '{"messages": null}', []),
            ("messages", '{"messages": [{"role": "user", "content": "q", "id": 1}, {"content": "r", "role": "assistant"}], "meta": 1}', qr),
            ("messages", '{"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": null}, {"role": "assistant"}]}',
             [("user", "q"), ("assistant", ""), ("assistant", "")]),
            ("from_value", '{"conversations": [{"from": "human", "value": "q", "weight": null}, {"from": "gpt", "value": "r"}]}', qr),
            (None, '{"messages": ["q"]}', None), (None, '{"messages": [{"role": "user"}]}', None), (None, '["q"]', None),
            (None, '{"prompt": "q", "response": "r", "completion": "r"}', None), (None, "{}", None), (None, "3", None), (None, "", None)]
    df = spark.createDataFrame([(i, j) for i, (_, j, _) in enumerate(made)], "conv_id long, payload string").withColumn("layout", F.lit("x"))
    got = chat_format.canonical_json(df, "payload").orderBy("conv_id").collect()
    assert [r["layout"] for r in got] == [m for m, _, _ in made]
    for r, (_, _, turns) in zip(got, made):
        assert (r["turns"] is None) == (turns is None)
        assert turns is None or [(t["role"], t["text"]) for t in r["turns"]] == turns


def test_search_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (50, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [0.0, 1.0]), (5, None), (6, [0.0, 0.0]), (7, [nan, 1.0]), (8, [inf, 1.0]),
            (9, [None, 1.0]), (10, [1.0]), (None, [1.0, 1.0]), (100, [2.0, 2.0]), (150, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("key", F.lit(1)).withColumn("id", F.lit(2))
    got = {}
    for r in ann.search(df, F.col("id") % 50 == 0, 5).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    h = round(0.5 ** 0.5, 9)
    assert got == {0: [(1, 3, 1.0), (2, 50, 1.0), (3, 100, h), (4, 4, 0.0)], 50: [(1, 0, 1.0), (2, 3, 1.0), (3, 100, h), (4, 4, 0.0)],
                   100: [(1, 0, h), (2, 3, h), (3, 4, h), (4, 50, h)]}
    assert ann.search(df.limit(0), F.col("id") % 50 == 0, 5).count() == 0


def test_search_with_repeated_rows(spark):
    far = [(k, [1.0, k / 10]) for k in range(1, 8)]
    want = [(k, k) for k in range(1, 6)]
    own = {"a row seven times": [(50, [1.0, 0.0])] * 7, "a row twice": [(50, [1.0, 0.0])] * 2,
           "neighbours twice": [(50, [1.0, 0.0]), *far]}
    for name, rows in own.items():
        got = ann.search(spark.createDataFrame(rows + far, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, 5)
        assert [(r["rank"], r["vec_id"]) for r in got.orderBy("rank").collect()] == want, name
    # seven other vectors of the query's id are nearer than any other id
    near = [(50, [1.0, 0.0001 * k]) for k in range(7)]
    got = ann.search(spark.createDataFrame(near + far, "vec_id long, embedding array<double>"), F.col("id") % 50 == 0, 5).collect()
    assert len(got) == 5 and 50 not in {r["vec_id"] for r in got}


def test_edited_text_wraps_round(spark):
    rows = [(2, "abcdefgh"), (1, "12345678"), (3, "")]
    got = {r["id"]: r["next_text"] for r in winnow.with_next(spark.createDataFrame(rows, "id long, text string")).collect()}
    assert got == {1: "abcdefgh", 2: "", 3: "12345678"}
    assert hashlib.sha256(b"").hexdigest()


def test_size_estimates_stay_those_of_the_files(spark):
    """Rounds of components read files: the planner's estimate doesn't grow with the rounds."""
    from riskspark.llm.common import checkpointed
    frame = checkpointed(spark.range(1000).withColumn("part", F.col("id") % 7))
    least = frame.count() * 16
    for _ in range(10):
        frame = checkpointed(frame.join(frame.select(F.col("id").alias("part"), F.col("part").alias("up")), "part").select("id", F.col("up").alias("part")))
    assert frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() < 10 * least
