"""Token counts through a digest cache.

The cache is a Parquet folder of (tokenizer digest, content digest, count).
A text is normalised (runs of blanks become one, which the tokenizer does
itself, so the count stays), digested, and joined to the stored counts of
this tokenizer version. Only distinct misses are encoded, and their counts are
appended before the result is read from the cache.

Defined cases: a null text counts as the empty text (0 bytes, 0 tokens); a
repeated row gives a repeated result row; an empty table gives an empty
result; other columns of the input are not read, so their names don't matter.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskspark.llm.common import table, text_or_empty
from riskspark.session import ensure_checkpoint_dir

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Words whose counts a task remembers; the memory starts anew beyond them.
WORD_MEMORY = 300_000
CACHE_SCHEMA = "tokenizer string, digest string, n_tokens long"


def normalised(text: Column) -> Column:
    """Runs of blank, tab and line end become one blank: the tokenizer drops them."""
    return F.trim(F.regexp_replace(text, "[ \\t\\n\\r]+", " "))


def _stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """One count per digest of this tokenizer version (writers may have met)."""
    try:
        found = spark.read.schema(CACHE_SCHEMA).parquet(cache)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame([], CACHE_SCHEMA)
    return (found.filter(F.col("tokenizer") == version)
            .groupBy("digest").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """``id_col``, n_bytes, n_tokens of every row of ``docs``; appends to ``cache``."""
    spark = docs.sparkSession
    with open(tokenizer_path, "rb") as f:
        model = f.read()
    version = hashlib.sha256(model).hexdigest()
    shared = spark.sparkContext.broadcast(model)  # one vocabulary file, a few MB

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tok = Tokenizer.from_buffer(shared.value)
        tok.no_truncation()
        tok.no_padding()
        known: dict[str, int] = {}
        for pdf in batches:
            counts = []
            for text in pdf["content"]:
                # no token spans a blank, so the count of a text is the sum over its words
                words = text.split(" ")
                new = list({w for w in words if w not in known})
                if len(known) + len(new) > WORD_MEMORY:
                    known.clear()
                    new = list(set(words))
                for w, e in zip(new, tok.encode_batch_fast(new, add_special_tokens=False), strict=True):
                    known[w] = len(e.ids)
                counts.append(sum(map(known.__getitem__, words)))
            yield pd.DataFrame({"digest": pdf["digest"], "n_tokens": counts})

    content = text_or_empty(text_col)
    keyed = docs.select(F.col(id_col).alias("id"), F.octet_length(content).cast("long").alias("n_bytes"),
                        normalised(content).alias("content")).withColumn("digest", F.sha2("content", 256))
    misses = (keyed.select("digest", "content")
              .join(_stored(spark, cache, version), "digest", "left_anti").dropDuplicates(["digest"]))
    (misses.mapInPandas(encode, "digest string, n_tokens long")
     .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
     .write.mode("append").parquet(cache))
    return (keyed.select("id", "n_bytes", "digest").join(_stored(spark, cache, version), "digest", "left")
            .select(F.col("id").alias(id_col), "n_bytes", "n_tokens"))


def op8_token_counts(spark: SparkSession, sf_dir: str, cache: str | None = None) -> DataFrame:
    """Counts of all documents. Without ``cache`` each call starts an empty one in
    the shared folder, so that its figures hold for a cold cache."""
    import public_tokenizers
    cache = cache or f"{ensure_checkpoint_dir(spark).rstrip('/')}/token-counts-{uuid.uuid4().hex}"
    counts = count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), cache)
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > LIMIT).alias("over_limit"))
