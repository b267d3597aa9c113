"""The corpus pipeline: toxic texts go, texts without a language go, one text of
each group of near copies stays, the rest is packed into bins.

A stage takes (spark, docs, sf_dir) and returns a frame; ``run`` writes each
result as Parquet in the shared folder of ``spark.checkpoint.dir`` and reads it again for
the next stage. All stages but the last return the columns of ``docs``.
An empty table gives empty results; nulls and repeated rows are handled as the
operators' docstrings say.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import lang_id, near_dedup, packing, toxicity
from riskspark.llm.common import ship_package, table
from riskspark.session import ensure_checkpoint_dir


#: Rows of a batch that Python workers are given: batches of whole texts, and what is made of them, are held by
#: every worker and by Spark beside it.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return lang_id.keep_identified(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return near_dedup.drop_near_copies(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("toxicity", toxicity_stage),
    ("language_id", language_stage),
    ("near_dedup", near_dedup_stage),
    ("best_fit_packing", packing_stage),
]

#: Trained models and sketches have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
