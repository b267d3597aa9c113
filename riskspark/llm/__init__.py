"""Text operators of a training-data pipeline, with their queries and oracle SQL.

Nothing else in the package imports this subpackage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from riskspark.llm import (
    ann, bpe, chat_format, lang_id, license_scan, near_dedup, packing, ranked_search, repeats, spelling, token_counts, toxicity,
    winnow,
)
from riskspark.llm.common import ship_package

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": near_dedup.op1_near_dedup,
    "op2_bpe": bpe.op2_bpe,
    "op3_licenses": license_scan.op3_licenses,
    "op4_chat": chat_format.op4_chat,
    "op5_packing": packing.op5_packing,
    "op6_fingerprints": winnow.op6_fingerprints,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_token_counts": token_counts.op8_token_counts,
    "op9_neighbours": ann.op9_neighbours,
    "op10_language": lang_id.op10_language,
    "op11_spelling": spelling.op11_spelling,
    "op12_search": ranked_search.op12_search,
    "op13_repeats": repeats.op13_repeats,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def shipped(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)
        return run
    return {name: shipped(fn) for name, fn in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {"op4_chat": chat_format.OP4_SQL, "op12_search": ranked_search.OP12_SQL, "op13_repeats": repeats.OP13_SQL}
