"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from beadloom.llm import jaccard, language, line_dedup, media, mixing, packing, quality, topk, toxicity, url_filter


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": language.op1_language_id,
        "op2_jaccard_join": jaccard.op2_jaccard_join,
        "op3_toxicity": toxicity.op3_toxicity,
        "op4_source_mixing": mixing.op4_source_mixing,
        "op5_quality_classifier": quality.op5_quality_classifier,
        "op6_line_dedup": line_dedup.op6_line_dedup,
        "op7_best_fit_packing": packing.op7_best_fit_packing,
        "op8_media_columns": media.op8_media_columns,
        "op9_exact_top_k": topk.op9_exact_top_k,
        "op10_url_filter": url_filter.op10_url_filter,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": jaccard.OP2_SQL, "op4_source_mixing": mixing.OP4_SQL, "op6_line_dedup": line_dedup.OP6_SQL, "op9_exact_top_k": topk.OP9_SQL, "op10_url_filter": url_filter.OP10_SQL}
