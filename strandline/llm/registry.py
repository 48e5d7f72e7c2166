"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from strandline.llm import chat, decontamination, extraction, jaccard, language, merkle, mixing, packing, quality, repair, search, tokens, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": tokens.op1_token_counts,
        "op2_html_extraction": extraction.op2_html_extraction,
        "op3_language_id": language.op3_language_id,
        "op4_best_fit_packing": packing.op4_best_fit_packing,
        "op5_exact_top_k": search.op5_exact_top_k,
        "op6_quality_rules": quality.op6_quality_rules,
        "op7_warc": warc.op7_warc,
        "op8_chat_formatting": chat.op8_chat_formatting,
        "op9_jaccard_join": jaccard.op9_jaccard_join,
        "op10_source_mixing": mixing.op10_source_mixing,
        "op11_decontamination": decontamination.op11_decontamination,
        "op12_merkle_manifest": merkle.op12_merkle_manifest,
        "op13_conversation_repair": repair.op13_conversation_repair,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_top_k": search.OP5_SQL, "op7_warc": warc.OP7_SQL, "op8_chat_formatting": chat.OP8_SQL, "op10_source_mixing": mixing.OP10_SQL, "op11_decontamination": decontamination.OP11_SQL, "op12_merkle_manifest": merkle.OP12_SQL, "op13_conversation_repair": repair.OP13_SQL}
