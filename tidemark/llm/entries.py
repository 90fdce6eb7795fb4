"""Registered queries of the corpus operators, with the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import chat_format, decontaminate, fill_in_middle, html_text, importance, jaccard_join, language_id, licenses, mixing, secrets, token_counts, topk, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html_extraction": html_text.op1_html_extraction,
    "op2_license_scans": licenses.op2_license_scans,
    "op3_exact_topk": topk.op3_exact_topk,
    "op4_secret_scans": secrets.op4_secret_scans,
    "op5_language_id": language_id.op5_language_id,
    "op6_benchmark_decontamination": decontaminate.op6_benchmark_decontamination,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_ngram_jaccard_join": jaccard_join.op8_ngram_jaccard_join,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_mixing": mixing.op10_mixing,
    "op11_fill_in_middle": fill_in_middle.op11_fill_in_middle,
    "op12_importance_resampling": importance.op12_importance_resampling,
    "op13_chat_formatting": chat_format.op13_chat_formatting,
}

ORACLES: dict[str, str] = {
    "op3_exact_topk": topk.OP3_SQL,
    "op6_benchmark_decontamination": decontaminate.OP6_SQL,
    "op8_ngram_jaccard_join": jaccard_join.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_fill_in_middle": fill_in_middle.OP11_SQL,
    "op12_importance_resampling": importance.OP12_SQL,
    "op13_chat_formatting": chat_format.OP13_SQL,
}
