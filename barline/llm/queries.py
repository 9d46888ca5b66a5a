"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barline.llm import bytebpe, contamination, conversations, language, neardup, pages, quality, repeats, secrets, sentencepiece, spelling, sql, syncmers, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_syncmer_fingerprints": syncmers.query,
    "op2_toxicity": toxicity.query,
    "op3_benchmark_decontamination": contamination.query,
    "op4_html_extraction": pages.query,
    "op5_suffix_array_dedup": repeats.query,
    "op6_quality_classifier": quality.query,
    "op7_secret_scan": secrets.query,
    "op8_sentencepiece": sentencepiece.query,
    "op9_minhash_near_dedup": neardup.query,
    "op10_language_id": language.query,
    "op11_conversation_repair": conversations.query,
    "op12_spelling_variants": spelling.query,
    "op13_byte_bpe": bytebpe.query,
}

SQL: dict[str, str] = {
    "op5_suffix_array_dedup": sql.REPEATS,
    "op9_minhash_near_dedup": sql.NEAR_DUPLICATES,
    "op11_conversation_repair": sql.CONVERSATIONS,
    "op12_spelling_variants": sql.SPELLING,
}
