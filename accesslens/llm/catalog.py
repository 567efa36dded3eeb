"""Named queries of the training-data operators, and their SQL restatements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from accesslens.llm import align, bpe, chat, codes, decontaminate, exact, jaccard, license, lines, quality, substring, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_byte_bpe": bpe.query,
        "op2_decontaminate": decontaminate.query,
        "op3_chat": chat.query,
        "op4_line_chunks": lines.query,
        "op5_ngram_jaccard": jaccard.query,
        "op6_quality": quality.query,
        "op7_license": license.query,
        "op8_exact_copies": exact.query,
        "op9_toxicity": toxicity.query,
        "op10_substring": substring.query,
        "op11_vector_codes": codes.query,
        "op12_warc_bundles": warc.query,
        "op13_align": align.query,
    }


def oracle_sql() -> dict[str, str]:
    """Where SQL can express the result; the others are tested against brute force or held-out labels."""
    return {
        "op2_decontaminate": decontaminate.SQL,
        "op3_chat": chat.SQL,
        "op5_ngram_jaccard": jaccard.SQL,
        "op8_exact_copies": exact.SQL,
        "op10_substring": substring.SQL,
        "op11_vector_codes": codes.SQL,
        "op12_warc_bundles": warc.SQL,
    }
