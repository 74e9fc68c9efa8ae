"""The queries of the llm operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import op1_hpylm, op2_reputation, op3_extract, op4_neardup, op5_warc, op6_substrings, op7_bpe, op8_language, op9_decontaminate, op10_repetition, op11_hard_negatives, op12_exact_dedup, op13_phrases

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hpylm": op1_hpylm.op1_hpylm,
    "op2_reputation": op2_reputation.op2_reputation,
    "op3_extract": op3_extract.op3_extract,
    "op4_neardup": op4_neardup.op4_neardup,
    "op5_warc": op5_warc.op5_warc,
    "warc_links": op5_warc.warc_links,
    "op6_substrings": op6_substrings.op6_substrings,
    "op7_bpe": op7_bpe.op7_bpe,
    "op8_language": op8_language.op8_language,
    "op9_decontaminate": op9_decontaminate.op9_decontaminate,
    "op10_repetition": op10_repetition.op10_repetition,
    "op11_hard_negatives": op11_hard_negatives.op11_hard_negatives,
    "op12_exact_dedup": op12_exact_dedup.op12_exact_dedup,
    "op13_phrases": op13_phrases.op13_phrases,
}
SQL: dict[str, str] = {"op2_reputation": op2_reputation.SQL, "op4_neardup": op4_neardup.SQL, "warc_links": op5_warc.LINKS_SQL, "op6_substrings": op6_substrings.SQL, "op9_decontaminate": op9_decontaminate.SQL, "op11_hard_negatives": op11_hard_negatives.SQL, "op12_exact_dedup": op12_exact_dedup.SQL, "op13_phrases": op13_phrases.SQL}
