"""The corpus pipeline: stages of the llm operators over `documents`.

Each stage takes (spark, docs, sf_dir) and works on all rows of docs. All but the last
return the columns of `documents`, whatever further columns docs has; texts that a stage
changes get a new n_chars. An empty table gives an empty result at each stage, and texts of
any length are worked on whole. What becomes of null ids, null, empty and wordless texts,
repeated rows and ties stands at each stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import op4_neardup, op6_substrings, op7_bpe, op8_language, op9_decontaminate
from lodestone.llm.shared import bitmap, dropped, is_marked, written

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Least share of a text's n-grams that its language must account for.
MIN_SCORE = 0.2
#: Bits of the map of rows that are dropped or repeated.
FILTER_BITS = 25


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told go on; those without a letter, or of which no
    language accounts for MIN_SCORE of the n-grams, are rejected.

    So null, empty and wordless texts go. Rows with a null id or a null lang are judged like
    others but not learned from; repeated rows are judged one by one. Of equal languages the
    first by name is told, which changes nothing here."""
    filters = op8_language.fitted(docs, ~op8_language.held_out())
    told = op8_language.identified(docs.select(*COLUMNS), filters)
    return told.where((F.col("lang_pred") != op8_language.UND) & (F.col("score") >= MIN_SCORE)).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, that with the smallest id,
    and one of rows that are equal in id and text; shingles are of five words.

    Wordless texts (null, empty) are linked with nothing and stay, one of rows that are equal. A row
    with a null id stays if its group has no other id. Rows of one id that is its group's smallest
    stay if their texts differ."""
    judged = op4_neardup.neighbours(docs.select("doc_id", "text"), words=5)
    told = written(judged.groupBy("row_key").agg(F.count_if("kept").alias("n")), "told")
    # rows that stay as they are, which most do, don't move: a map marks all others, and some of them
    odd = is_marked(spark, bitmap(told.where("n <> 1"), "row_key", FILTER_BITS))
    few = written(told.where(odd("row_key") & (F.col("n") > 0)), "few")
    dropped(told)
    keyed = docs.select(*COLUMNS, F.xxhash64("doc_id", "text").alias("row_key"))
    rest = keyed.where(odd("row_key"))
    once = keyed.where(~odd("row_key")).unionByName(rest.join(few.where("n = 1"), "row_key", "left_semi"))
    # few rows, or copies that a task unites before they move
    repeated = rest.join(few.where("n > 1"), "row_key", "left_semi").dropDuplicates(["row_key"])
    return once.unionByName(repeated).select(*COLUMNS)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of fifty words or more that a document with a smaller id holds are cut; a text
    that loses nothing stays as it is, one that loses all words goes.

    Null, empty and short texts stay as they are, as do rows with a null id. Repeated rows lose
    the same words; rows of one id cut nothing from each other, so no passage goes altogether."""
    out = op6_substrings.deduplicated(docs.select(*COLUMNS))
    cut = F.col("n_removed") > 0
    text = F.when(cut, F.col("kept_text")).otherwise(F.col("text"))
    n = F.when(cut, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return out.where("n_removed = 0 or n_removed < n_words").select("doc_id", text.alias("text"), "lang", "source", n.alias("n_chars"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of benchmark items are cut; documents that are mostly such spans go.

    Null, empty and wordless texts hold no spans and stay. Rows are judged one by one, by
    their text alone: null ids and repeated rows make no difference."""
    return op9_decontaminate.decontaminated(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document's ids and of the text they decode to, a row for
    each row; null and empty texts have no ids and decode to the empty text."""
    return op7_bpe.digests(op7_bpe.encoded(docs, op7_bpe.default_path()))


STAGES = [
    ("language ID", identify_language),
    ("MinHash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", decontaminate),
    ("BPE encoding and decoding", encode),
]
#: SQL cannot express the language filters nor the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"pipeline{k}")
    return docs
