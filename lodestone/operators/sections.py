"""Sections and chunks from rows of blocks, as windows and aggregates over one shuffle.

Blocks: doc_id, pos, type, content, level, is_table, is_code, page_number, slide_number,
sheet_name, metadata. Every window, the sections' aggregate and the numbering of chunks
are partitioned by doc_id, so the blocks move once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.functions.splitter import SPLIT_ABOVE, split_text
from lodestone.schema import EMPTY_SUMMARY, EMPTY_TEXT

LEVELS = range(1, 7)
LOCATION = ("page_number", "slide_number", "sheet_name")


def _running() -> Window:
    return Window.partitionBy("doc_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)


def merged(a: Column, b: Column) -> Column:
    """Two maps in one; b's values win."""
    none = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(a, none), F.coalesce(b, none)
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def with_section(blocks: DataFrame) -> DataFrame:
    """section_id: how many headings stand before a block or are it."""
    return blocks.withColumn("section_id", F.sum((F.col("type") == "heading").cast("int")).over(_running()).cast("int"))


def with_heading_path(blocks: DataFrame) -> DataFrame:
    """heading_path: of the last heading of each level, those with no later one above them."""
    at = {n: F.max(F.when((F.col("type") == "heading") & (F.coalesce("level", F.lit(1)) == n), F.struct("pos", F.coalesce("content", F.lit("")).alias("title")))).over(_running()) for n in LEVELS}
    out = blocks.withColumns({f"_h{n}": c for n, c in at.items()})
    kept = []
    for n in LEVELS:
        above = F.greatest(F.lit(-1), *(F.coalesce(f"_h{k}.pos", F.lit(-1)) for k in LEVELS if k < n), F.lit(-1))
        kept.append(F.when(F.col(f"_h{n}.pos") > above, F.col(f"_h{n}.title")))
    return out.withColumn("heading_path", F.array_compact(F.array(*kept))).drop(*(f"_h{n}" for n in LEVELS))


def with_location(blocks: DataFrame) -> DataFrame:
    """Page, slide and sheet carried forward from the last block that has them."""
    return blocks.withColumns({c: F.last(c, ignorenulls=True).over(_running()) for c in LOCATION})


def sections(blocks: DataFrame) -> DataFrame:
    """One row for each section with content: its text, flags, path and last location."""
    rows = with_location(with_heading_path(with_section(blocks))).where("type <> 'heading'")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.coalesce("content", F.lit("")) != "", F.struct("pos", "content")))), lambda x: x["content"]), "\n\n")
    maps = F.transform(F.array_sort(F.collect_list(F.struct("pos", F.map_entries(F.coalesce("metadata", F.create_map().cast("map<string,string>"))).alias("e")))), lambda x: F.map_from_entries(x["e"]))
    return rows.groupBy("doc_id", "section_id").agg(
        text.alias("text"), F.bool_or(F.coalesce("is_table", F.lit(False))).alias("is_table"), F.bool_or(F.coalesce("is_code", F.lit(False))).alias("is_code"),
        F.first("heading_path").alias("heading_path"), *(F.max_by(c, "pos").alias(c) for c in LOCATION),
        F.aggregate(maps, F.create_map().cast("map<string,string>"), merged).alias("metadata"),
    )


def chunks_of(sections_: DataFrame) -> DataFrame:
    """Cleaned sections, those of over 1000 tokens in pieces, numbered within documents."""
    s = sections_.withColumn("text", T.clean_text("text")).where("text <> ''")
    long = T.estimate_tokens("text") > SPLIT_ABOVE
    s = s.withColumn("parts", F.when(long, split_text(F.when(long, F.col("text")))).otherwise(F.array("text")))
    s = s.select("*", F.posexplode("parts").alias("part", "chunk_text"))
    split = F.when(long, F.create_map(F.lit("splitPart"), (F.col("part") + 1).cast("string"), F.lit("totalParts"), F.size("parts").cast("string")))
    number = F.row_number().over(Window.partitionBy("doc_id").orderBy("section_id", "part")) - 1
    title = T.join_heading_path("heading_path")
    return s.select(
        T.chunk_id("doc_id", number).alias("id"), "doc_id", number.alias("chunk_index"),
        F.when(title != "", F.concat(title, F.lit("\n\n"), "chunk_text")).otherwise(F.col("chunk_text")).alias("full_text"),
        T.generate_summary("chunk_text").alias("summary_text"), title.alias("title_text"), "heading_path", F.try_element_at("heading_path", F.lit(-1)).alias("section_title"),
        "is_table", "is_code", *LOCATION, merged(F.col("metadata"), split).alias("metadata"),
    )


def with_empty(chunks: DataFrame, docs: DataFrame) -> DataFrame:
    """Every document of docs (doc_id, doc_type, source_path, doc_metadata) with its
    chunks, one placeholder where it has none."""
    none = F.col("id").isNull()
    or_ = lambda c, x: F.when(none, x).otherwise(F.col(c)).alias(c)
    return docs.join(chunks, "doc_id", "left").select(
        or_("id", T.chunk_id("doc_id", F.lit(0))), "doc_id", or_("chunk_index", F.lit(0)), or_("full_text", F.lit(EMPTY_TEXT)), or_("summary_text", F.lit(EMPTY_SUMMARY)),
        or_("title_text", F.lit("")), or_("heading_path", F.array().cast("array<string>")), "section_title", or_("is_table", F.lit(False)), or_("is_code", F.lit(False)),
        "doc_type", "source_path", *LOCATION,
        merged(F.col("doc_metadata"), F.when(none, F.create_map(F.lit("isEmpty"), F.lit("true"))).otherwise(F.col("metadata"))).alias("metadata"),
    )


def chunk_blocks(blocks: DataFrame, docs: DataFrame) -> DataFrame:
    """Chunks of all documents from their blocks."""
    return with_empty(chunks_of(sections(blocks)), docs)
