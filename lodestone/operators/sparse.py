"""The sparse space of a collection: weighted terms of points as block postings, and top-k by block-max skipping.

Points are put on pages of PAGE in the order of their ids. A block holds a term's postings of one page, so it is
bounded however common the term, with the greatest weight in it. A query adds up those maxima: no point of a
page can score more. The pages with the greatest bounds are scored first; of all others only those are read
whose bound reaches the last score kept. So the result is that of a full scan.

Weights are of 0 or more; terms with a null or negative weight are errors. A point scores the sum of products over
the terms it shares with a query, and only points that share one are results. Ties go by id. Points with a null id, and
points and queries without terms, are like none. Repeated ids are summed as one point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators.search import LIMIT

#: Points of a page; a power of two.
PAGE = 128
#: Pages that a query scores first, for each of the results it asks for.
FIRST = 2


def terms(text: Column | str) -> Column:
    """The words of a text for the sparse space, as often as they occur: lower-cased runs of letters and digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def counted(rows: DataFrame, key: str, text: str) -> DataFrame:
    """(key, term, weight): how often each word of a text occurs. Texts move, once, and not their many more words;
    so a table that is read as one part is work for all tasks."""
    return rows.select(key, text).repartition(key).select(key, F.explode(terms(text)).alias("term")).groupBy(key, "term").agg(F.count(F.lit(1)).cast("double").alias("weight"))


class SparseIndex:
    """Block postings under a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def build(self, postings: DataFrame, key: str = "id") -> None:
        """postings: (key, term, weight), of points in any order."""
        wrong = F.raise_error(F.concat(F.lit("Wrong weight of term "), F.col("term"))).cast("double")
        weight = F.when(F.col("weight") >= 0, F.col("weight").cast("double")).otherwise(wrong)
        rows = postings.where(F.col(key).isNotNull() & F.col("term").isNotNull()).select(F.col(key).alias("key"), "term", weight.alias("weight"))
        rows.groupBy("key", "term").agg(F.sum("weight").alias("weight")).write.parquet(f"{self.path}/postings")
        rows = self.spark.read.parquet(f"{self.path}/postings")
        # rows of a task are numbered from a multiple of 2^33 on, so pages do not cross tasks
        rows.select("key").distinct().repartitionByRange("key").sortWithinPartitions("key").select("key", F.floor(F.monotonically_increasing_id() / PAGE).cast("long").alias("page")).write.parquet(f"{self.path}/pages")
        paged = rows.join(self.spark.read.parquet(f"{self.path}/pages"), "key")
        # ranges of terms and pages are groups of them too: postings move once, as rows, and blocks stay where they are made
        ranged = paged.select("term", "page", "key", "weight").repartitionByRange("term", "page")
        blocks = ranged.groupBy("term", "page").agg(F.max("weight").alias("most"), F.collect_list(F.struct("key", "weight")).alias("entries"))  # PAGE at the most
        blocks.sortWithinPartitions("term", "page").write.parquet(f"{self.path}/blocks")

    def blocks(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/blocks")

    def _asked(self, queries: DataFrame) -> DataFrame:
        """(query_id, term, asked) of a stated set of queries, one row for each term."""
        wrong = F.raise_error(F.concat(F.lit("Wrong weight of term "), F.col("term"))).cast("double")
        weight = F.when(F.col("weight") >= 0, F.col("weight").cast("double")).otherwise(wrong)
        return queries.where(F.col("term").isNotNull()).groupBy("query_id", "term").agg(F.sum(weight).alias("asked"))

    def bounds(self, queries: DataFrame) -> DataFrame:
        """(query_id, page, bound, blocks): what a point of a page can score at the most, and the blocks that tell; entries are not read."""
        heads = self.blocks().select("term", "page", "most").join(self._asked(queries), "term")
        return heads.groupBy("query_id", "page").agg(F.sum(F.col("most") * F.col("asked")).alias("bound"), F.count(F.lit(1)).alias("blocks"))

    def _scores(self, queries: DataFrame, pages: DataFrame) -> DataFrame:
        """(query_id, key, score) of all points of some pages (query_id, page)."""
        wanted = self._asked(queries).join(pages.select("query_id", "page"), "query_id")
        hit = self.blocks().select("term", "page", "entries").join(wanted, ["term", "page"])
        each = hit.select("query_id", "asked", F.inline("entries"))
        return each.groupBy("query_id", "key").agg(F.sum(F.col("asked") * F.col("weight")).alias("score"))

    def _top(self, scores: DataFrame, limit: int) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "key"))
        return scores.withColumn("rank", rank).where(F.col("rank") <= limit)

    def plan(self, queries: DataFrame, limit: int = LIMIT) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The bounds, the pages that are scored first, and those of the rest that the last score kept does not rule out."""
        bounds = self.bounds(queries)
        order = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "page"))
        first = bounds.withColumn("n", order).where(F.col("n") <= max(1, limit * FIRST)).drop("n")
        least = self._top(self._scores(queries, first), limit).where(F.col("rank") == limit).select("query_id", F.col("score").alias("least"))
        rest = bounds.join(first.select("query_id", "page"), ["query_id", "page"], "left_anti").join(least, "query_id", "left")
        return bounds, first, rest.where(F.col("least").isNull() | (F.col("bound") >= F.col("least"))).drop("least")

    def search(self, queries: DataFrame, limit: int = LIMIT) -> DataFrame:
        """(query_id, key, score, rank) for rows (query_id, term, weight); no results for a limit below 1."""
        _, first, rest = self.plan(queries, limit)
        return self._top(self._scores(queries, first.unionByName(rest)), max(limit, 0))

    def skipped(self, queries: DataFrame, limit: int = LIMIT) -> DataFrame:
        """(query_id, blocks, read): blocks of a query's terms, and those whose entries a search reads."""
        every, first, rest = self.plan(queries, limit)
        read = first.unionByName(rest).groupBy("query_id").agg(F.sum("blocks").alias("read"))
        return every.groupBy("query_id").agg(F.sum("blocks").alias("blocks")).join(read, "query_id", "left").select("query_id", "blocks", F.coalesce("read", F.lit(0).cast("long")).alias("read"))
