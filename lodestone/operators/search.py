"""Vector, text and hybrid retrieval as DataFrame plans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.operators.embed import Provider
from lodestone.operators.index import words

RRF_K, OVERFETCH, LIMIT = 60, 10, 5
#: Queries of a batch that are held against all points at a time: what is broadcast.
QUERY_BLOCK = 1000


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def vector_search(points: DataFrame, vector: Sequence[float], limit: int = LIMIT, key: str = "id", column: str = "full_vector") -> DataFrame:
    """The `limit` points nearest by cosine, with score; ties by key. A top-k in each task,
    then one of theirs."""
    q = F.array(*(F.lit(float(x)) for x in vector))
    return points.withColumn("score", cosine(F.col(column), q)).orderBy(F.desc("score"), key).limit(limit)


def vector_search_batch(points: DataFrame, queries: DataFrame, limit: int = LIMIT, key: str = "id", column: str = "full_vector") -> DataFrame:
    """(query_id, key, score, rank) for rows (query_id, vector): the query side is a stated
    set, sent in blocks of QUERY_BLOCK; each task keeps `limit` points a query before
    anything moves. Points and queries without a vector, or with a null component, are
    like none: such points are no results, such queries have none. Queries of two lengths raise ValueError, and points of another
    length than the queries fail the query with `Wrong vector size`. No results for a limit below 1."""
    import numpy as np
    import pyarrow as pa

    kinds = {f.name: f.dataType.simpleString() for f in points.schema}
    query_kind = queries.schema["query_id"].dataType.simpleString()
    if limit < 1:
        return points.limit(0).select(F.lit(None).cast(query_kind).alias("query_id"), key, F.lit(0.0).alias("score"), F.lit(0).alias("rank"))
    asked = [(r[0], r[1]) for r in queries.where("vector is not null").select("query_id", "vector").toLocalIterator()]
    asked = [(q, v) for q, v in asked if None not in v]
    sizes = {len(v) for _, v in asked}
    if len(sizes) > 1:
        raise ValueError(f"Wrong vector size: queries of {', '.join(map(str, sorted(sizes)))} components")
    width = max(sizes, default=0)
    points = points.where(F.col(column).isNotNull() & ~F.exists(column, F.isnull))
    if asked:
        size = F.size(column)
        wrong = F.raise_error(F.concat(F.lit("Wrong vector size: "), size.cast("string"))).cast(points.schema[column].dataType)
        points = points.withColumn(column, F.when(size == width, F.col(column)).otherwise(wrong))
    out = None
    for i in range(0, max(len(asked), 1), QUERY_BLOCK):
        block = asked[i : i + QUERY_BLOCK]
        held = points.sparkSession.sparkContext.broadcast(([q for q, _ in block], np.array([v for _, v in block], np.float64).reshape(len(block), width)))

        def run(batches, held=held):
            ids, q = held.value
            q = q / np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-300) if len(q) else q
            best: list[list[tuple[float, object]]] = [[] for _ in ids]
            for b in batches:
                if not b.num_rows or not len(q):
                    continue
                names = b.column(0).to_pylist()
                m = np.array(b.column(1).to_pylist(), np.float64)
                s = q @ (m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)).T
                for k, row in enumerate(s):
                    top = np.argpartition(-row, limit - 1)[:limit] if len(row) > limit else np.arange(len(row))
                    # equals of the last one that is kept must not be lost to the key's order
                    top = np.flatnonzero(row >= row[top].min() - 1e-12)
                    best[k] = sorted(best[k] + [(float(row[t]), names[t]) for t in top.tolist()], key=lambda x: (-round(x[0], 9), x[1]))[:limit]
            rows = [(ids[k], name, score) for k, found in enumerate(best) for score, name in found]
            cols = list(zip(*rows)) if rows else [(), (), ()]
            arrow = [pa.array(cols[0], pa.int64() if query_kind == "bigint" else None), pa.array(cols[1], pa.int64() if kinds[key] == "bigint" else None), pa.array(cols[2], pa.float64())] if rows else None
            if arrow:
                yield pa.RecordBatch.from_arrays(arrow, names=["query_id", key, "score"])

        part = points.select(key, column).mapInArrow(run, f"query_id {query_kind}, {key} {kinds[key]}, score double")
        out = part if out is None else out.unionByName(part)
    w = Window.partitionBy("query_id").orderBy(F.desc(F.round("score", 9)), key)
    return out.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= limit)


def matches(text: Column | str, query: str | Column) -> Column:
    """Whether a text has all words of a query; a query without words matches nothing."""
    asked = words(F.lit(query) if isinstance(query, str) else query)
    return (F.size(asked) > 0) & (F.size(F.array_except(asked, words(text))) == 0)


def text_search(points: DataFrame, query: str, limit: int = LIMIT, key: str = "id", column: str = "text") -> DataFrame:
    """The first `limit` matching points by key, with rank and score 1 / rank."""
    hit = points.where(matches(column, query)).orderBy(key).limit(limit)
    rank = F.row_number().over(Window.partitionBy().orderBy(key))  # of at most `limit` rows
    return hit.withColumn("rank", rank).withColumn("score", 1.0 / F.col("rank"))


def text_search_postings(postings: DataFrame, points: DataFrame, query: str, limit: int = LIMIT) -> DataFrame:
    """As text_search, by the index of words: reads the query's words only."""
    asked = points.sparkSession.range(1).select(words(F.lit(query)).alias("w")).first()[0]
    ids = postings.where(F.col("word").isin(asked)).groupBy("id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(asked)).orderBy("id").limit(limit)
    rank = F.row_number().over(Window.partitionBy().orderBy("id"))
    return points.join(F.broadcast(ids.select("id", rank.alias("rank"))), "id").withColumn("score", 1.0 / F.col("rank"))


def fuse(by_vector: DataFrame, by_text: DataFrame, key: str = "id", group: Sequence[str] = ()) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists (key, vector_rank) and (key, text_rank)."""
    score = lambda c: F.coalesce(1.0 / (RRF_K + F.col(c)), F.lit(0.0))
    return by_vector.join(by_text, [*group, key], "full_outer").withColumn("rrf_score", score("vector_rank") + score("text_rank"))


def fused_order() -> list[Column]:
    """Best first; of equals, those in the vector list in its order, then the others in theirs."""
    return [F.desc("rrf_score"), F.asc_nulls_last("vector_rank"), F.asc("text_rank")]


def hybrid_search(points: DataFrame, query: str, vector: Sequence[float], limit: int = LIMIT) -> DataFrame:
    """The `limit` best points of both searches, each asked for ten times as many."""
    n = limit * OVERFETCH
    v = vector_search(points, vector, n).select("id", "score")
    v = v.withColumn("vector_rank", F.row_number().over(Window.partitionBy().orderBy(F.desc("score"), "id"))).drop("score")
    t = text_search(points, query, n).select("id", F.col("rank").alias("text_rank"))
    best = fuse(v, t).orderBy(*fused_order()).limit(limit)
    return points.join(F.broadcast(best), "id").withColumn("score", F.col("rrf_score")).orderBy(*fused_order())


def impact(fused: DataFrame) -> DataFrame:
    """How many of the results stand in both lists, or in one alone."""
    v, t = F.col("vector_rank").isNotNull(), F.col("text_rank").isNotNull()
    return fused.agg(F.count_if(v & t).alias("in_both"), F.count_if(v & ~t).alias("vector_only"), F.count_if(~v & t).alias("text_only"))


def display(results: DataFrame, chars: int = 200) -> DataFrame:
    """Rows for a reader: file, type, title, place, flags and a preview."""
    place = F.when(F.col("page_number") != 0, F.concat(F.lit("Page "), F.col("page_number"))).when(F.col("slide_number") != 0, F.concat(F.lit("Slide "), F.col("slide_number"))).when(F.col("sheet_name") != "", F.concat(F.lit("Sheet: "), F.col("sheet_name")))
    flags = F.concat_ws(", ", F.when(F.col("is_table"), F.lit("Table")), F.when(F.col("is_code"), F.lit("Code")))
    preview = F.when(F.coalesce("summary_text", F.lit("")) != "", F.col("summary_text")).otherwise(T.truncate_text("text", chars))
    return results.select("id", "score", T.filename("source_path").alias("file"), F.upper("doc_type").alias("type"), "title_text", place.alias("location"), flags.alias("flags"), preview.alias("preview"))


def previews(results: DataFrame, most: int = 10) -> DataFrame:
    """Short lines for the head of a list."""
    title = F.when(F.coalesce("title_text", F.lit("")) != "", F.col("title_text")).otherwise(F.col("summary_text"))
    return results.limit(most).select("score", T.filename("source_path").alias("file"), T.truncate_text(title, 50).alias("title"))


def hybrid_lists(points: DataFrame, query: str, vector: Sequence[float], limit: int = LIMIT, most: int = 10) -> list[str]:
    """Lines for a reader of the two lists that a hybrid search fuses: the head of each, and how many more there are."""
    n, out = limit * OVERFETCH, []
    for name, found in (("Vector", vector_search(points, vector, n)), ("Text", text_search(points, query, n))):
        rows = previews(found, n).collect()  # n at the most
        out.append(f"{name} search: {len(rows)} results")
        for k, r in enumerate(rows[:most], 1):
            score = f"Score: {r['score']:.4f} | " if name == "Vector" and r["score"] is not None else ""
            out.append(f"  [{k}] {score}{r['file']} | {r['title']}")
        if len(rows) > most:
            out.append(f"  ... and {len(rows) - most} more")
    return out if rows else [*out, "  No keyword matches found"]


def parse_limit(given: str | int | None) -> int:
    """A whole number at the head of the text; 5 for 0, nothing and what is none."""
    import re

    m = re.match(r"\s*([+-]?[0-9]+)", str(given)) if given is not None else None
    return (int(m[1]) if m else 0) or LIMIT


def search(points: DataFrame, query: str, provider: Provider, mode: str = "hybrid", limit: str | int | None = LIMIT) -> DataFrame:
    """By mode `vector` or `text`; any other is hybrid. A blank query is refused."""
    if not query.strip():
        raise ValueError("Please enter a query.")
    n = max(parse_limit(limit), 0)
    if mode == "text":
        return text_search(points, query, n)
    vector = provider.embed([query])[0].tolist()
    return vector_search(points, vector, n) if mode == "vector" else hybrid_search(points, query, vector, n)
