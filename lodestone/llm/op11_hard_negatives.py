"""Hard-negative mining by a full sort of each anchor's scores.

Anchors are a stated set of queries against all rows. They are written in blocks of a bounded
number of bytes; a block is sent to all tasks, which read all rows in slices. A slice's integer
scores against an anchor are sorted whole (lexsort by score, then id). The first pass reads each
anchor's positives off the sorted rows of its own label; the second searches the sorted rows of
other labels for each positive's upper limit by bisection and reads the first `negatives` entries
that are not below its lower limit. What slices found is merged, in a task and then over tasks;
an entry that is not among the first of its slice is not among the first of all, so nothing is lost.
A row's components become floor(256 * x), x as a double; scores are exact integers.

Cases. Rows with a null id, label or vector, or any null or non-finite component, take no part
(without an id a row can neither be ordered nor named). Repeated rows are rows of their own:
each is an anchor, positive or negative by itself, and an anchor leaves out one row of its own id,
label and score, itself. Rows of equal score and id are alike in the result, whatever else they hold.
Vectors of two lengths have no score, so one is nothing to the other; empty vectors score 0 with each
other. A positive score below 0 has no negatives, as its limits cross. Further columns are ignored.
An empty table, or one without anchors, gives an empty result. Scores that 64 bits cannot hold
raise OverflowError.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.shared import dropped, mapped, written

#: Bytes of the vectors of a block of anchors, which is broadcast.
BLOCK_BYTES = 1 << 21
#: Rows whose scores are sorted at once, and anchors whose scores with them are held at once.
SLICE_ROWS, SCORED = 1 << 14, 32
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
NONE = np.iinfo(np.int64).max


def integers(rows: DataFrame, anchor: Column) -> DataFrame:
    """(vec_id, label, vector, anchor) of the rows that take part; vectors of integers."""
    x = F.col("embedding")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & whole)
    vector = F.transform(x, lambda c: F.floor(c.cast("double") * 256))
    return kept.select(F.col("vec_id").cast("long").alias("vec_id"), "label", vector.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"))


def blocks(rows: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The anchors in parts of at most `block_bytes` bytes of vectors (or one anchor), by the
    number of rows in a written file: no key decides, so no key can fill a block."""
    spark = rows.sparkSession
    longest = rows.where("anchor").agg(F.max(F.size("vector"))).first()[0]
    if longest is None:
        return []
    each = max(1, block_bytes // (8 * max(1, longest)))
    anchors = rows.where("anchor")
    tasks = -(-anchors.count() // each)
    held = written(anchors.repartition(tasks).select("vec_id", "label", "vector"), "anchors", maxRecordsPerFile=each)
    return [spark.read.schema(held.schema).parquet(f) for f in sorted(held.inputFiles())]


class Block:
    """A block of anchors as arrays, by the length of their vectors."""

    def __init__(self, table: pa.Table) -> None:
        self.id, self.label, self.parts = _arrays(table.combine_chunks())

    def scores(self, vectors: list[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(anchor, rows, scores) of each anchor with the rows of its length."""
        held = {d: (at, m) for d, at, m in vectors}
        for d, mine, own in self.parts:
            if d not in held:
                continue
            at, m = held[d]
            for i in range(0, len(mine), SCORED):
                for k, s in zip(mine[i : i + SCORED], product(own[i : i + SCORED], m)):
                    yield int(k), at, s


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors, as 64-bit integers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:  # every sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if most < 1 << 63:
        return a @ b.T
    raise OverflowError("the scores of these vectors may not fit 64 bits")


def _arrays(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
    """Ids, labels and, by length, the rows and their vectors."""
    ids, label, vector = (table.column(n) for n in ("vec_id", "label", "vector"))
    vector = vector.combine_chunks() if isinstance(vector, pa.ChunkedArray) else vector
    o = vector.offsets.to_numpy()
    flat, o, size = vector.flatten().to_numpy(zero_copy_only=False).astype(np.int64), o - o[0], np.diff(o)
    parts = []
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        parts.append((int(d), at, flat[o[at][:, None] + np.arange(d)]))
    return ids.to_numpy(), label.to_numpy() if pa.types.is_integer(label.type) else np.array(label.to_pylist(), object), parts


def _firsts(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first k entries of each row by negated score, then id; NONE fills up."""
    order = np.lexsort((ids, scores), axis=1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(0, b.num_rows, SLICE_ROWS):
            yield b.slice(i, SLICE_ROWS)


def _merged(batches: Iterator[pa.RecordBatch], block: Block, slots: int, k: int, read) -> pa.RecordBatch:
    """The first k of each of the block's anchors and slots over all slices of a task.
    read: gives (slot, negated scores, ids), sorted, for an anchor and its rows' scores."""
    n = len(block.id) * slots
    best = np.full((n, k), NONE), np.full((n, k), NONE)
    for b in _slices(batches):
        new = np.full((n, k), NONE), np.full((n, k), NONE)
        ids, labels, vectors = _arrays(b)
        for i, at, s in block.scores(vectors):
            for slot, neg, own in read(i, labels[at] == block.label[i], s, ids[at]):
                new[0][i * slots + slot, : len(neg)], new[1][i * slots + slot, : len(own)] = neg, own
        best = _firsts(np.hstack((best[0], new[0])), np.hstack((best[1], new[1])), k)
    row, at = np.nonzero(best[0] != NONE)
    return pa.RecordBatch.from_arrays([pa.array(row), pa.array(-best[0][row, at]), pa.array(best[1][row, at])], names=["slot", "score", "id"])


def _ranked(rows: DataFrame, block: Block, slots: int, k: int, read) -> DataFrame:
    """(slot, rank, score, id): the first k of each slot over all rows."""
    held = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _merged(batches, held.value, slots, k, lambda *x: read(held.value, *x))

    found = mapped(rows.select("vec_id", "label", "vector"), run, "slot long, score long, id long")
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def positives_of(rows: DataFrame, block: Block, count: int) -> list[list[tuple[int, int]]]:
    """For each anchor of a block, (score, id) of its first `count` other rows of the same label."""

    def read(b: Block, i: int, same: np.ndarray, s: np.ndarray, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        neg, own = -s[same], ids[same]
        order = np.lexsort((own, neg))[: count + 1]  # one may be the anchor itself
        yield 0, neg[order], own[order]

    out: list[list[tuple[int, int]]] = [[] for _ in block.id]
    for r in _ranked(rows, block, 1, count + 1, read).orderBy("slot", "rank").collect():  # count + 1 for each anchor of the block
        out[r["slot"]].append((r["score"], r["id"]))
    own = {d: (m * m).sum(1) for d, _, m in block.parts}
    for d, at, _ in block.parts:
        for i, s in zip(at.tolist(), own[d].tolist()):
            me = (s, int(block.id[i]))
            if me in out[i]:
                out[i].remove(me)
            del out[i][count:]
    return out


def mine(rows: DataFrame, anchor: Column, positives: int = 5, negatives: int = 10, lower: int = 30, upper: int = 90, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """For each anchor and each of its first `positives` rows of the same label, the first
    `negatives` rows of another label whose score is from `lower` to `upper` hundredths of the
    positive's. rows: vec_id, label, embedding; anchor: which rows are anchors."""
    spark = rows.sparkSession
    ready = written(integers(rows, anchor), "integers")
    parts = []
    for one in (every := blocks(ready, block_bytes)):
        block = Block(one.toArrow())  # block_bytes at the most
        found = positives_of(ready, block, positives)

        def read(b: Block, i: int, same: np.ndarray, s: np.ndarray, ids: np.ndarray, found=found) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
            neg, own = -s[~same], ids[~same]
            order = np.lexsort((own, neg))
            neg, own = neg[order], own[order]
            first = np.searchsorted(neg, [-(upper * p // 100) for p, _ in found[i]], "left")
            last = np.searchsorted(neg, [lower * -p // 100 for p, _ in found[i]], "right")
            for slot, (a, z) in enumerate(zip(first, last)):
                z = min(z, a + negatives)
                if a < z:
                    yield slot, neg[a:z], own[a:z]

        pairs = [(i * positives + k, int(block.id[i]), p, q) for i, own in enumerate(found) for k, (p, q) in enumerate(own)]
        named = spark.createDataFrame(pairs, "slot long, anchor_id long, positive_score long, positive_id long")
        got = _ranked(ready, block, positives, negatives, read).join(F.broadcast(named), "slot")  # a block's
        got = got.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        parts.append(got if len(every) == 1 else written(got, "negatives"))
    if not parts:
        dropped(ready)
        return spark.createDataFrame([], SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are rows whose id is divisible by 100; labels of rows whose id is divisible by 7 are one higher."""
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


#: The same rows in DuckDB: every anchor's scores ranked by windows.
SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_dot_product(a.e, v.e) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.r <> v.r AND len(a.e) = len(v.e) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT r, anchor_id, vec_id AS positive_id, score AS positive_score, k
  FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS k FROM s WHERE same) WHERE k <= 5
), n AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY p.r, k ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON p.r = s.r AND NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""
