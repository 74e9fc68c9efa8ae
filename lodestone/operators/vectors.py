"""An approximate index of vectors: inverted cells learnt by k-means, product codes, exact re-ranking.

Vectors are compared by cosine, so they are normalised first. Centres of cells, and code books of the parts of what
is left after the centre is taken away, are learnt on at most `sample` vectors, chosen by a hash of their key;
every vector is then put into its nearest cell, with a byte for each part. A query reads the cells whose centres are
nearest alone, as folders that Spark prunes; sums of looked-up products rank their codes, and of
the first ones the whole vectors are read and compared exactly. How many cells to read for a wanted recall is
measured at building, against an exact search for some of the vectors.

Vectors that are null, of another length than `dimensions`, of no length or with a null or non-finite component are not in the
index, nor are those without a key; queries like that have no results, but those of another length raise ValueError. Equal vectors share a cell, however many they are; a cell's
rows are dealt over tasks by key, so one cell does not become one task. Rows of one key are rows of their own.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.operators.search import LIMIT, QUERY_BLOCK, cosine, vector_search_batch

#: Codes of a part: one byte.
CODES = 256
#: Vectors that the model is learnt on, and those whose exact neighbours tell how many cells to read.
SAMPLE, TRIALS = 1 << 16, 200
ROUNDS = 12


def usable(points: DataFrame, key: str, column: str, dimensions: int) -> DataFrame:
    """(key, vector) of the vectors that the index holds."""
    x = F.col(column)
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))) & F.exists(x, lambda c: c != 0)
    return points.where(F.col(key).isNotNull() & x.isNotNull() & (F.size(x) == dimensions) & whole).select(F.col(key).alias("key"), x.cast("array<float>").alias("vector"))


def _matrix(column: pa.Array) -> np.ndarray:
    m = column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)
    return m / np.linalg.norm(m, axis=1, keepdims=True) if len(m) else m


def lloyd(m: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """Centres of k groups of the rows of a bounded matrix; rows that no centre is near to become centres."""
    rng = np.random.default_rng(seed)
    centres = m[np.sort(rng.choice(len(m), min(k, len(m)), replace=False))]
    for _ in range(ROUNDS):
        d = (centres * centres).sum(1) - 2 * (m @ centres.T)
        near = d.argmin(1)
        n = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, m)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
        if (n == 0).any():
            far = np.argsort(-d[np.arange(len(m)), near], kind="stable")[: int((n == 0).sum())]
            centres[np.flatnonzero(n == 0)[: len(far)]] = m[far]
    return centres


class VectorIndex:
    """An index under a folder; `build` makes it, `add` puts further vectors in, `search` asks it."""

    def __init__(self, spark: SparkSession, path: str, dimensions: int):
        self.spark, self.path, self.dimensions = spark, path.rstrip("/"), dimensions

    def _centres(self, table: str) -> np.ndarray:
        rows = self.spark.read.parquet(f"{self.path}/{table}").orderBy("part", "number").collect()  # of bounded size
        return np.array([r["vector"] for r in rows], np.float64).reshape(-1, self.dimensions)

    def settings(self) -> dict:
        return json.loads(self.spark.read.text(f"{self.path}/settings").first()[0])

    def build(self, points: DataFrame, key: str = "id", column: str = "full_vector", cells: int | None = None, parts: int = 16, recall: float = 0.97, sample: int = SAMPLE) -> None:
        """Learns the model and indexes all points. cells: by default the square root of the number of points, 4,096 at most. parts: bytes of a code."""
        rows = usable(points, key, column, self.dimensions)
        n = rows.count()
        cells = max(1, min(cells or round(n**0.5), 4096))
        parts = min(parts, self.dimensions)
        share = min(1.0, 0.9 * sample / max(n, 1))
        some = rows.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < F.lit(int(share * (1 << 20)) + 1)).limit(sample)

        def normal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array([0] * b.num_rows, pa.int32()), pa.array(_matrix(b.column(1)).tolist(), pa.list_(pa.float32()))], names=["part", "vector"])

        some.mapInArrow(normal, "part int, vector array<float>").write.parquet(f"{self.path}/sample")
        some = self.spark.read.parquet(f"{self.path}/sample")
        learnt = "part int, number int, vector array<float>"
        some.groupBy("part").applyInArrow(lambda t: centred(t, cells), learnt).write.parquet(f"{self.path}/centres")
        centres = self._centres("centres")
        bounds = np.linspace(0, self.dimensions, parts + 1).astype(int).tolist()

        def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                m = _matrix(b.column(1))
                m = m - centres[(m @ centres.T - (centres * centres).sum(1) / 2).argmax(1)]
                for j, (a, z) in enumerate(zip(bounds, bounds[1:])):
                    yield pa.RecordBatch.from_arrays([pa.array([j] * len(m), pa.int32()), pa.array(m[:, a:z].tolist(), pa.list_(pa.float32()))], names=["part", "vector"])

        some.mapInArrow(rest, "part int, vector array<float>").groupBy("part").applyInArrow(lambda t: centred(t, CODES), learnt).write.parquet(f"{self.path}/books")
        self._write_settings({"cells": len(centres), "parts": parts, "probes": max(1, len(centres)), "key": rows.schema["key"].dataType.simpleString()})
        self.add(points, key, column)
        self._calibrate(recall)

    def _write_settings(self, held: dict) -> None:
        self.spark.createDataFrame([(json.dumps(held),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.path}/settings")

    def _model(self) -> tuple[np.ndarray, list[np.ndarray], list[int]]:
        held = self.settings()
        books: list[list[list[float]]] = [[] for _ in range(held["parts"])]
        for r in self.spark.read.parquet(f"{self.path}/books").orderBy("part", "number").collect():  # CODES for each part
            books[r["part"]].append(r["vector"])
        bounds = np.linspace(0, self.dimensions, held["parts"] + 1).astype(int).tolist()
        return self._centres("centres"), [np.array(b, np.float64).reshape(len(b), z - a) for b, a, z in zip(books, bounds, bounds[1:])], bounds

    def add(self, points: DataFrame, key: str = "id", column: str = "full_vector") -> None:
        """Puts further vectors into the cells of the model."""
        model = self.spark.sparkContext.broadcast(self._model())
        rows = usable(points, key, column, self.dimensions)
        kind = rows.schema["key"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            centres, books, bounds = model.value
            for b in batches:
                m = _matrix(b.column(1))
                cell = (m @ centres.T - (centres * centres).sum(1) / 2).argmax(1) if len(m) else np.zeros(0, int)
                left = m - centres[cell]
                code = np.zeros((len(m), len(books)), np.uint8)
                for j, (a, z) in enumerate(zip(bounds, bounds[1:])):
                    code[:, j] = ((books[j] * books[j]).sum(1) - 2 * left[:, a:z] @ books[j].T).argmin(1)
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), b.column(1)], names=["key", "cell", "code", "vector"])

        coded = rows.mapInArrow(run, f"key {kind}, cell int, code binary, vector array<float>")
        coded.repartitionByRange("cell", "key").sortWithinPartitions("cell", "key").write.mode("append").partitionBy("cell").parquet(f"{self.path}/cells")

    def read(self, cells: Sequence[int] | None = None) -> DataFrame:
        """(key, code, vector, cell) of some cells, or all; only their folders are read."""
        rows = self.spark.read.schema(f"key {self.settings()['key']}, code binary, vector array<float>, cell int").parquet(f"{self.path}/cells")
        return rows if cells is None else rows.where(F.col("cell").isin([int(c) for c in cells]))

    def _calibrate(self, recall: float, limit: int = 10) -> None:
        """Sets how many cells a query reads: as many as hold the wanted share of the exact neighbours of TRIALS vectors."""
        held, (centres, _, _) = self.settings(), self._model()
        rows = self.read()
        n = max(1, rows.count())
        asked = rows.where(F.pmod(F.xxhash64("key", F.lit(1)), F.lit(1 << 20)) <= F.lit((1 << 20) * TRIALS // n)).limit(TRIALS).select(F.col("key").alias("query_id"), "vector")
        asked = asked.dropDuplicates(["vector"])  # copies would all find each other
        asked = self.spark.createDataFrame(asked.toArrow())
        near = vector_search_batch(rows, asked, limit, "key", "vector").join(rows.select("key", "cell"), "key").select("query_id", "cell").toArrow().to_pylist()
        at = {r["query_id"]: np.argsort(np.argsort(-(centres @ _unit(r["vector"])), kind="stable")) for r in asked.toArrow().to_pylist()}
        ranks = np.sort([at[r["query_id"]][r["cell"]] for r in near]) if near else np.zeros(1, int)
        held["probes"] = int(ranks[min(len(ranks) - 1, int(np.ceil(recall * len(ranks))))]) + 1
        self._write_settings(held)

    def search(self, queries: DataFrame, limit: int = LIMIT, probes: int | None = None, rerank: int = 20, exact: bool = False) -> DataFrame:
        """(query_id, key, score, rank) for rows (query_id, vector), the query side being a stated set in blocks.
        probes: cells that a query reads, by default those measured at building; rerank: how many times `limit` rows are compared exactly; exact: all rows are."""
        if exact or limit < 1:
            return vector_search_batch(self.read(), queries, limit, "key", "vector")
        asked = [(r["query_id"], r["vector"]) for r in queries.where("vector is not null").toLocalIterator()]
        if wrong := sorted({len(v) for _, v in asked} - {self.dimensions}):
            raise ValueError(f"Wrong vector size: {wrong[0]}")
        asked = [(q, v) for q, v in asked if None not in v and np.isfinite(v).all() and np.any(v)]
        probes, model = probes or self.settings()["probes"], self._model()
        out = None
        for i in range(0, max(1, len(asked)), QUERY_BLOCK):
            part = self._block(queries.schema["query_id"].dataType.simpleString(), asked[i : i + QUERY_BLOCK], limit, probes, rerank, model)
            out = part if out is None else out.unionByName(part)
        return out

    def _block(self, kind: str, asked: list, limit: int, probes: int, rerank: int, model: tuple) -> DataFrame:
        centres, books, bounds = model
        q = np.array([_unit(v) for _, v in asked]).reshape(len(asked), self.dimensions)
        sims = q @ centres.T
        probed = np.zeros(sims.shape, bool)
        np.put_along_axis(probed, np.argsort(-sims, axis=1, kind="stable")[:, :probes], True, 1)
        rows = self.read(np.flatnonzero(probed.any(0)))
        tables = [q[:, a:z] @ book.T for book, a, z in zip(books, bounds, bounds[1:])]
        held = self.spark.sparkContext.broadcast((probed, sims, tables))
        most = rerank * limit
        key = rows.schema["key"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            probed, sims, tables = held.value
            best: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
            for b in batches:
                code = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint8).reshape(b.num_rows, -1)
                cell = b.column(2).to_numpy()
                name = np.array(b.column(0).to_pylist(), object)
                for c in np.unique(cell):
                    at = np.flatnonzero(cell == c)
                    for k in np.flatnonzero(probed[:, c]).tolist():
                        s = sims[k, c] + sum(t[k][code[at, j]] for j, t in enumerate(tables))
                        s, names, cells = (np.concatenate(x) for x in zip(best.get(k, (np.zeros(0), np.zeros(0, object), np.zeros(0, int))), (s, name[at], np.full(len(at), c))))
                        if len(s) > most:
                            top = np.argpartition(-s, most - 1)[:most]
                            s, names, cells = s[top], names[top], cells[top]
                        best[k] = s, names, cells
            for k, (s, names, cells) in best.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), k, np.int32)), pa.array(names.tolist(), pa.int64() if key == "bigint" else None), pa.array(cells.astype(np.int32)), pa.array(s)], names=["at", "key", "cell", "near"])

        found = rows.select("key", "code", "cell").mapInArrow(run, f"at int, key {key}, cell int, near double")
        first = F.row_number().over(Window.partitionBy("at").orderBy(F.desc("near"), "key"))
        found = found.withColumn("n", first).where(F.col("n") <= most).select("at", "key", "cell").distinct()
        named = self.spark.createDataFrame([(k, v, list(map(float, x))) for k, (v, x) in enumerate(asked)], f"at int, query_id {kind}, asked array<double>")
        whole = rows.select("key", "cell", "vector").join(F.broadcast(found), ["key", "cell"]).join(F.broadcast(named), "at")  # `most` for each query of a block
        rank = F.row_number().over(Window.partitionBy("at").orderBy(F.desc(F.round("score", 9)), "key"))
        return whole.withColumn("score", cosine(F.col("vector"), F.col("asked"))).withColumn("rank", rank).where(F.col("rank") <= limit).select("query_id", "key", "score", "rank")


def _unit(v: Sequence[float]) -> np.ndarray:
    a = np.array(v, np.float64)
    return a / np.linalg.norm(a)


def centred(t: pa.Table, k: int) -> pa.Table:
    """Centres of a group of (part, vector) rows, which is a sample."""
    m = t.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(t.num_rows, -1).astype(np.float64)
    c = lloyd(m[np.lexsort(m.T[::-1])], k)
    return pa.table({"part": pa.array([t.column("part")[0].as_py()] * len(c), pa.int32()), "number": pa.array(range(len(c)), pa.int32()), "vector": pa.array(c.astype(np.float32).tolist(), pa.list_(pa.float32()))})
