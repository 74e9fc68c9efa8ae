r"""Exact deduplication as a stream over keyed state that never expires.

Arriving documents become slim rows: SHA-256 of the normalised text, identifier, length and
content locator (file and row). A streaming aggregation keeps for each digest, in RocksDB on
the executors' disks with its changes in the checkpoint folder, how many rows had it, and identifier
and locator of the row that stays. Spark combines the rows of a digest in each task before they
move, so a text that a third of all rows share costs a row for each task. There is no watermark:
state is never dropped. A stream that is started again on its checkpoint goes on where it stopped.

A digest that was seen before is a hit, not yet a duplicate. The full normalised bytes of all rows
that hit are then grouped by digest and bytes, again combined in each task, so that any two
are compared whole; a digest under which two contents turn up is split by content. Which rows hit is told by a
map of a fixed number of bits, so texts of rows that are alone do not move (where so many groups are met that the map fills up,
further texts move too).

Texts are equal when they are identical after deleting every character of `[\x20\x09-\x0D]`. Of equal
texts, the row with the most code points in its original text stays, then that with the smallest
doc_id, then the first by file and row: exactly one row of a group stays, repeated rows included. Rows with a null doc_id come
after others of their length; where one stays, keep_id is null. Null, empty and blank texts
are one group. Texts of any length are taken whole. Further columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.shared import bitmap, mapped, marked, shared_dir, written

#: Bytes of new files that one batch of the stream reads.
BATCH_BYTES = 1 << 38
#: Bits of the map of digests that hit.
MAP_BITS = 25
AT = "struct<file:string,row:long>"
SLIM = f"doc_id long, at {AT}, n_chars long, sha binary, key binary, mark long"
STORE = "spark.sql.streaming.stateStore."
#: Settings of the state: on disk, and only changes go to the checkpoint. Its number of stores is its own,
#: as it holds as long as the state, and a store takes 4 MB of disk even if it is empty.
STATE_CONF = {
    STORE + "providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    STORE + "rocksdb.changelogCheckpointing.enabled": "true",
    STORE + "rocksdb.boundedMemoryUsage": "true",
    STORE + "rocksdb.maxMemoryUsageMB": "300",
}
STORES = "spark.sql.streaming.internal.stateStore.partitions"


def located(docs: DataFrame) -> DataFrame:
    """(doc_id, at, text) of documents read from files, as a table or a stream; at: the file and row of the content."""
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), at.alias("at"), "text")


def digests(docs: DataFrame, key_bytes: int, hit: np.ndarray | None = None) -> DataFrame:
    """A slim row for each document: SHA-256 of its normalised text, and the first `key_bytes` bytes of
    it as the key of the state. hit: a map of marks; only rows that it holds come, with their normalised bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(2)):
                keep = tv.NOT_SPACE[data]
                cut = np.concatenate(([0], np.cumsum(keep)))[offs]
                lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offs]
                norm = data[keep].tobytes()
                sha = [hashlib.sha256(norm[a:z]).digest() for a, z in zip(cut[:-1].tolist(), cut[1:].tolist())]
                key = [x[:key_bytes] for x in sha]
                mark = np.array([int.from_bytes(x[:8], "little", signed=True) for x in key], np.int64)
                columns = [b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(np.diff(lead)), pa.array(sha, pa.binary()), pa.array(key, pa.binary()), pa.array(mark)]
                names = ["doc_id", "at", "n_chars", "sha", "key", "mark"]
                if hit is None:
                    yield pa.RecordBatch.from_arrays(columns, names=names)
                    continue
                some = np.flatnonzero(marked(hit, mark))
                texts = pa.array([norm[cut[k] : cut[k + 1]] for k in some.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([*(c.take(pa.array(some)) for c in columns), texts], names=[*names, "norm"])

    return mapped(docs, run, SLIM if hit is None else SLIM + ", norm binary")


def _first():
    """The row that stays: the longest, then by id (null last), then by place."""
    return F.min(F.struct((-F.col("n_chars")).alias("short"), F.col("doc_id").isNull().alias("unnamed"), "doc_id", "at")).alias("first")


def see(stream: DataFrame, checkpoint: str, key_bytes: int = 32, stores: int | None = None) -> None:
    """Bring the state under `checkpoint` up to all documents that the stream has by now. stores: how many
    parts a new state has; none: one for each core of the cluster."""
    conf = stream.sparkSession.conf
    asked = STATE_CONF | {STORES: str(stores or stream.sparkSession.sparkContext.defaultParallelism)}
    before = {k: conf.get(k, None) for k in asked}
    try:
        for k, v in asked.items():
            conf.set(k, v)
        state = digests(located(stream), key_bytes).groupBy("key", "mark").agg(F.count(F.lit(1)).alias("n"), _first())
        state.writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)


def seen(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The state: (key, mark, group_size, first) of every digest so far."""
    value = F.col("value")
    state = spark.read.format("statestore").load(checkpoint)
    return state.select("key.key", "key.mark", value["count"].alias("group_size"), value["min"].alias("first"))


def judged(docs: DataFrame, state: DataFrame, key_bytes: int = 32) -> DataFrame:
    """Documents with keep_id, group_size, kept and text_sha256, by a state that has seen just them."""
    groups = written(state.where("group_size > 1"), "groups")
    hit = bitmap(groups, "mark", MAP_BITS)
    docs = located(docs)
    # all bytes of rows that hit: two rows are of one content only if they fall into one of these groups
    contents = digests(docs, key_bytes, hit).groupBy("key", "norm").agg(F.count(F.lit(1)).alias("n"))
    odd = written(contents.groupBy("key").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1").select("key"), "odd")
    rows = written(digests(docs, key_bytes), "slim")
    own = F.struct(F.lit(0).cast("long").alias("short"), F.lit(False).alias("unnamed"), "doc_id", "at")
    out = rows.join(groups.drop("mark"), "key", "left").withColumns({"group_size": F.coalesce("group_size", F.lit(1).cast("long")), "first": F.coalesce("first", own)})
    if odd.limit(1).count():
        clashing = written(digests(docs, key_bytes, hit).join(odd, "key", "left_semi"), "clashing")
        content = clashing.groupBy("key", "norm").agg(F.count(F.lit(1)).alias("group_size"), _first())
        out = out.join(odd, "key", "left_anti").unionByName(clashing.join(content, ["key", "norm"]).drop("norm"))
    return out.select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size", (F.col("at") == F.col("first.at")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"),
    )


def deduplicated(spark: SparkSession, path: str, key_bytes: int = 32, checkpoint: str | None = None, **limit: int) -> DataFrame:
    """Every document of a folder (or glob) of Parquet files, judged among all of them. checkpoint: where
    the state is; none: a new one in the shared folder. limit: the stream's option for what a batch reads."""
    docs = spark.read.parquet(path)
    where = checkpoint or f"{shared_dir(spark)}/seen-{uuid.uuid4().hex}"
    see(spark.readStream.schema(docs.schema).options(**(limit or {"maxBytesPerTrigger": BATCH_BYTES})).parquet(path), where, key_bytes)
    return judged(docs, seen(spark, where), key_bytes)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a pattern, as a stream's path may not be a single file
    return deduplicated(spark, f"{sf_dir}/documents.parque[t]").select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


#: The same rows in DuckDB.
SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
n AS (SELECT r, doc_id, length(text) AS n, regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g') AS norm FROM t),
g AS (SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS size, first_value(doc_id) OVER w AS keep_id, row_number() OVER w AS k FROM n WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST, r))
SELECT doc_id, keep_id, CAST(size AS BIGINT) AS group_size, k = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""
