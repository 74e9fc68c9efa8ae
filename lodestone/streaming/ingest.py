"""Ingest of new documents as a stream: files of all formats below a directory, or texts that arrive as
Parquet, are chunked, embedded and upserted, each batch whole and once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lodestone.operators.documents import chunk_files, chunk_texts
from lodestone.operators.embed import Provider, embed_chunks
from lodestone.operators.index import Collection, embedded, points
from lodestone.sources.files import stream_directory


def chunk_stream(spark: SparkSession, folder: str, doc_type: str = "txt") -> DataFrame:
    """A stream of chunks from Parquet files (path, text) that arrive in a folder."""
    return chunk_texts(spark.readStream.schema("path string, text string").parquet(folder), doc_type)


def _upsert(batch: DataFrame, index: Collection, provider: Provider) -> None:
    index.upsert(points(embedded(batch, embed_chunks(batch, provider))))


def ingest(spark: SparkSession, folder: str, index: Collection, provider: Provider, checkpoint: str, doc_type: str = "txt") -> StreamingQuery:
    """Starts the stream over all files that are there. A batch that runs again after a
    failure upserts the same ids, so it changes nothing."""

    def upsert(batch: DataFrame, _: int) -> None:
        batch = batch.persist()
        _upsert(batch, index, provider)
        batch.unpersist()

    return chunk_stream(spark, folder, doc_type).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def ingest_directory(
    spark: SparkSession, root: str, index: Collection, provider: Provider, checkpoint: str, failures: str | None = None, settle: float = 1, every: str | None = None
) -> StreamingQuery:
    """Starts the stream of documents below a directory (sources.files.DocumentStream): what is there, or with
    `every`, an interval, also what arrives later. Files that fail do not stop the rest; their paths and errors go
    to `failures` as JSON, a folder for each batch, which is written anew if the batch runs again. A batch without
    good files upserts nothing. Of a file that has become shorter the index keeps the chunks past its new end."""

    def upsert(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        bad = batch.where("error is not null").select("source_path", "error")
        if failures is not None and not bad.isEmpty():
            bad.write.mode("overwrite").json(f"{failures}/batch={number}")
        good = batch.where("error is null").drop("error", "elapsed_ms")
        if not good.isEmpty():
            _upsert(good, index, provider)
        batch.unpersist()

    out = chunk_files(stream_directory(spark, root, settle)).writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return (out.trigger(processingTime=every) if every else out.trigger(availableNow=True)).start()
