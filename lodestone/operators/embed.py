"""Two vectors for each chunk from a pluggable provider, in Arrow batches."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestone.functions import text as T
from lodestone.schema import EMBEDDING

BATCH, ATTEMPTS, FIRST_WAIT = 100, 3, 1.0


class Provider(Protocol):
    """Anything that turns texts into vectors, and can be sent to executors."""

    dimensions: int

    def embed(self, texts: list[str]) -> np.ndarray: ...


class RateLimited(Exception):
    """A provider's answer that asks to wait."""


class HashingProvider:
    """Offline vectors: signed hashes of lower-cased words, of length 1."""

    def __init__(self, dimensions: int = 3072):
        self.dimensions = dimensions

    def embed(self, texts: list[str]) -> np.ndarray:
        import xxhash

        out = np.zeros((len(texts), self.dimensions), np.float32)
        for row, t in zip(out, texts):
            for w in t.lower().split() or [""]:
                h = xxhash.xxh64_intdigest(w)
                row[(h >> 1) % self.dimensions] += 1 if h & 1 else -1
            row /= np.linalg.norm(row) or 1.0
        return out


def with_retry(call: Callable[[], np.ndarray], attempts: int = ATTEMPTS, wait: float = FIRST_WAIT, sleep: Callable[[float], None] = time.sleep) -> np.ndarray:
    """Calls again, after waits that double, while the provider is rate limited; other
    errors go on at once."""
    for k in range(attempts):
        try:
            return call()
        except RateLimited:
            if k == attempts - 1:
                raise
            sleep(wait * 2**k)
    raise ValueError("attempts must be 1 or more")


def batches(n: int, size: int) -> list[tuple[int, int]]:
    return [(i, min(i + size, n)) for i in range(0, n, size)]


def embed_texts(provider: Provider, texts: list[str], label: str, size: int = BATCH, attempts: int = ATTEMPTS) -> np.ndarray:
    """Vectors in the texts' order; an empty text is sent as one blank."""
    out = np.zeros((len(texts), provider.dimensions), np.float32)
    for k, (a, z) in enumerate(batches(len(texts), size), 1):
        try:
            out[a:z] = with_retry(lambda a=a, z=z: provider.embed([t or " " for t in texts[a:z]]), attempts)
        except Exception as e:
            raise RuntimeError(f"Failed to embed {label} batch {k}: {e}") from e
    return out


def embed_chunks(chunks: DataFrame, provider: Provider, size: int = BATCH, attempts: int = ATTEMPTS) -> DataFrame:
    """EMBEDDING rows: vectors of full_text and summary_text of every chunk."""

    def vectors(m: np.ndarray) -> pa.Array:
        return pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32)), pa.array(np.ascontiguousarray(m).ravel()))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            for a, z in batches(b.num_rows, size):
                p = b.slice(a, z - a)
                full, short = (vectors(embed_texts(provider, [x or "" for x in p.column(k).to_pylist()], label, size, attempts)) for k, label in ((1, "full text"), (2, "summary")))
                yield pa.RecordBatch.from_arrays([p.column(0), full, short], names=["chunk_id", "full_vector", "summary_vector"])

    return chunks.select("id", "full_text", "summary_text").mapInArrow(run, EMBEDDING)


def total_tokens() -> Column:
    """Aggregate: the tokens of all vectors' texts, rounded up once."""
    return F.ceil(F.sum(T.js_length("full_text") + T.js_length("summary_text")) / T.CHARS_PER_TOKEN).cast("long")
