"""Whole-batch text primitives: words, hashes and n-grams of many texts as numpy arrays.

A batch of texts is one run of UTF-8 bytes with offsets, as Arrow holds it. Nothing
here keeps a Python object per word. Hashes are 64 bits; two different words among
ten million share one with a probability near 3e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; a longer text is worked on alone, whole.
SLICE_BYTES = 1 << 19

_B = np.uint64(0x9E3779B97F4A7C15)
_B_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def byte_table(pattern_bytes: bytes) -> np.ndarray:
    """256 flags, set for the bytes given."""
    t = np.zeros(256, bool)
    t[np.frombuffer(pattern_bytes, np.uint8)] = True
    return t


#: Bytes of a word `[^\x20\x09-\x0D]+`.
NOT_SPACE = ~byte_table(b" \t\n\v\f\r")
#: Bytes of a word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` after lower-casing.
ALNUM = byte_table(b"0123456789abcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 128)
#: A-Z to a-z, all else unchanged.
LOWER = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), np.arange(256) + 32, np.arange(256)).astype(np.uint8)


def column_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offset of each text; null is empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, offs, data = col.buffers()
    if len(col) == 0 or offs is None:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    o = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    d = np.frombuffer(data, np.uint8)[o[0] : o[-1]] if data is not None else np.zeros(0, np.uint8)
    return d, o - o[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `limit` bytes in all, or of one text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def text_slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, end, bytes, offsets) of each slice of a string column."""
    data, offs = column_bytes(col)
    for i, j in slices(offs, limit):
        yield i, j, data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of the table's bytes that stay inside one text: starts, ends, and
    for each text the index of its first run (one more entry than texts)."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    m = table[data]
    first = np.empty(n, bool)
    last = np.empty(n, bool)
    first[0], first[1:] = m[0], m[1:] & ~m[:-1]
    last[-1], last[:-1] = m[-1], m[:-1] & ~m[1:]
    cut = offsets[:-1][offsets[:-1] < n]
    first[cut] = m[cut]
    end = offsets[1:][offsets[1:] > 0] - 1
    last[end] = m[end]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_B, _B_INV)):
            p = np.full(max(n, 1 << 16), base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit over all."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    pw, inv = _power(len(data) + 1)
    c = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[: len(data)], out=c[1:])
    return mix((c[ends] - c[starts]) * inv[starts])


def hash_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, spans in order; equal bytes, equal hash,
    wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(starts, starts[i] + SLICE_BYTES)), i + 1)
        a, z = starts[i], ends[j - 1]
        out[i:j] = _hash(data[a:z], starts[i:j] - a, ends[i:j] - a)
        i = j
    return out


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of ordered pairs of hashes."""
    return mix(a * np.uint64(0xD1342543DE82EF95) + (b ^ np.uint64(0x2545F4914F6CDD1D)))


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each `width` consecutive entries: one for each place where such a run starts."""
    n = len(h)
    if n < width:
        return np.zeros(0, np.uint64)
    pw, inv = _power(n + 1)
    c = np.zeros(n + 1, np.uint64)
    np.cumsum(h * pw[:n], out=c[1:])
    return mix((c[width:] - c[:-width]) * inv[: n - width + 1])


def owner(firsts: np.ndarray, n: int) -> np.ndarray:
    """The text of each of n runs, from the index of each text's first run."""
    return np.repeat(np.arange(len(firsts) - 1), np.diff(firsts)) if n else np.zeros(0, np.int64)


def inside(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All places of some spans, one span after the other."""
    size = ends - starts
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n places lie in any of the spans."""
    d = np.zeros(n + 1, np.int64)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def per_text(flags: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The sum of each text's entries."""
    c = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return c[firsts[1:]] - c[firsts[:-1]]
