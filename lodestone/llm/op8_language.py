"""Language ID by bit-sliced Bloom filters of n-grams.

One table of `2**bits` rows holds all languages' filters side by side: row r is a bit
mask of the languages whose filter has bit r. The AND of an n-gram's `HASHES` rows is the
mask of all languages that contain it. A text's n-grams give a popcount for each
language; from n n-grams, h hits and the filter's false positive rate f (its fill to the
power HASHES), the corrected count is (h - n f) / (1 - f). The language of the greatest
corrected count is predicted, the first by name among equals; score is the share of the
text's n-grams that it accounts for, within 0 and 1.

A language's filter holds the n-grams (3 and 4 bytes of letters, words padded by one
blank) that make up at least `min_share` of its training n-grams. They are counted over
a sample of at most about `train_docs` labelled documents for each language, chosen by a
hash of the id; this is the only bound. Up to 64 languages share a word of a mask; more take
further words.

Null texts and texts without a letter get `und` and score 0. A text of which no n-gram
is known to any language gets the language with the most training documents, score 0.
Null labels are not learned from; without any labelled document every text is `und`.
Repeated rows are judged row by row, other columns are ignored, and an empty table gives
an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.shared import dropped, mapped, written

HASHES = 3
SIZES = (3, 4)
UND = "und"
TRAIN_DOCS = 4000
#: Bytes of text worked on at once: some forty bytes of arrays stand for each.
SLICE = 1 << 18
#: Letters, after lower-casing: a-z and the bytes of all non-ASCII characters.
LETTER = (np.arange(256) >= 128) | ((np.arange(256) >= 97) & (np.arange(256) <= 122))


def padded(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts with blanks for all that is no letter, one blank before each
    text and one at the end; where each text starts, and where the last ends."""
    n = len(offs) - 1
    low = tv.LOWER[data]
    out = np.full(len(data) + n + 1, 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offs))] = np.where(LETTER[low], low, 32)
    return out, offs + np.arange(n + 1)


def grams(text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of all n-grams with letters throughout their inner bytes, and their places."""
    n = len(text) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    solid = text != 32
    ok = solid[1 : n + 1].copy()
    for k in range(2, size - 1):
        ok &= solid[k : n + k]
    at = np.flatnonzero(ok)
    code = np.zeros(len(at), np.uint32)
    for k in range(size):
        code = (code << np.uint32(8)) | text[at + k]
    return code, at


def rows_of(code: np.ndarray, size: int, bits: int) -> Iterator[np.ndarray]:
    """The table rows of n-grams, one array for each hash function."""
    h = tv.mix(code.astype(np.uint64) + np.uint64(size << 40))
    for k in range(HASHES):
        yield (h >> np.uint64(k * 21)) & np.uint64((1 << bits) - 1)


class Filters:
    """The bit-sliced filters of all languages."""

    def __init__(self, contents: dict[str, dict[int, list[int]]], docs: dict[str, int], bits: int):
        self.langs, self.bits = sorted(contents), bits
        self.table = np.zeros((max(1, -(-len(self.langs) // 64)), 1 << bits), np.uint64)
        for k, lang in enumerate(self.langs):
            for size, codes in contents[lang].items():
                for rows in rows_of(np.array(codes, np.uint32), size, bits):
                    self.table[k // 64][rows] |= np.uint64(1 << (k % 64))
        fill = np.array([((self.table[k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(len(self.langs))])
        self.false_positive = fill**HASHES
        self.usual = min(self.langs, key=lambda x: (-docs.get(x, 0), x), default=UND)

    def hits(self, text: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """n-grams of each text, and how many of them each language contains."""
        n, hit = np.zeros(len(begins) - 1, np.int64), np.zeros((len(self.langs), len(begins) - 1), np.int64)
        for size in SIZES:
            code, at = grams(text, size)
            firsts = np.searchsorted(at, begins)
            n += np.diff(firsts)
            rows = list(rows_of(code, size, self.bits))
            for w, table in enumerate(self.table):
                mask = table[rows[0]]
                for r in rows[1:]:
                    mask &= table[r]
                for k in range(64 * w, min(64 * w + 64, len(self.langs))):
                    hit[k] += tv.per_text((mask >> np.uint64(k % 64)) & np.uint64(1), firsts)
        return n, hit

    def decide(self, col: pa.Array) -> tuple[list[str], list[float]]:
        """The language and score of each text of a column."""
        langs, scores = [], []
        for i, j, data, offs in tv.text_slices(col, SLICE):
            text, begins = padded(data, offs)
            n, hit = self.hits(text, begins)
            f = self.false_positive[:, None]
            real = np.maximum((hit - n * f) / np.maximum(1 - f, 1e-9), 0)
            best = real.argmax(axis=0) if self.langs else np.zeros(j - i, np.int64)
            ascii_ = tv.per_text(LETTER[tv.LOWER[data]] & (data < 128), offs)
            high = tv.per_text(data >= 128, offs)
            for d in range(j - i):
                letter = ascii_[d] or (high[d] and any(map(str.isalpha, col[i + d].as_py())))
                if not letter or not self.langs:
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                top = real[best[d], d]
                langs.append(self.langs[best[d]] if top > 0 else self.usual)
                scores.append(min(1.0, float(top / n[d])) if top > 0 else 0.0)
        return langs, scores


def fitted(docs: DataFrame, train: Column, train_docs: int = TRAIN_DOCS, min_share: float = 2e-5, bits: int = 18) -> Filters:
    """Filters from the rows of `docs` (doc_id, text, lang) where `train` holds."""
    known = docs.where(train & F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    if not sizes:
        return Filters({}, {}, bits)
    share = F.create_map(*(F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, train_docs / n))))
    sample = known.where((F.xxhash64("doc_id") % 1_000_003 + 1_000_003) % 1_000_003 < share[F.col("lang")] * 1_000_003)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        for b in batches:
            by_lang = defaultdict(list)
            for k, lang in enumerate(b.column(0).to_pylist()):
                by_lang[lang].append(k)
            for lang, at in by_lang.items():
                for _, _, data, offs in tv.text_slices(b.column(1).take(pa.array(at))):
                    text, _ = padded(data, offs)
                    for size in SIZES:
                        code, count = np.unique(grams(text, size)[0], return_counts=True)
                        if old := total.get((lang, size)):
                            both = np.concatenate((old[0], code))
                            code, back = np.unique(both, return_inverse=True)
                            count = np.bincount(back, np.concatenate((old[1], count))).astype(np.int64)
                        total[lang, size] = code, count
        for (lang, size), (code, count) in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(code)), pa.array(np.full(len(code), size, np.int32)), pa.array(code.astype(np.int64)), pa.array(count.astype(np.int64))], names=["lang", "size", "code", "n"])

    counts = written(mapped(sample.select("lang", "text"), run, "lang string, size int, code long, n long").groupBy("lang", "size", "code").agg(F.sum("n").alias("n")), "grams")
    total = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))  # a row for each language and size
    contents: dict[str, dict[int, list[int]]] = {lang: {} for lang in sizes}
    for r in counts.join(F.broadcast(total), ["lang", "size"]).where(F.col("n") >= min_share * F.col("total")).collect():  # 1 / min_share for each
        contents[r["lang"]].setdefault(r["size"], []).append(r["code"])
    dropped(counts)
    return Filters(contents, sizes, bits)


def identified(docs: DataFrame, filters: Filters) -> DataFrame:
    """The documents with lang_pred and score; columns of those names are replaced."""
    docs = docs.drop("lang_pred", "score")
    held = docs.sparkSession.sparkContext.broadcast(filters)  # 2**bits rows, whatever the corpus
    at, names = docs.columns.index("text"), [*docs.columns, "lang_pred", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, scores = held.value.decide(b.column(at))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=names)

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "lang_pred string, score double"])
    return mapped(docs, run, schema)


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filters = fitted(docs, ~held_out())
    return identified(docs.select("doc_id", "text"), filters).select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
