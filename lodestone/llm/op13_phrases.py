r"""Phrase collocations by contiguous pattern growth, as PrefixSpan grows its patterns.

Words are 64-bit hashes of language and word on the way (two of a hundred million frequent ones
share one with a probability near 3e-4; if so, a clash is raised, not merged). Counts of words, then of
adjacent pairs of frequent words, leave the pairs that are frequent; maps of a fixed number of bits tell
them where the texts are read (a fuller map passes more, the counts decide). Each occurrence of a
frequent pair becomes a pointer with what a phrase may grow into: the words up to three further on, ended where
a pair is not frequent. Equal ones are summed as they are read.

Pointers are dealt by ranges of their words, so each prefix has one task, but a prefix with too many
for one is split between neighbouring ones. A task projects its pointers by prefix and grows
each frequent prefix to the right, depth first, handing on only pointers of frequent extensions. What
touches an end of the task's range may go on in the next and is handed over as it is; sums over tasks
decide it. No task holds more than its range, and none of it is cut by a limit.

The scores' parts are looked up by joins, exact in 38 digits. A candidate lies inside a longer
one with as many occurrences only if it lies so inside one that is longer by a word, as that one has no fewer:
so first and last parts of each candidate tell what is dropped.

Texts that are null, empty or without words have no phrases; a null lang is `und`. Repeated rows count each. Phrases do not
cross pieces, of which empty ones count for nothing. Very long texts are read whole. Languages are ranked by themselves. Further
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.shared import bitmap, mapped, marked, written

MAX_WORDS = 5
#: Bits of the maps of frequent words and pairs.
MAP_BITS = 25
#: Distinct counts that a task holds before it hands them on.
HELD = 1 << 20
#: Pointers for each range.
RANGE_ROWS = 1 << 20
SEPARATOR = tv.byte_table(b".,;:!?\n\v\f\r")
WORD = ~(SEPARATOR | tv.byte_table(b" \t"))
#: The words of a phrase, as hashes; 0 where it has ended.
WORDS = [f"w{k}" for k in range(1, MAX_WORDS + 1)]
UND = "und"


def words_of(langs: pa.Array, data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of lower-cased texts, their hashes with the language, and
    whether the word before is of the same piece."""
    starts, ends, firsts = tv.spans(data, offs, WORD)
    cut = np.concatenate(([0], np.cumsum(SEPARATOR[data])))
    follows = np.zeros(len(starts), bool)
    follows[1:] = cut[starts[1:]] == cut[ends[:-1]]
    follows[firsts[:-1][firsts[:-1] < len(starts)]] = False
    kinds = langs.dictionary_encode()
    raw, at = tv.column_bytes(kinds.dictionary.cast(pa.string()))
    lang = tv.hash_spans(raw, at[:-1], at[1:])[kinds.indices.to_numpy()]
    h = tv.pair_hash(lang[tv.owner(firsts, len(starts))], tv.hash_spans(data, starts, ends))
    return starts, ends, np.where(h == 0, np.uint64(1), h), follows


class Counts:
    """Sums of rows of 64-bit integers that are held up to a bound: (rows, count, a place of each)."""

    def __init__(self) -> None:
        self.rows: list[np.ndarray] = []
        self.n: list[np.ndarray] = []
        self.size = 0

    def add(self, rows: np.ndarray, n: np.ndarray) -> None:
        """rows: distinct, one for each column."""
        self.rows.append(rows)
        self.n.append(n)
        self.size += rows.shape[1]

    def full(self) -> bool:
        if self.size > HELD:
            rows, n, _ = summed(np.hstack(self.rows), np.concatenate(self.n))
            self.rows, self.n, self.size = [rows], [n], rows.shape[1]
        return self.size > HELD // 2

    def out(self, names: list[str]) -> Iterator[pa.RecordBatch]:
        if self.size:
            rows, n, _ = summed(np.hstack(self.rows), np.concatenate(self.n))
            yield pa.RecordBatch.from_arrays([*(pa.array(r.view(np.int64)) for r in rows), pa.array(n)], names=names)
        self.__init__()


def summed(rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct columns in order, with sums, and where each was first."""
    order = np.lexsort(rows[::-1])
    rows = rows[:, order]
    new = np.ones(rows.shape[1], bool)
    new[1:] = (rows[:, 1:] != rows[:, :-1]).any(0)
    at = np.flatnonzero(new)
    return rows[:, at], np.add.reduceat(n[order], at) if len(at) else n[:0], order[at]


def texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UND)).alias("lang"), "text").where(F.col("text").isNotNull())


def word_counts(docs: DataFrame) -> DataFrame:
    """(lang, word, id, n) of every word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(1), 1 << 22):
                langs, data = b.column(0).slice(i, j - i), tv.LOWER[data]
                starts, ends, h, _ = words_of(langs, data, offs)
                rows, n, at = summed(h[None, :], np.ones(len(h), np.int64))
                starts, ends = starts[at], ends[at]
                raw = data[tv.inside(starts, ends)]
                cut = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
                word = pa.StringArray.from_buffers(len(at), pa.py_buffer(cut), pa.py_buffer(raw))
                who = np.searchsorted(offs, starts, "right") - 1
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(who)), word, pa.array(rows[0].view(np.int64)), pa.array(n)], names=["lang", "word", "id", "n"])

    return mapped(texts(docs), run, "lang string, word string, id long, n long").groupBy("lang", "word", "id").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(pair, n) of adjacent words that are both frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts()
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(1)):
                _, _, h, follows = words_of(b.column(0).slice(i, j - i), tv.LOWER[data], offs)
                some = marked(frequent, h)
                at = np.flatnonzero(follows[1:] & some[1:] & some[:-1]) if len(h) else np.zeros(0, np.int64)
                rows, n, _ = summed(tv.pair_hash(h[at], h[at + 1])[None, :], np.ones(len(at), np.int64))
                held.add(rows, n)
                if held.full():
                    yield from held.out(["pair", "n"])
        yield from held.out(["pair", "n"])

    return mapped(texts(docs), run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def pointers(docs: DataFrame, frequent: np.ndarray, pairs: np.ndarray) -> DataFrame:
    """(w1 ... w5, n): each occurrence of a frequent pair with what follows, equal ones of a task summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Counts()
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(1)):
                _, _, h, follows = words_of(b.column(0).slice(i, j - i), tv.LOWER[data], offs)
                n, some = len(h), marked(frequent, h)
                # whether the pair that ends in a word is frequent
                good = np.zeros(n + MAX_WORDS, bool)
                at = np.flatnonzero(follows[1:] & some[1:] & some[:-1]) if n else np.zeros(0, np.int64)
                good[at[marked(pairs, tv.pair_hash(h[at], h[at + 1]))] + 1] = True
                at = np.flatnonzero(good[1:n])
                rows = np.zeros((MAX_WORDS, len(at)), np.uint64)
                on = np.ones(len(at), bool)
                for k in range(MAX_WORDS):
                    on &= (k == 0) | good[at + k]
                    rows[k, on] = h[at[on] + k]
                rows, c, _ = summed(rows, np.ones(len(at), np.int64))
                held.add(rows, c)
                if held.full():
                    yield from held.out([*WORDS, "n"])
        yield from held.out([*WORDS, "n"])

    return mapped(texts(docs), run, ", ".join(f"{w} long" for w in [*WORDS, "n"]))


def grown(words: np.ndarray, n: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The phrases of two words or more among a range of pointers, with their counts: those with
    `least` occurrences, and those that an end of the range may have cut."""
    order = np.lexsort(words[::-1])
    words, n = words[:, order], n[order]
    upto = np.concatenate(([0], np.cumsum(n)))
    found: list[tuple[int, int, int]] = []

    def grow(depth: int, lo: int, hi: int) -> None:
        """Extend the prefix of `depth` words that pointers lo to hi share."""
        at = words[depth, lo:hi]
        cuts = np.concatenate(([lo], np.flatnonzero(at[1:] != at[:-1]) + lo + 1, [hi]))
        count = upto[cuts[1:]] - upto[cuts[:-1]]
        live = (words[depth, cuts[:-1]] != 0) & ((count >= least) | (cuts[:-1] == 0) | (cuts[1:] == len(n)))
        for k in np.flatnonzero(live).tolist():
            a, z = int(cuts[k]), int(cuts[k + 1])
            if depth:
                found.append((depth + 1, a, int(count[k])))
            if depth + 1 < MAX_WORDS:
                grow(depth + 1, a, z)

    if len(n):
        grow(0, 0, len(n))
    size, at, count = (np.array(x, np.int64) for x in (zip(*found) if found else ((), (), ())))
    out = words[:, at]
    out[np.arange(MAX_WORDS)[:, None] >= size] = 0
    return out, count


def phrases(found: DataFrame, least: int) -> DataFrame:
    """(w1 ... w5, n) of the phrases with `least` occurrences, from a table of pointers."""
    ranges = max(1, -(-found.count() // RANGE_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not (parts := list(batches)):
            return
        held = pa.Table.from_batches(parts)  # a range, RANGE_ROWS or so
        words = np.array([held.column(w).to_numpy() for w in WORDS])
        rows, n = grown(words, held.column("n").to_numpy(), least)
        yield pa.RecordBatch.from_arrays([*map(pa.array, rows), pa.array(n)], names=[*WORDS, "n"])

    dealt = found.repartitionByRange(max(ranges, found.sparkSession.sparkContext.defaultParallelism), *WORDS)
    return mapped(dealt, run, ", ".join(f"{w} long" for w in [*WORDS, "n"])).groupBy(*WORDS).agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def part(first: int, end: int) -> F.Column:
    """The words first to end - 1 of a phrase, as a key."""
    return F.struct(*((F.col(WORDS[first + k]) if first + k < end else F.lit(0).cast("long")).alias(w) for k, w in enumerate(WORDS)))


def collocations(docs: DataFrame, least: int = 100, hidden: int = 100, top: int = 2000) -> DataFrame:
    """Each language's first `top` phrases of two to five words with `least` occurrences, but those
    inside a longer one that has `hidden` hundredths of their occurrences or more; lang, rank, phrase, a, l, r, n, score."""
    vocabulary = written(word_counts(docs), "vocabulary")
    total = vocabulary.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = written(vocabulary.where(F.col("n") >= least), "frequent")
    if frequent.groupBy("id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count():
        raise RuntimeError("two frequent words share a hash")
    words = bitmap(frequent, "id", MAP_BITS)
    pairs = bitmap(pair_counts(docs, words).where(F.col("n") >= least), "pair", MAP_BITS)
    found = written(phrases(written(pointers(docs, words, pairs), "pointers"), least), "phrases")

    none = F.lit(0).cast("long")
    single = frequent.select(F.struct(F.col("id").alias("w1"), *(none.alias(w) for w in WORDS[1:])).alias("part"), F.col("n").alias("f"))
    facts = found.select(F.struct(*WORDS).alias("part"), F.col("n").alias("f")).unionByName(single)
    size = sum((F.col(w) != 0).cast("int") for w in WORDS)
    # every cut of a phrase asks for its two parts
    asked = []
    for m in range(2, MAX_WORDS + 1):
        for k in range(1, m):
            for side, key in (("l", part(0, k)), ("r", part(k, m))):
                inside = k == (m - 1 if side == "l" else 1) and m > 2
                asked.append(F.when(size == m, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), key.alias("part"), F.lit(inside).alias("inside"))))
    parts = found.select(F.struct(*WORDS).alias("phrase"), F.col("n").alias("a"), F.explode(F.filter(F.array(*asked), lambda x: x.isNotNull())).alias("x"))
    known = written(parts.select("phrase", "a", "x.*").join(facts, "part"), "parts")
    lost = known.where(F.col("inside") & (100 * F.col("a") >= hidden * F.col("f"))).select(F.col("part").alias("phrase")).distinct()
    cuts = known.groupBy("phrase", "a", "k").agg(F.max(F.when(F.col("side") == "l", F.col("f"))).alias("l"), F.max(F.when(F.col("side") == "r", F.col("f"))).alias("r"))
    cuts = cuts.join(lost, "phrase", "left_anti").join(frequent.select(F.col("id").alias("first"), "lang"), F.col("phrase.w1") == F.col("first")).join(F.broadcast(total), "lang")  # a row for each language
    exact = "cast({} as decimal(38, 0))".format
    cuts = cuts.withColumn("score", F.expr(f"(1000 * {exact('a')} * {exact('total')}) div ({exact('l')} * {exact('r')})"))
    best = cuts.groupBy("phrase", "lang", "a", "total").agg(F.min(F.struct("score", "k", "l", "r")).alias("x")).select("*", "x.*")
    best = written(best.drop("x", "k"), "scored")

    spelt = best.select("phrase", F.posexplode(F.array(*(F.col(f"phrase.{w}") for w in WORDS))).alias("at", "id")).where("id <> 0")
    spelt = spelt.join(frequent.select("id", "word"), "id").groupBy("phrase").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    named = best.join(spelt.select("phrase", F.array_join("words.word", " ").alias("text")), "phrase")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "text"))
    named = named.withColumn("rank", rank).where(F.col("rank") <= top)
    return named.select("lang", F.col("rank").cast("long").alias("rank"), F.col("text").alias("phrase"), "a", "l", "r", F.col("total").alias("n"), "score")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


#: The same rows in DuckDB: all phrases counted, then joined with their parts.
SQL = r"""
WITH piece AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), place AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0
), total AS (SELECT lang, count(*) AS n FROM place GROUP BY lang),
f AS (
  SELECT lang, w[i:i + m - 1] AS w, count(*) AS f FROM place, range(1, 6) AS t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT lang, w, f AS a, unnest(range(1, len(w))) AS k FROM f WHERE len(w) > 1
), scored AS (
  SELECT lang, cut.w, a, k, l.f AS l, r.f AS r, n, (1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f) AS score
  FROM cut JOIN f AS l USING (lang) JOIN f AS r USING (lang) JOIN total USING (lang) WHERE l.w = cut.w[:k] AND r.w = cut.w[k + 1:]
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), kept AS (
  SELECT * FROM lowest AS x WHERE NOT EXISTS (
    SELECT 1 FROM f AS y WHERE y.lang = x.lang AND len(y.w) = len(x.w) + 1 AND 100 * y.f >= 100 * x.a AND (y.w[:len(x.w)] = x.w OR y.w[2:] = x.w))
)
SELECT * FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank, array_to_string(w, ' ') AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM kept) WHERE rank <= 2000
"""
