"""Benchmark decontamination by a generalised suffix automaton of the test items.

The items' words (A-Z lower-cased, runs of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`) make one
automaton. Each document streams through it and carries the longest match that ends at
the current word. Where the match reaches `window` words, the last `window` of them are
a window of the items that the state holds; an item of fewer words counts when the match
ends with the whole of it. Only runs of words whose every neighbouring pair stands in
some item are streamed: no other word can be part of a match of two words.

The items are the small side. They are cut into automata of at most `block_words` words;
one is broadcast at a time. Each but the first passes over the documents and writes what it
meets, one row a text with hits; a join adds that to what the first one meets. No item is left out.

Null, empty and wordless texts have no words, no hits and no items; the digest is that
of the empty string. Items without words match nothing; items with the same text, and
rows with the same id, all count (an item id once in a document); items with a null id mark
their words, but are not counted or named. A text of any length is streamed whole, by its task alone. Other columns are
ignored. With no items no document has hits; with no documents the result is empty.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.shared import mapped, written
from lodestone.llm.suffix_automaton import SuffixAutomaton

WINDOW = 10
#: Words of items in one automaton: near 100 MB in a Python worker at the most.
BLOCK_WORDS = 100_000
SPAN = pa.struct([("first", pa.int32()), ("last", pa.int32())])
FOUND = "n_words long, hits array<struct<first:int,last:int>>, items array<string>"


def words(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, first word of each text, and hashes of the words."""
    low = tv.LOWER[data]
    starts, ends, firsts = tv.spans(low, offs, tv.ALNUM)
    return starts, ends, firsts, tv.hash_spans(low, starts, ends)


class Automaton(SuffixAutomaton):
    """The suffix automaton of the items' words: held[s] has the items with the windows whose
    state is s, short[s] (words, item) of the short items that end every match of s, the
    longest first.
    """

    def __init__(self, items: list[tuple[str | None, list[int]]], window: int):
        super().__init__()
        self.window = window
        vocabulary = np.unique(np.array([w for _, seq in items for w in seq], np.uint64))
        self.vocabulary = vocabulary
        coded = [(item, np.searchsorted(vocabulary, np.array(seq, np.uint64)).tolist()) for item, seq in items if seq]
        pairs = {a * len(vocabulary) + b for _, s in coded for a, b in zip(s, s[1:])}
        self.pairs = np.array(sorted(pairs), np.int64)
        self.shortest = min((min(len(s), window) for _, s in coded), default=window)
        for _, seq in coded:
            last = 0
            for w in seq:
                last = self.add(last, w)
        self.unnamed = False
        self.held: dict[int, set[str]] = {}
        own: dict[int, set[tuple[int, str]]] = {}
        for item, seq in coded:
            s = 0
            for k, w in enumerate(seq, 1):
                s = self.nxt[s][w]
                if k >= window:
                    self.held.setdefault(self.at(s, window), set()).update(() if item is None else (item,))
            if len(seq) < window:
                own.setdefault(self.at(s, len(seq)), set()).add((len(seq), item or ""))
                self.unnamed |= item is None
        self.short: list[tuple[tuple[int, str], ...]] = [()] * len(self.nxt)
        for s in sorted(range(1, len(self.nxt)), key=self.length.__getitem__):
            self.short[s] = tuple(sorted(own.get(s, ()), reverse=True)) + self.short[self.link[s]]
        self.any_short = bool(own)

    def at(self, s: int, n: int) -> int:
        """The state of the last n words of a string of state s."""
        while self.length[self.link[s]] >= n:
            s = self.link[s]
        return s

    def stream(self, seq: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans (first and last word) of the windows in a run of words, and their items."""
        nxt, link, length, short, window = self.nxt, self.link, self.length, self.short, self.window
        s = n = 0
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        for i, w in enumerate(seq):
            while (t := nxt[s].get(w)) is None and s:
                s = link[s]
                n = length[s]
            if t is None:
                continue
            s, n = t, n + 1
            if n >= window:
                spans.append((i - window + 1, i))
                items |= self.held[self.at(s, window)]
            for k, item in short[s]:
                if k <= n:
                    spans.append((i - k + 1, i))
                    items.add(item)
        return spans, items - {""} if self.unnamed else items

    def runs(self, h: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Codes of the words (-1: in no item), and the runs that may hold a window."""
        v = self.vocabulary
        if not len(v) or not len(h):
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        code = np.minimum(np.searchsorted(v, h), len(v) - 1)
        code = np.where(v[code] == h, code, -1)
        if self.shortest < 2 or not len(self.pairs):
            joined = (code[:-1] >= 0) & (code[1:] >= 0)
        else:
            key = code[:-1] * len(v) + code[1:]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            joined = (self.pairs[at] == key) & (code[:-1] >= 0) & (code[1:] >= 0)
        # joined[i]: word i + 1 goes on from word i in one text
        cut = firsts[1:-1]
        cut = cut[(cut > 0) & (cut < len(h))]
        joined[cut - 1] = False
        begin = np.flatnonzero((code >= 0) & np.concatenate(([True], ~joined)))
        end = np.flatnonzero((code >= 0) & np.concatenate((~joined, [True]))) + 1
        long = end - begin >= self.shortest
        return code, begin[long], end[long]


def automata(bench: DataFrame, window: int, block_words: int) -> Iterator[Automaton]:
    """Automata of all items, each of at most `block_words` words or of one item."""
    block: list[tuple[str | None, list[int]]] = []
    n = 0
    for r in bench.select(F.col("item_id").cast("string"), "text").toLocalIterator():
        data, offs = tv.column_bytes(pa.array([r[1]], pa.string()))
        seq = words(data, offs)[3].tolist()
        if block and n + len(seq) > block_words:
            yield Automaton(block, window)
            block, n = [], 0
        block.append((r[0], seq))
        n += len(seq)
    yield Automaton(block, window)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans united where they meet."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


HITS = "hits array<struct<first:int,last:int>>, items array<string>"
#: Columns of its own, beside any that the documents have.
_KEY, _HITS, _ITEMS = "_lodestone_key", "_lodestone_hits", "_lodestone_items"


def hits_in(auto: Automaton, h: np.ndarray, firsts: np.ndarray) -> tuple[list[list[tuple[int, int]]], list[set[str]]]:
    """Spans and items of each text, from the hashes of their words."""
    spans: list[list[tuple[int, int]]] = [[] for _ in firsts[1:]]
    items: list[set[str]] = [set() for _ in firsts[1:]]
    code, begin, end = auto.runs(h, firsts)
    who = np.searchsorted(firsts, begin, "right") - 1
    for a, z, d in zip(begin.tolist(), end.tolist(), who.tolist()):
        got, own = auto.stream(code[a:z].tolist())
        base = a - int(firsts[d])
        spans[d] += [(x + base, y + base) for x, y in got]
        items[d] |= own
    return spans, items


def columns(spans: list[list[tuple[int, int]]], items: list[set[str]]) -> list[pa.Array]:
    return [pa.array([[{"first": x, "last": y} for x, y in merged(s)] for s in spans], pa.list_(SPAN)), pa.array([sorted(s) for s in items], pa.list_(pa.string()))]


def _met(docs: DataFrame, auto: Automaton) -> DataFrame:
    """(key, hits, items) of the texts that hold spans of one automaton's items."""
    held = docs.sparkSession.sparkContext.broadcast(auto)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(1)):
                _, _, firsts, h = words(data, offs)
                spans, items = hits_in(held.value, h, firsts)
                some = [d for d, s in enumerate(spans) if s]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i).take(pa.array(some, pa.int64())), *columns([spans[d] for d in some], [items[d] for d in some])], names=["key", "hits", "items"])

    return mapped(docs.select(F.xxhash64("text").alias("key"), "text"), run, f"key long, {HITS}")


#: Of some rows: their columns, bytes and offsets of their texts, starts and ends of the words,
#: the first word of each text, and its spans and items; gives the columns of a result.
Finish = Callable[[list[pa.Array], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[tuple[int, int]]], list[set[str]]], list[pa.Array]]


def _judged(docs: DataFrame, bench: DataFrame, window: int, block_words: int, schema: str, names: list[str], finish: Finish) -> DataFrame:
    """What `finish` makes of the documents and their hits, in the task that finds them: with a
    second function behind it each task would hold two Python workers."""
    spark = docs.sparkSession
    at, n = docs.columns.index("text"), len(docs.columns)
    blocks = automata(bench, window, block_words)
    first = spark.sparkContext.broadcast(next(blocks))
    # of further automata only what they met is written, and joined at last
    further = [written(_met(docs, auto), "met") for auto in blocks]
    if further:
        every = further[0]
        for x in further[1:]:
            every = every.unionByName(x)
        sums = every.groupBy(F.col("key").alias(_KEY)).agg(F.flatten(F.collect_set("hits")).alias(_HITS), F.flatten(F.collect_set("items")).alias(_ITEMS))
        ready = docs.withColumn(_KEY, F.xxhash64("text")).join(sums, _KEY, "left").select(*docs.columns, _HITS, _ITEMS)
    else:
        none = F.lit(None)
        ready = docs.select("*", none.cast("array<struct<first:int,last:int>>").alias(_HITS), none.cast("array<string>").alias(_ITEMS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(at)):
                starts, ends, firsts, h = words(data, offs)
                spans, items = hits_in(first.value, h, firsts)
                more = b.column(n).slice(i, j - i)
                for d in np.flatnonzero(more.is_valid()).tolist():
                    spans[d] += [(x["first"], x["last"]) for x in more[d].as_py()]
                    items[d] |= set(b.column(n + 1)[i + d].as_py())
                cols = [c.slice(i, j - i) for c in b.columns[:n]]
                yield pa.RecordBatch.from_arrays(finish(cols, data, offs, starts, ends, firsts, spans, items), names=names)

    return mapped(ready, run, schema)


def found(docs: DataFrame, bench: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, with columns n_words, hits (united spans of word places) and items
    (sorted as strings); columns of those names in the input are replaced."""
    docs = docs.drop("n_words", "hits", "items")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), FOUND])

    def finish(cols, data, offs, starts, ends, firsts, spans, items) -> list[pa.Array]:
        return [*cols, pa.array(np.diff(firsts)), *columns(spans, items)]

    return _judged(docs, bench, window, block_words, schema, [*docs.columns, "n_words", "hits", "items"], finish)


def decontaminated(docs: DataFrame, bench: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """The documents without test items: every span found is cut out of the text, from
    its first word to its last, and documents of which such spans are more than
    `max_coverage` of the words go. n_chars follows the text; other columns stay, but n_words, hits and items."""
    docs = docs.drop("n_words", "hits", "items")
    names, types = docs.columns, {f.name: f.dataType.simpleString() for f in docs.schema}
    schema = ", ".join(f"`{n}` {types[n]}" for n in names)
    at = names.index("text")

    def finish(cols, data, offs, starts, ends, firsts, spans, items) -> list[pa.Array]:
        stay = np.ones(len(spans), bool)
        cut: dict[int, str] = {}
        for d in (d for d, s in enumerate(spans) if s):
            hits, own, of = merged(spans[d]), int(firsts[d]), int(firsts[d + 1] - firsts[d])
            stay[d] = sum(y - x + 1 for x, y in hits) <= max_coverage * of
            parts, z = [], offs[d]
            for x, y in hits:
                parts.append(data[z : starts[own + x]])
                z = ends[own + y]
            cut[d] = np.concatenate([*parts, data[z : offs[d + 1]]]).tobytes().decode()
        if cut:
            texts = cols[at].to_pylist()
            for d, t in cut.items():
                texts[d] = t
            cols[at] = pa.array(texts, pa.string())
        return [c.filter(pa.array(stay)) for c in cols]

    out = _judged(docs, bench, window, BLOCK_WORDS, schema, names, finish)
    return out.withColumn("n_chars", F.length("text").cast(types["n_chars"])).select(*names) if "n_chars" in names else out


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = found(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, x: n + x["last"] - x["first"] + 1)
    return hit.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


#: The same rows in DuckDB: windows as joined words, met with every place of a text.
SQL = r"""
WITH item AS (
  SELECT item_id, row_number() OVER () AS r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), size AS (SELECT DISTINCT n FROM win), place AS (
  SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, size WHERE len(w) >= n)
), met AS (
  SELECT r, place.n, i, item_id FROM place JOIN win ON win.n = place.n AND win.g = place.g
), hit AS (
  SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT r, n, i FROM met)) GROUP BY r
), named AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM met WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (r) LEFT JOIN named USING (r)
"""
