"""Removal of repeated passages by compressed FM-indexes, one for each shard.

A window is `WINDOW` consecutive words of a document. Its anchor is the least of its
`ANCHOR`-word runs in an order that equal windows share, so equal windows have equal
anchors; up to `MAX_WINDOWS` windows of one anchor that follow each other make a segment, and an anchor's
segments go to one shard. There an FM-index (fm_index.py) of the shard's segments is
searched backward with each of them: matching statistics of `WINDOW` words report the
interval of a window, and the interval's smallest document id decides.

Passes over the documents:
1. anchors of all documents, with the words of their segments. Anchors of two documents or
   more are shared; those of over `HEAVY_WORDS` words in all are heavy.
2. where there are heavy ones: all runs of the segments under heavy anchors. Those that would
   be heavy as anchors are late, as are the heavy anchors themselves. A window whose anchor
   is heavy takes the least of its runs that are not late, and leaves for that run's shard. So
   what meets under one anchor is at most about twice HEAVY_WORDS, whatever share of the
   corpus it stands in.
3. segments with shared anchors go to their shards. Windows of late runs only stand inside
   hot passages; their anchors are the least runs of `LATE_ANCHOR` words, and the segments
   that they make repeat: they are sent once a task, united by a sum over their content,
   and indexed once, with their smallest document.
4. where there are late runs: the places of late segments take the verdict of their segment,
   by a join that splits when skewed.
5. each document takes its windows' verdicts. Only texts that may have one move.

Four bit maps of 2**`FILTER_BITS` bits, of shared, heavy and late runs and of rows with verdicts, are all about the
corpus that is broadcast. Fuller maps let more segments through, make more runs late or move more texts, and
change no result.

Words are compared by 64-bit hashes. Null, empty and short texts have no windows: nothing
is removed. Rows with a null doc_id neither remove nor lose words. Rows with the same id
do not remove from each other; rows equal in id and text share their verdict, which is
held once. Ties do not arise: of equal windows those of the smallest doc_id stay. A text of
any length is worked on whole, by its task alone; its segments are as short as others. An empty table gives an empty
result; other columns stay, and n_words, n_removed and kept_text replace columns of those names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.fm_index import FMIndex
from lodestone.llm.shared import bitmap, dropped, grouped, is_marked, mapped, marked, written

WINDOW, ANCHOR, LATE_ANCHOR = 50, 10, 25
FILTER_BITS = 26
#: Words of the segments under one anchor, from which on it is heavy; eight bytes stand for each.
HEAVY_WORDS = 1 << 16
#: Most windows of a segment.
MAX_WINDOWS = 512
#: Words of a shard's segments on average.
SHARD_WORDS = 1 << 18
#: Bytes of late segments that a task holds back to send each once.
ONCE_BYTES = 8 << 20
_LAST = np.uint64(1 << 63)
_NEVER = np.iinfo(np.int64).max
# columns of its own, beside any that the documents have
_KEY, _LOST = "_lodestone_key", "_lodestone_lost"


def least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each `width` consecutive entries."""
    n = 1
    while n * 2 <= width:
        x = np.minimum(x[:-n], x[n:])
        n *= 2
    return np.minimum(x[: len(x) - (width - n)], x[width - n :]) if width > n else x


class Windows:
    """The windows of a slice of texts: where they start, whose they are, their anchors,
    and the segments they make. hot: the bit maps of heavy and of late runs, or none."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, hot: tuple[np.ndarray, np.ndarray] | None, width: int, anchor: int):
        starts, ends, self.firsts = tv.spans(data, offs, tv.NOT_SPACE)
        self.words = tv.hash_spans(data, starts, ends)
        n = len(self.words)
        if n < width:
            self.at = self.who = self.begin = self.end = np.zeros(0, np.int64)
            self.anchor = self.runs = np.zeros(0, np.uint64)
            return
        own = tv.owner(self.firsts, n)
        self.runs = runs = tv.window_hash(self.words, anchor) >> np.uint64(1)
        self.at = np.flatnonzero(own[: n - width + 1] == own[width - 1 :])
        self.who = own[self.at]
        a = least(runs, width - anchor + 1)[self.at]
        if hot is not None and len(move := np.flatnonzero(marked(hot[0], a))):
            a[move] = least(np.where(marked(hot[1], runs), runs | _LAST, runs), width - anchor + 1)[self.at[move]]
            long, last = min(LATE_ANCHOR, width), move[a[move] >= _LAST]
            a[last] = least(tv.window_hash(self.words, long), width - long + 1)[self.at[last]] | _LAST
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (self.who[1:] != self.who[:-1]) | (self.at[1:] != self.at[:-1] + 1)
        begin = np.flatnonzero(new)
        # a periodic text has one anchor throughout: its segments are cut, and then equal
        pieces = -(-np.diff(np.append(begin, len(a))) // MAX_WINDOWS)
        self.begin = np.repeat(begin, pieces) + MAX_WINDOWS * (np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces))
        self.end = np.append(self.begin[1:], len(a))
        self.anchor = a[self.begin]


def _summed(who: np.ndarray, ids: np.ndarray, size: np.ndarray) -> pa.RecordBatch:
    """Rows (run, a, z, n) of runs with their documents and sizes: one for each run."""
    run, back = np.unique(who, return_inverse=True)
    a, z = np.full(len(run), _NEVER), np.full(len(run), -_NEVER - 1)
    np.minimum.at(a, back, ids)
    np.maximum.at(z, back, ids)
    n = np.bincount(back, size, minlength=len(run)).astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(run.view(np.int64)), pa.array(a), pa.array(z), pa.array(n)], names=["run", "a", "z", "n"])


def _counts(docs: DataFrame, width: int, anchor: int, heavy=None) -> DataFrame:
    """(run, a, z, n) of the anchors: the smallest and the greatest id of their documents and
    the words of their segments. With a bit map of heavy ones, of all runs of the segments
    under those: n is then the words of the segments that they could stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy(zero_copy_only=False)
            for i, j, data, offs in tv.text_slices(b.column(1)):
                w = Windows(data, offs, None, width, anchor)
                if not len(w.begin):
                    continue
                begin, end, own = w.at[w.begin], w.at[w.end - 1] + width, ids[i:j][w.who[w.begin]]
                if heavy is None:
                    yield _summed(w.anchor, own, end - begin)
                    continue
                inside = np.flatnonzero(marked(heavy.value, w.anchor))
                runs = end[inside] - begin[inside] - anchor + 1
                at = np.repeat(begin[inside], runs) + np.arange(int(runs.sum())) - np.repeat(np.cumsum(runs) - runs, runs)
                # segments overlap: a place counts once
                at, one = np.unique(at, return_index=True)
                yield _summed(w.runs[at], np.repeat(own[inside], runs)[one], np.full(len(at), 2 * width - anchor))

    rows = mapped(docs.where("doc_id is not null").select("doc_id", "text"), run, "run long, a long, z long, n long")
    return rows.groupBy("run").agg(F.min("a").alias("a"), F.max("z").alias("z"), F.sum("n").alias("n")).where("a < z")


SEGMENT = "shard int, segment long, row_key long, doc_id long, start int, words binary"


def _segments(docs: DataFrame, shared, hot, shards: int, width: int, anchor: int, places: bool) -> DataFrame:
    """Segments to index: those with shared anchors, and late ones (row_key and start null), once
    a task with their smallest document. With `places`: the places of the late ones, without words."""

    def rows(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out)) if out else [()] * 6
        types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in SEGMENT.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, maps = shared.value, None if hot is None else hot.value
        once: dict[int, list] = {}
        held = 0
        for b in batches:
            ids, keys = b.column(0).to_numpy(zero_copy_only=False), b.column(1).to_numpy(zero_copy_only=False)
            for i, j, data, offs in tv.text_slices(b.column(2)):
                w = Windows(data, offs, maps, width, anchor)
                if not len(w.begin):
                    continue
                is_late = w.anchor >= _LAST
                take = is_late if places else is_late | marked(marks, w.anchor)
                begin, end = w.at[w.begin], w.at[w.end - 1] + width
                who = w.who[w.begin]
                shard = (tv.mix(w.anchor) % np.uint64(shards)).astype(np.int64)
                out = []
                for s in np.flatnonzero(take).tolist():
                    a, z, d = int(begin[s]), int(end[s]), int(who[s])
                    doc, key, start = int(ids[i + d]), int(keys[i + d]), a - int(w.firsts[d])
                    words = w.words[a:z].tobytes()
                    if not is_late[s]:
                        out.append((int(shard[s]), None, key, doc, start, words))
                        continue
                    segment = int.from_bytes(hashlib.blake2b(words, digest_size=8).digest(), "little", signed=True)
                    if places:
                        out.append((int(shard[s]), segment, key, doc, start, None))
                    elif (old := once.get(segment)) is None:
                        once[segment] = (int(shard[s]), segment, None, doc, None, words)
                        held += len(words) + 200
                    elif doc < old[3]:
                        once[segment] = (*old[:3], doc, *old[4:])
                if held > ONCE_BYTES:
                    out += once.values()
                    once.clear()
                    held = 0
                yield rows(out)
        yield rows(list(once.values()))

    return mapped(docs.where("doc_id is not null").select("doc_id", "row_key", "text"), run, SEGMENT)


VERDICT = "segment long, row_key long, doc_id long, start int, size int, gone binary"


def _verdicts(segments: DataFrame, width: int) -> DataFrame:
    """For each indexed segment, which of its windows a smaller document holds; late ones
    (segment is not null) always give a row, others where there is such a window."""

    def run(table: pa.Table) -> pa.Table:
        col = table.column("words").combine_chunks()
        sizes = np.diff(np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)) // 8
        at = np.frombuffer(col.buffers()[1], np.int32)[col.offset]
        firsts = np.concatenate(([0], np.cumsum(sizes)))
        words = np.frombuffer(col.buffers()[2], np.uint8)[at : at + int(firsts[-1]) * 8].view(np.uint64)
        docs = table.column("doc_id").to_numpy()
        # equal segments are indexed once
        name = np.array([hash(words[a:z].tobytes()) for a, z in zip(firsts[:-1].tolist(), firsts[1:].tolist())], np.int64)
        _, first, same = np.unique(name, return_index=True, return_inverse=True)
        smallest = np.full(len(first), _NEVER)
        np.minimum.at(smallest, same, docs)
        text = np.concatenate([words[firsts[k] : firsts[k + 1]] for k in first.tolist()])
        own = np.concatenate(([0], np.cumsum(sizes[first])))
        found = FMIndex(text, own, smallest, width).matches(text, own, _NEVER)
        late = np.array(table.column("segment").is_valid())
        out, gone = [], []
        for k, s in enumerate(same.tolist()):
            bits = found[own[s] : own[s + 1] - width + 1] < docs[k]
            if late[k] or bits.any():
                out.append(k)
                gone.append(np.packbits(bits, bitorder="little").tobytes() if bits.any() else b"")
        kept = table.select(["segment", "row_key", "doc_id", "start"]).take(pa.array(out, pa.int64()))
        return kept.append_column("size", pa.array((sizes[out] - width + 1).astype(np.int32))).append_column("gone", pa.array(gone, pa.binary()))

    return grouped(segments.groupBy("shard"), run, VERDICT)


def hits(plain: DataFrame, width: int, anchor: int) -> DataFrame:
    """(row_key, start, size, gone) for rows (doc_id, row_key, text): runs of windows, and bits for
    those of them that a smaller document holds; no bits where all are."""
    spark = plain.sparkSession
    anchors = written(_counts(plain, width, anchor), "anchors")
    total, most = anchors.agg(F.sum("n"), F.max("n")).first()
    shared, hot = bitmap(anchors, "run", FILTER_BITS), None
    if (most or 0) > HEAVY_WORDS:
        heavy = bitmap(anchors.where(F.col("n") > HEAVY_WORDS), "run", FILTER_BITS)
        runs = written(_counts(plain, width, anchor, spark.sparkContext.broadcast(heavy)), "runs")
        late = heavy | bitmap(runs.where(F.col("n") > HEAVY_WORDS), "run", FILTER_BITS)
        shared |= bitmap(runs, "run", FILTER_BITS)
        hot = spark.sparkContext.broadcast((heavy, late))
        dropped(runs)
    dropped(anchors)
    held = spark.sparkContext.broadcast(shared)
    shards = max(8, -(-(total or 0) // SHARD_WORDS))
    index = _segments(plain, held, hot, shards, width, anchor, False)
    if hot is None:
        return _verdicts(index.repartition(shards, "shard"), width).select("row_key", "start", "size", "gone")
    index = written(index, "segments")
    once = index.where("segment is not null").groupBy("shard", "segment").agg(F.min("doc_id").alias("doc_id"), F.first("words").alias("words"))
    rows = index.where("segment is null").unionByName(once, allowMissingColumns=True)
    found = written(_verdicts(rows.repartition(shards, "shard"), width), "substrings")
    dropped(index)
    places = _segments(plain, held, hot, shards, width, anchor, True)
    places = places.select("segment", "row_key", "start", F.col("doc_id").alias("own_id"))
    verdict = found.where("segment is not null").select("segment", "doc_id", "size", "gone")
    # a document above the smallest loses all windows of the segment: null stands for that
    met = places.join(verdict, "segment").where("own_id > doc_id or length(gone) > 0")
    met = met.select("row_key", "start", "size", F.when(F.col("own_id") > F.col("doc_id"), F.lit(None)).otherwise(F.col("gone")).alias("gone"))
    return found.where("segment is null").select("row_key", "start", "size", "gone").unionByName(met)


def deduplicated(docs: DataFrame, width: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """The documents with n_words, n_removed and kept_text (kept words joined by one space)."""
    docs = docs.drop("n_words", "n_removed", "kept_text")
    keyed = docs.withColumn(_KEY, F.xxhash64("doc_id", "text"))
    plain = keyed.select("doc_id", F.col(_KEY).alias("row_key"), "text")
    # written, as it is read twice
    found = written(hits(plain, width, anchor), "hits")
    # rows equal in id and text have the same hits: a set holds them once
    lost = found.groupBy(F.col("row_key").alias(_KEY)).agg(F.collect_set(F.struct("start", "size", "gone")).alias(_LOST))
    hit = bitmap(found, "row_key", FILTER_BITS)
    held = docs.sparkSession.sparkContext.broadcast(hit)
    names = [*docs.columns, "n_words", "n_removed", "kept_text"]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), "n_words long, n_removed long, kept_text string"])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(at)):
                starts, ends, firsts = tv.spans(data, offs, tv.NOT_SPACE)
                spans = b.column(b.num_columns - 1).slice(i, j - i)
                gone = np.zeros(len(starts), bool)
                for d in np.flatnonzero(spans.is_valid()).tolist():
                    x, z = int(firsts[d]), int(firsts[d + 1])
                    lost = [h["start"] + (np.arange(h["size"]) if h["gone"] is None else np.flatnonzero(np.unpackbits(np.frombuffer(h["gone"], np.uint8), count=h["size"], bitorder="little"))) for h in spans[d].as_py()]
                    p = np.concatenate(lost)
                    gone[x:z] = tv.covered(z - x, p, p + width)
                size, removed = np.diff(firsts), tv.per_text(gone, firsts)
                # kept words joined by one blank: each word with a blank behind, the last of a text without
                k = np.flatnonzero(~gone)
                length = ends[k] - starts[k] + 1
                to = np.cumsum(length)
                out = np.full(int(to[-1]) if len(k) else 0, 32, np.uint8)
                out[np.arange(len(out)) != np.repeat(to - 1, length)] = data[tv.inside(starts[k], ends[k])]
                cut = np.concatenate(([0], to))[np.searchsorted(k, firsts)]
                texts = [out[x : max(x, z - 1)].tobytes().decode() for x, z in zip(cut[:-1].tolist(), cut[1:].tolist())]
                cols = [*(c.slice(i, j - i) for c in b.columns[:-1]), pa.array(size), pa.array(removed), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    def run_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """As run, for rows with their keys, of those that lose nothing."""
        for b in batches:
            stay = b.filter(pa.array(~marked(held.value, b.column(b.num_columns - 1).to_numpy())))
            yield from run(iter([pa.RecordBatch.from_arrays([*stay.columns[:-1], pa.nulls(stay.num_rows)], names=[*names[:-3], _LOST])]))

    # one Python function in each stage, as an executor keeps a worker for each that a task runs: what is joined moves first
    moved = keyed.where(is_marked(docs.sparkSession, hit)(_KEY)).join(lost.hint("merge"), _KEY, "left")
    return mapped(moved.select(*docs.columns, _LOST), run, schema).unionByName(mapped(keyed.select(*docs.columns, _KEY), run_whole, schema))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return deduplicated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


#: The same rows in DuckDB: all windows as lists of words, grouped.
SQL = r"""
WITH doc AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), win AS (
  SELECT r, doc_id, i, array_to_string(w[i:i + 49], ' ') AS g FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc WHERE len(w) >= 50)
), least AS (SELECT g, min(doc_id) AS d FROM win GROUP BY g HAVING count(DISTINCT doc_id) > 1
), gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS k FROM win JOIN least USING (g) WHERE win.doc_id > least.d
), lost AS (SELECT r, list(k) AS ks, count(*) AS n FROM gone GROUP BY r
), kept AS (
  SELECT r, string_agg(x, ' ' ORDER BY k) AS t FROM (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM doc) LEFT JOIN gone USING (r, k) WHERE gone.k IS NULL GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM doc LEFT JOIN lost USING (r) LEFT JOIN kept USING (r)
"""
