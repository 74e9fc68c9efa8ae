"""Language-model scores by a hierarchical Pitman-Yor model of word pairs.

Every word is served in the restaurant of the word before it (a text begins after an
end); the tables of all those restaurants are the customers of one parent, the
restaurant of single words, whose dishes come evenly from the known words and one class
of unknown ones. With c customers and t tables of a pair (u, w), C and T of u:

    P(w | u) = (c - d t) / (theta + C) + (theta + d T) / (theta + C) * P(w)
    P(w) = (t_w - d0) / (theta0 + t) + (theta0 + d0 V) / (theta0 + t) / (V + 1)

t_w counts the tables of w in all restaurants. Seatings are sampled by Gibbs (crp.py); P(w | u)
is the mean of the predictive probabilities of the samples. The root is not sampled: every dish has one table there, d0 and theta0 are fixed. d is n1 / (n1 + 2 n2) of
each shard's pairs. Each shard samples with a parent of its own dishes, so seatings and d
shift a little with the number of shards (the README has figures). perplexity is
10 ** (-score / n_tokens).

How it is dealt out. A block is up to `BLOCK_BYTES` of texts of one input partition.
1. Blocks send their distinct pairs, with training counts, to the shards of the first
   word. A shard seats its restaurants, with a parent of its own for the sampling, and
   answers each block's pairs in their order; its tables go to the shards of the
   second word. Restaurants of words that would fill more than a quarter of a shard (by a
   bounded sample) are dealt over many shards. A block asks those that have its pairs; the
   totals of such restaurants, one row a word, are summed and broadcast.
2. Blocks send their distinct words; the shards of words count customers and tables.
3. Each block, packed, meets its answers and scores its texts.
A block sends a row to each shard that has contexts of its own: as many as there are shards,
and never more than it has distinct words. Nothing that grows with the corpus is collected or
broadcast: the frequent words are those of the sample, SAMPLE_WORDS at the most.

Words are 64-bit hashes; within a restaurant 40 bits tell dishes apart. Texts with a null
doc_id are scored, not learned from. Null and empty texts are one end. A text of any length is
one block at the most, of its own; it is not cut. Repeated rows count
each time. Other columns are ignored. Without training texts all scores are 0, the only
class being the unknown one; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.crp import seat
from lodestone.llm.shared import dropped, grouped, mapped, partitions, written

BLOCK_BYTES = 4 << 20
THETA, THETA0, DISCOUNT0 = 1.0, 1.0, 0.5
BURN, DRAWS = 3, 3
#: Documents that tell which words are frequent, how often one must stand in them, and the most words.
SAMPLE, SAMPLE_LEAST, SAMPLE_WORDS = 20_000, 20, 500_000
END = tv.mix(np.array([0x454E44], np.uint64))[0]
LOW = np.uint64((1 << 40) - 1)
_KINDS = "kind int, dest long, shard int, a binary, b binary, c binary, e binary, d double"


def pack5(x: np.ndarray) -> bytes:
    """The low 40 bits of each value."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def unpack5(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(raw, np.uint8).reshape(-1, 5)
    return out.view(np.uint64).ravel()


def pack(x: np.ndarray) -> bytes:
    """Numbers in as few bytes each as the greatest needs, which the first byte tells."""
    size = np.min_scalar_type(int(x.max(initial=0))).itemsize
    return bytes([size]) + x.astype(f"<u{size}").tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


class Block:
    """The tokens of some texts, with their distinct words and, if asked for, pairs."""

    def __init__(self, data: np.ndarray, offs: np.ndarray, ids: list[int | None], pairs: bool = True):
        low = tv.LOWER[data]
        starts, ends, firsts = tv.spans(low, offs, tv.NOT_SPACE)
        n = len(offs) - 1
        size = np.diff(firsts) + 1
        self.first = np.concatenate(([0], np.cumsum(size)))
        token = np.full(int(self.first[-1]), END, np.uint64)
        own = tv.owner(firsts, len(starts))
        token[np.arange(len(starts)) + own] = tv.hash_spans(low, starts, ends)
        rest = np.array([-1 if x is None else zlib.crc32(str(x).encode()) % 10 for x in ids], np.int64)
        self.held_out, train = rest == 0, rest > 0
        self.word, code = np.unique(token, return_inverse=True)
        end = int(np.searchsorted(self.word, END))
        learn = np.repeat(train, size)
        self.count = np.bincount(code[learn], minlength=len(self.word))
        self.code = code
        if not pairs:
            return
        before = np.empty(len(code), np.int64)
        before[1:] = code[:-1]
        before[self.first[:-1]] = end
        if n:
            pair, self.pair_of = np.unique(before * len(self.word) + code, return_inverse=True)
        else:
            pair, self.pair_of = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.left, self.right = np.divmod(pair, max(len(self.word), 1))
        self.pair_count = np.bincount(self.pair_of[learn], minlength=len(pair))

    def asked(self, hot: dict[str, np.ndarray], shards: int) -> tuple[np.ndarray, ...]:
        """Places where restaurants are: (shard, word code) sorted; over how many parts each is
        dealt, how many pairs each place has, and the pairs in that order. A hot word has one
        place for each part that has pairs."""
        parts = np.ones(len(self.word), np.int64)
        if len(hot["word"]):
            k = np.minimum(np.searchsorted(hot["word"], self.word), len(hot["word"]) - 1)
            parts = np.where(hot["word"][k] == self.word, hot["parts"][k], 1)
        own = ((tv.mix(self.word[self.right]) >> np.uint64(20)) % parts[self.left].astype(np.uint64)).astype(np.int64)
        most = int(parts.max(initial=1))
        place, of = np.unique(self.left * most + own, return_inverse=True)
        word, part = np.divmod(place, most)
        shard = (tv.mix(self.word[word] + part.astype(np.uint64)) % np.uint64(shards)).astype(np.int64)
        order = np.lexsort((part, word, shard))
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        of = back[of]
        pairs = np.argsort(of, kind="stable")
        shard, word = shard[order], word[order]
        return shard, word, parts[word], np.bincount(of, minlength=len(word)), pairs


def blocks(b: pa.RecordBatch) -> Iterator[tuple[int, int, Block]]:
    for i, j, data, offs in tv.text_slices(b.column(1), BLOCK_BYTES):
        yield i, j, Block(data, offs, b.column(0).slice(i, j - i).to_pylist(), False)


def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch, int, int]]:
    """(block number, batch, first, end): the same for each scan of the same table."""
    k, held, size = TaskContext.get().partitionId() << 32, [], 0

    def cut() -> Iterator[tuple[int, pa.RecordBatch, int, int]]:
        nonlocal k
        b = pa.concat_batches(held)
        for i, j in tv.slices(tv.column_bytes(b.column(1))[1], BLOCK_BYTES):
            yield k, b, i, j
            k += 1

    for b in batches:
        held.append(b)
        size += b.nbytes
        if size >= BLOCK_BYTES:
            yield from cut()
            held, size = [], 0
    if held:
        yield from cut()


def rows(out: list[tuple]) -> pa.RecordBatch:
    types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.binary(), pa.float64())
    cols = list(zip(*out)) if out else [()] * 8
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=[x.split()[0] for x in _KINDS.split(", ")])


def runs(x: np.ndarray) -> Iterator[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    cut = np.flatnonzero(np.diff(x)) + 1
    yield from zip([0, *cut.tolist()] if len(x) else [], [*cut.tolist(), len(x)])


def block_of(b: pa.RecordBatch, i: int, j: int, pairs: bool) -> Block:
    data, offs = tv.column_bytes(b.column(1).slice(i, j - i))
    return Block(data, offs, b.column(0).slice(i, j - i).to_pylist(), pairs)


def frequent(docs: DataFrame, shards: int) -> dict[str, np.ndarray]:
    """Words with more than a quarter of a shard's share of the tokens, by a bounded sample of
    documents, and over how many shards each one's restaurant is dealt."""
    n = docs.count()
    sample = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) < min(1.0, SAMPLE / max(n, 1)) * 1_000_003)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, b in blocks(batch):
                yield pa.RecordBatch.from_arrays([pa.array(b.word.view(np.int64)), pa.array(np.bincount(b.code, minlength=len(b.word)))], names=["word", "n"])

    seen = mapped(sample.select("doc_id", "text"), run, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    seen = written(seen, "frequent")
    total = seen.agg(F.sum("n")).first()[0] or 0
    often = seen.where((F.col("n") >= SAMPLE_LEAST) & (4 * shards * F.col("n") > total))
    top = sorted((w % (1 << 64), n / total) for w, n in often.orderBy(F.desc("n"), "word").limit(SAMPLE_WORDS).collect())
    dropped(seen)
    return {"word": np.array([w for w, _ in top], np.uint64), "parts": np.array([max(1, math.ceil(4 * s * shards)) for _, s in top], np.int64)}


def pair_keys(docs: DataFrame, hot, shards: int) -> DataFrame:
    """A row for each block and shard: contexts, pairs of each, second words, training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch, i, j in numbered(batches):
            b = block_of(batch, i, j, True)
            shard, word, parts, sizes, pairs = b.asked(hot.value, shards)
            at = np.concatenate(([0], np.cumsum(sizes)))
            out = []
            for x, y in runs(shard):
                p = pairs[at[x] : at[y]]
                out.append((0, k, int(shard[x]), pack5(b.word[word[x:y]]), pack(np.concatenate((sizes[x:y], parts[x:y]))), pack5(b.word[b.right[p]]), pack(b.pair_count[p]), None))
            yield rows(out)

    return mapped(docs.select("doc_id", "text"), run, _KINDS)


def seated(keys: DataFrame, hot, word_shards: int, burn: int, draws: int) -> DataFrame:
    """Answers to the blocks (kind 0: customers and tables of contexts and pairs), tables for the
    shards of second words (kind 1), and customers, and tables times discount, of contexts that
    are dealt out (kind 5). Tables are those of each draw, one draw after the other."""

    def run(table: pa.Table) -> pa.Table:
        r = table.to_pydict()
        ctx = [unpack5(x) for x in r["a"]]
        size = [unpack(x).reshape(2, -1) for x in r["b"]]
        right = [unpack5(x) for x in r["c"]]
        count = np.concatenate([unpack(x) for x in r["e"]])
        all_ctx = np.concatenate(ctx)
        number, parts = np.concatenate(size, axis=1)
        context, code = np.unique(all_ctx, return_inverse=True)
        copies = np.ones(len(context))
        copies[code] = parts
        u = np.repeat(code, number)
        dish, w = np.unique(np.concatenate(right), return_inverse=True)
        pair, of = np.unique(u * max(len(dish), 1) + w, return_inverse=True)
        c = np.bincount(of, count, minlength=len(pair)).astype(np.int64)
        real = np.flatnonzero(c)
        pu, pw = np.divmod(pair[real], max(len(dish), 1))
        n1, n2 = (c == 1).sum(), (c == 2).sum()
        d = min(0.95, max(0.3, float(n1 / (n1 + 2 * n2)) if n1 else 0.5))
        tables = np.zeros((max(1, draws), len(pair)), np.int64)
        if len(real):
            _, du = np.unique(pu, return_inverse=True)
            _, dw = np.unique(pw, return_inverse=True)
            part = np.ones(du.max() + 1)
            part[du] = copies[pu]
            tables[:, real] = seat(du, dw, c[real], d, THETA, part, burn, draws, int(r["shard"][0]))
        of_ctx = np.stack([np.bincount(pu, x[real], minlength=len(context)) for x in (c, *tables)]).astype(np.int64)
        out, x, y = [], 0, 0
        for block, shard, ids, right_ in zip(r["dest"], r["shard"], ctx, right):
            at, p = code[x : x + len(ids)], of[y : y + len(right_)]
            out.append((0, block, shard, pack(of_ctx[0, at]), pack(of_ctx[1:, at]), pack(c[p]), pack(tables[:, p]), d))
            x, y = x + len(ids), y + len(right_)
        t = np.stack([np.bincount(pw, x[real], minlength=len(dish)) for x in tables]).astype(np.int64)
        some = np.flatnonzero(t[0])
        dest = (tv.mix(dish[some]) % np.uint64(word_shards)).astype(np.int64)
        order = np.argsort(dest, kind="stable")
        some, dest = some[order], dest[order]
        for x, y in runs(dest):
            out.append((1, int(dest[x]), r["shard"][0], pack5(dish[some[x:y]]), pack(t[:, some[x:y]]), None, None, None))
        if len(wide := np.flatnonzero(copies > 1)):
            out.append((5, -1, r["shard"][0], pack5(context[wide]), pack(of_ctx[0, wide]), (d * of_ctx[1:, wide]).tobytes(), None, None))
        return pa.Table.from_batches([rows(out)])

    return grouped(keys.repartition(word_shards, "shard").groupBy("shard"), run, _KINDS)


def of_frequent(answers: DataFrame, draws: int) -> dict[str, np.ndarray]:
    """Customers, and tables times discounts of each draw, of the contexts that are dealt out:
    sums over their parts, a bounded number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for word, c, t in zip(*(x.to_pylist() for x in b.columns)):
                word = unpack5(word)
                t = np.frombuffer(t).reshape(-1, len(word)).T
                yield pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(unpack(c)), pa.array(t.tolist(), pa.list_(pa.float64()))], names=["word", "c", "t"])

    each = mapped(answers.where("kind = 5").select("a", "b", "c"), run, "word long, c long, t array<double>")
    sums = [F.sum(F.get("t", F.lit(k))) for k in range(draws)]
    held = sorted(each.groupBy("word").agg(F.sum("c"), *sums).collect())
    return {"word": np.array([r[0] for r in held], np.uint64), "c": np.array([r[1] for r in held], float), "t": np.array([r[2:] for r in held], float).reshape(len(held), draws).T}


def word_keys(docs: DataFrame, word_shards: int) -> DataFrame:
    """A row for each block and shard of words: the block's words and training counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for k, batch, i, j in numbered(batches):
            b = block_of(batch, i, j, False)
            order, dest = word_order(b, word_shards)
            yield rows([(2, int(dest[x]), 0, b.word[order[x:y]].tobytes(), pack(b.count[order[x:y]]), k.to_bytes(8, "little"), None, None) for x, y in runs(dest)])

    return mapped(docs.select("doc_id", "text"), run, _KINDS)


def word_order(b: Block, word_shards: int) -> tuple[np.ndarray, np.ndarray]:
    dest = (tv.mix(b.word & LOW) % np.uint64(word_shards)).astype(np.int64)
    order = np.argsort(dest, kind="stable")
    return order, dest[order]


def counted(keys: DataFrame, tables: DataFrame, word_shards: int, draws: int) -> DataFrame:
    """Answers to the blocks (kind 2: customers and tables of words) and each shard's
    totals (kind 3: tokens, words, tables); tables are those of each draw."""

    def run(table: pa.Table) -> pa.Table:
        r = table.to_pydict()
        ask = [k for k, x in enumerate(r["kind"]) if x == 2]
        word = [np.frombuffer(r["a"][k], np.uint64) for k in ask]
        count = [unpack(r["b"][k]) for k in ask]
        all_, code = np.unique(np.concatenate([*word, np.zeros(0, np.uint64)]), return_inverse=True)
        c = np.bincount(code, np.concatenate([*count, np.zeros(0)]), minlength=len(all_)).astype(np.int64)
        given = [k for k, x in enumerate(r["kind"]) if x == 1]
        short, back = np.unique(all_ & LOW, return_inverse=True)
        t = np.zeros((draws, len(short)), np.int64)
        for k in given:
            w = unpack5(r["a"][k])
            at = np.minimum(np.searchsorted(short, w), max(len(short) - 1, 0))
            ok = short[at] == w if len(short) else np.zeros(len(w), bool)
            t[:, at[ok]] += unpack(r["b"][k]).reshape(draws, -1)[:, ok]
        known = c > 0
        # words that share 40 bits share their tables; each one's part goes by its customers
        of_short = np.bincount(back, c, minlength=len(short))
        t = np.round(t[:, back] * (c / np.maximum(of_short[back], 1))).astype(np.int64)
        s = r["dest"][0]
        out = [(3, -1, s, int(c.sum()).to_bytes(8, "little"), int(known.sum()).to_bytes(8, "little"), t.sum(axis=1).tobytes(), None, None)]
        x = 0
        for k, w in zip(ask, word):
            at = code[x : x + len(w)]
            x += len(w)
            out.append((2, int.from_bytes(r["c"][k], "little"), s, pack(c[at]), pack(t[:, at]), None, None, None))
        return pa.Table.from_batches([rows(out)])

    return grouped(keys.unionByName(tables).repartition(word_shards, "dest").groupBy("dest"), run, _KINDS)


def packed(docs: DataFrame) -> DataFrame:
    """The blocks themselves (kind 4): compressed texts, sizes and ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for k, b, i, j in numbered(batches):
            data, offs = tv.column_bytes(b.column(1).slice(i, j - i))
            ids = b.column(0).slice(i, j - i)
            none = np.packbits(np.array(ids.is_null()).astype(bool)).tobytes()
            yield rows([(4, k, 0, press.compress(data.tobytes()), offs.tobytes(), ids.fill_null(0).to_numpy().tobytes(), none, None)])

    return mapped(docs.select("doc_id", "text"), run, _KINDS)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def scored(docs: DataFrame, burn: int = BURN, draws: int = DRAWS) -> DataFrame:
    """SCORES of every row of docs (doc_id, text)."""
    shards = partitions(docs, "text", BLOCK_BYTES)
    context = docs.sparkSession.sparkContext
    hot = context.broadcast(frequent(docs, shards))
    n_draws = max(1, draws)
    answers = written(seated(pair_keys(docs, hot, shards), hot, shards, burn, draws), "seated")
    wide = context.broadcast(of_frequent(answers, n_draws))
    words = written(counted(word_keys(docs, shards), answers.where("kind = 1"), shards, n_draws), "counted")
    n_all, v_all, t_all = 0, 0, np.zeros(n_draws)
    for a, b, c in words.where("kind = 3").select("a", "b", "c").toLocalIterator():  # a row for each shard
        n_all, v_all, t_all = n_all + int.from_bytes(a, "little"), v_all + int.from_bytes(b, "little"), t_all + np.frombuffer(c, np.int64)

    def run(table: pa.Table) -> pa.Table:
        r = table.to_pydict()
        kinds = {k: sorted((s, x) for x, (kind, s) in enumerate(zip(r["kind"], r["shard"])) if kind == k) for k in (0, 2, 4)}
        x = kinds[4][0][1]
        offs = np.frombuffer(r["b"][x], np.int64)
        raw = zstandard.ZstdDecompressor().decompress(r["a"][x], max_output_size=int(offs[-1]) + 1)
        none = np.unpackbits(np.frombuffer(r["e"][x], np.uint8), count=len(offs) - 1)
        ids = [None if z else i for i, z in zip(np.frombuffer(r["c"][x], np.int64).tolist(), none.tolist())]
        b = Block(np.frombuffer(raw, np.uint8), offs, ids)
        gather = lambda col, kind, rows_: np.concatenate([unpack(r[col][x]).reshape(rows_, -1) for _, x in kinds[kind]], axis=1).astype(float)
        order, _ = word_order(b, shards)
        c, t = np.zeros(len(b.word)), np.zeros((n_draws, len(b.word)))
        c[order], t[:, order] = gather("a", 2, 1)[0], gather("b", 2, n_draws)
        base = np.log10((c + 0.1) / (n_all + 0.1 * (v_all + 1)))
        shard, word, parts, sizes, pairs = b.asked(hot.value, shards)
        d_of = dict(zip((s for s, _ in kinds[0]), (r["d"][x] for _, x in kinds[0])))
        d_place = np.array([d_of[s] for s in shard.tolist()])
        # a context's customers, and its tables times its discount; of one that is dealt out, the sums
        held, alone = wide.value, parts == 1
        cu, dt = np.zeros(len(b.word)), np.zeros((n_draws, len(b.word)))
        cu[word[alone]], dt[:, word[alone]] = gather("a", 0, 1)[0, alone], d_place[alone] * gather("b", 0, n_draws)[:, alone]
        if not alone.all():
            k = np.searchsorted(held["word"], b.word[word[~alone]] & LOW)
            cu[word[~alone]], dt[:, word[~alone]] = held["c"][k], held["t"][:, k]
        customers, tables = gather("c", 0, 1)[0], gather("e", 0, n_draws)
        d_pair = np.repeat(d_place, sizes)
        p = np.zeros(len(pairs))
        for j in range(n_draws):  # the mean of the predictive probabilities of the samples
            single = np.maximum(t[j] - DISCOUNT0, 0) * (c > 0) / (THETA0 + t_all[j]) + (THETA0 + DISCOUNT0 * v_all) / (THETA0 + t_all[j]) / (v_all + 1)
            own = np.zeros(len(pairs))
            own[pairs] = np.maximum(customers - d_pair * tables[j], 0)
            p += (own + (THETA + dt[j, b.left]) * single[b.right]) / (THETA + cu[b.left]) / n_draws
        log = np.log10(p)
        sums = lambda v: np.add.reduceat(v, b.first[:-1])
        score, size = sums(log[b.pair_of]), np.diff(b.first)
        cols = [pa.array(ids, pa.int64()), pa.array(b.held_out), pa.array(size), pa.array(sums((c > 0)[b.code].astype(np.int64))), pa.array(np.full(len(ids), n_all)), pa.array(sums(base[b.code])), pa.array(score), pa.array(10 ** (-score / size))]
        return pa.table(cols, names=[x.split()[0] for x in SCORES.split(", ")])

    both = packed(docs).unionByName(answers.where("kind = 0")).unionByName(words.where("kind = 2"))
    return grouped(both.repartition(shards, "dest").groupBy("dest"), run, SCORES)


def op1_hpylm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
