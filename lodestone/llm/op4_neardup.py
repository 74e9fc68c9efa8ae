"""Near-duplicates by MinHash bands, odd sketches and exact sets.

A document's set is that of its shingles of `words` words (A-Z lower-cased). Documents with the
same set are one class at once: its smallest doc_id stands for it. Each class has
`BANDS * ROWS` MinHash samples. Bands of `ROWS` samples give candidates: two sets with a
Jaccard similarity of 0.8 miss all bands with a probability of 3e-6, the more similar
ones far less. Each candidate is verified by odd sketches: the least shingle of each of `BINS`
hashed bins is a MinHash sample too, and each (bin, sample) flips a bit of a bitmap. The
bits in which two sketches differ estimate how many samples do, and with the sets' sizes
how similar they are. Pairs below the threshold by more than `MISS` standard errors of
samples, bins and bits together stop there: some 3e-6 of the pairs at 0.8, three in four at 0.7
and all at 0.6, of sets of over a thousand shingles. All others are confirmed on the full sets.

Within a bucket of a band not all pairs are made:
1. each class is paired with the bucket's centre, the class that shares most buckets
   with others.
2. the classes that meet one centre, in any bucket, are its group. Where one of them is not
   yet connected to the centre, the group's classes are compared by what differs from the centre,
   through an index of their rarest differences (`same_pivot`): exact, first with one class of
   each entry of the index, then between components that this leaves apart. That
   is done with each class in the group of its greatest centre alone, then in the groups
   that are still apart with all of their classes.
Two classes of one bucket are in one group, so no link that would connect anything is left
out. Links within a component that is already connected change no result and are not made.

Hot classes meet in sums and in joins that split when skewed. A set is shipped once for
each pair to confirm, never gathered by bucket. A text of any length is one set, made in
one task and shipped whole.

Null, empty and wordless texts have no shingles: they are linked with nothing, and are
their own component. A text of fewer words than a shingle is one shingle. Rows with the same doc_id are rows of their
own with their own sets; rows with a null doc_id have the component of their class's
smallest id (null if there is none). Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm import textvec as tv
from lodestone.llm.components import components
from lodestone.llm.shared import bitmap, bucketed, dropped, is_marked, mapped, marked, written

BANDS, ROWS = 32, 5
SAMPLES = BANDS * ROWS
#: Bins of samples that are folded into a sketch, and its bits.
BINS, SKETCH_BITS = 1024, 2048
#: Standard errors by which an estimate must miss the threshold to drop a pair.
MISS = 4.5
FILTER_BITS = 25
PERCENT = 80
_A = tv.mix(np.arange(1, SAMPLES + 1, dtype=np.uint64)) | np.uint64(1)
_B = tv.mix(np.arange(1001, SAMPLES + 1001, dtype=np.uint64))


def shingle_sets(data: np.ndarray, offs: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, and where each text's begin. A
    text of fewer words is one shingle; without words it has none."""
    low = tv.LOWER[data]
    starts, ends, firsts = tv.spans(low, offs, tv.NOT_SPACE)
    h = tv.hash_spans(low, starts, ends)
    own, size = tv.owner(firsts, len(h)), np.diff(firsts)
    full = np.flatnonzero(own[: len(h) - words + 1] == own[words - 1 :]) if len(h) >= words else np.zeros(0, np.int64)
    at = [(full, words)] + [(firsts[:-1][size == k], k) for k in range(1, words)]
    code = np.concatenate([tv.window_hash(h, k)[p] for p, k in at if len(p)] or [np.zeros(0, np.uint64)])
    who = np.concatenate([own[p] for p, _ in at])
    order = np.lexsort((code, who))
    code, who = code[order], who[order]
    one = np.ones(len(code), bool)
    one[1:] = (code[1:] != code[:-1]) | (who[1:] != who[:-1])
    return code[one], np.searchsorted(who[one], np.arange(len(offs)))


def set_id(code: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each set."""
    c = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tv.mix(code ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)))
    return tv.mix(c[begin[1:]] - c[begin[:-1]] + np.diff(begin).astype(np.uint64))


def samples(code: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """The MinHash samples of each set that is not empty, one row for each sample."""
    full = begin[:-1][np.diff(begin) > 0]
    out = np.empty((SAMPLES, len(full)), np.uint32)
    for k in range(SAMPLES):
        out[k] = np.minimum.reduceat(((code * _A[k] + _B[k]) >> np.uint64(32)).astype(np.uint32), full) if len(full) else 0
    return out


def odd_sketch(code: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The parity bitmaps of the sets (64-bit words, a row for each), and how many bins of each
    have a sample."""
    n = len(begin) - 1
    who, h = tv.owner(begin, len(code)), tv.mix(code ^ np.uint64(0x0DD5))
    cell = who.astype(np.uint64) * np.uint64(BINS) + (h & np.uint64(BINS - 1))
    # a shingle's place above, the upper bits of its hash below
    low = np.uint64(max(1, (n * BINS).bit_length()))
    key = np.sort(cell << (np.uint64(64) - low) | h >> low)
    cell = (key >> (np.uint64(64) - low)).astype(np.int64)
    first = np.concatenate(([True], cell[1:] != cell[:-1]))[: len(key)]
    own, bin_ = np.divmod(cell[first], BINS)
    drawn = (key[first] << low) + bin_.astype(np.uint64)
    bit = (tv.mix(drawn) % np.uint64(SKETCH_BITS)).astype(np.int64)
    flips = np.bincount(bit + own * SKETCH_BITS, minlength=n * SKETCH_BITS) & 1
    return np.packbits(flips.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1, bitorder="little").view(np.int64), np.bincount(own, minlength=n)


SIGNED = "doc_id long, row_key long, n_shingles long, class long, bands array<long>, sketch array<long>, filled int"


def signed(docs: DataFrame, words: int) -> DataFrame:
    """SIGNED rows of all documents; class, bands and sketch are null without shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(2)):
                code, begin = shingle_sets(data, offs, words)
                n, drawn = np.diff(begin), samples(code, begin)
                band = np.zeros((BANDS, drawn.shape[1]), np.uint64)
                for k in range(SAMPLES):
                    band[k // ROWS] = tv.pair_hash(band[k // ROWS] + np.uint64(k // ROWS), drawn[k].astype(np.uint64))
                empty = n == 0
                sketch, filled = odd_sketch(code, begin)

                def lists(m: np.ndarray, empty=empty) -> pa.Array:
                    w = m.shape[1]
                    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(np.where(empty, 0, w)))).astype(np.int32)), pa.array(m.ravel()), mask=pa.array(empty))

                cls = pa.array(set_id(code, begin).view(np.int64), mask=empty)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), b.column(1).slice(i, j - i), pa.array(n), cls, lists(np.ascontiguousarray(band.T).view(np.int64)), lists(sketch[~empty]), pa.array(filled.astype(np.int32))], names=[x.split()[0] for x in SIGNED.split(", ")])

    return mapped(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_key"), "text"), run, SIGNED)


def sets_of(docs: DataFrame, wanted: np.ndarray, words: int) -> DataFrame:
    """(class, set binary) of the classes marked in a bit map, once or more each."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for _, _, data, offs in tv.text_slices(b.column(0)):
                code, begin = shingle_sets(data, offs, words)
                ids = set_id(code, begin)
                at = np.flatnonzero(marked(held.value, ids) & (np.diff(begin) > 0))
                _, first = np.unique(ids[at], return_index=True)
                at = at[first]
                yield pa.RecordBatch.from_arrays([pa.array(ids[at].view(np.int64)), pa.array([code[begin[k] : begin[k + 1]].tobytes() for k in at.tolist()], pa.binary())], names=["class", "set"])

    return mapped(docs.select("text"), run, "class long, set binary").dropDuplicates(["class"])


def estimate(a: str, b: str, bits: int = SKETCH_BITS) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(bits // 64)), F.lit(0))


def plausible(percent: int) -> Column:
    """Whether pairs may reach the similarity, from their sizes n_a, n_b, the bins filled_a,
    filled_b that have samples, and the bits `apart` in which their sketches differ.

    At that similarity s the union has (n_a + n_b) / (1 + s) shingles, and a share s of the bins
    it fills hold the same sample in both sets.
    """
    s, k = percent / 100, SKETCH_BITS
    union = (F.col("n_a") + F.col("n_b")) / (1 + s)
    load = union / BINS
    bins = BINS * (1 - F.exp(-load))
    # how the bins, the samples in them and the bits of a sketch vary
    of_bins = F.greatest(BINS * (F.exp(-load) - (1 + load) * F.exp(-2 * load)), F.lit(0.0))
    of_samples = s * (1 - s) * bins * F.greatest(1 - bins / union, F.lit(0.0))
    differ = F.greatest(F.col("filled_a") + F.col("filled_b") - 2 * s * bins, F.lit(0.0))
    kept = F.exp(-2 * differ / k)
    of_bits = F.greatest(k / 4 * (1 - kept * kept) - differ * kept * kept, F.lit(0.0))
    error = F.sqrt(kept * kept * 4 * (s * s * of_bins + of_samples) + of_bits + 1)
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    return (100 * small >= percent * large) & (F.col("apart") <= k / 2 * (1 - kept) + MISS * error)


def confirmed(pairs: DataFrame, sets: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose full sets are as similar as asked. sets: of all a, in buckets by
    class, so that they do not move to be found; centres: those of all b, which are few, as a join that can split a hot one needs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            same = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                same.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(same, pa.bool_()))

    left, right = sets.select(F.col("class").alias("a"), F.col("set").alias("set_a")), centres.select(F.col("class").alias("b"), F.col("set").alias("set_b"))
    return mapped(pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "set_a", "set_b"), run, "a long, b long")


#: Bits of a bitmap of differences.
DELTA_BITS = 256
DELTA = "class long, pivot long, of long, n long, n_pivot long, delta array<long>, bits array<long>"


def deltas(members: DataFrame, sets: DataFrame, centres: DataFrame) -> DataFrame:
    """DELTA rows of members (class, pivot, of): the shingles in which a class and its pivot differ,
    and a parity bitmap of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, y = ([np.frombuffer(v.as_buffer(), np.uint64) for v in b.column(k)] for k in (3, 4))
            d = [np.setxor1d(p, q, assume_unique=True).view(np.int64) for p, q in zip(x, y)]
            sizes = [pa.array([len(v) for v in side], pa.int64()) for side in (x, y)]
            own = np.repeat(np.arange(len(d)), [len(v) for v in d])
            bit = (tv.mix(np.concatenate([*d, np.zeros(0, np.int64)]).view(np.uint64)) % np.uint64(DELTA_BITS)).astype(np.int64)
            flips = (np.bincount(bit + own * DELTA_BITS, minlength=len(d) * DELTA_BITS) & 1).astype(np.uint8)
            bits = np.packbits(flips.reshape(len(d), DELTA_BITS), axis=1, bitorder="little").view(np.int64)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *sizes, pa.array(d, pa.list_(pa.int64())), pa.array(list(bits), pa.list_(pa.int64()))], names=["class", "pivot", "of", "n", "n_pivot", "delta", "bits"])

    own = members.join(sets, "class").join(centres.select(F.col("class").alias("pivot"), F.col("set").alias("pivot_set")), "pivot")
    return mapped(own.select("class", "pivot", "of", "set", "pivot_set"), run, DELTA)


def same_pivot(members: DataFrame, sets: DataFrame, centres: DataFrame, percent: int, made: list[DataFrame]) -> DataFrame:
    """Links (a, b) between classes of one pivot, enough to connect all components (`of`) that
    links between them connect, without pairing the classes of a pivot.

    With x and y at e_x and e_y shingles from the pivot and s of them in common, the sets
    differ in e_x + e_y - 2 s; they are linked if that is at most g (n_x + n_y). With
    h = e - g n, links without common differences need h_x + h_y <= 0 and are
    certain; then both are linked to the class of the pivot with the least h, so a star
    around it stands for them. All others have at least k = (h_x + h_y) / 2 common
    differences: of the rarest e - k + 1 differences of each, one is common. Classes meet
    on those, by bins of h, and are confirmed on their differences.

    Where classes of several components meet, all are compared with the one of least h
    first, which connects those that are alike. Only those then still apart are compared with
    each other. Parity bitmaps of differences go before both: two sets differ in at
    least as many shingles as bits. made: gets the tables that the links are read from.
    """
    g = (100 - percent) / (100 + percent)
    held = written(deltas(members, sets, centres), "deltas")
    e, width = F.size("delta"), F.col("n_pivot") * 0.06 + 1
    held_h = held.withColumn("h", e - g * F.col("n")).withColumn("bin", F.least(F.floor((F.col("h") + g * F.col("n_pivot")) / width), F.lit(11)).cast("int"))
    # sums are written before they are joined: a join splits a hot key only where both sides are exchanges
    nearest = written(held_h.groupBy("pivot").agg(F.min(F.struct("h", "class", "of")).alias("m"), F.collect_set("bin").alias("bins")), "nearest")
    stars = held_h.join(nearest, "pivot").where((F.col("h") + F.col("m.h") <= -1e-9) & (F.col("of") != F.col("m.of"))).select(F.col("class").alias("a"), F.col("m.class").alias("b"), F.col("of").alias("of_a"), F.col("m.of").alias("of_b"))
    each = held_h.select("class", "pivot", F.explode("delta").alias("part"))
    common = written(each.groupBy("pivot", "part").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "common")
    order = written(each.join(common, ["pivot", "part"]).groupBy("class", "pivot").agg(F.array_sort(F.collect_list(F.struct("n", "part"))).alias("shared")), "order")
    # the first e - k + 1 differences, without those that no other class has: the rarest
    x = held_h.join(order, ["class", "pivot"]).join(nearest.select("pivot", "bins"), "pivot").select("class", "pivot", "of", "h", "n", "n_pivot", "bits", "bin", e.alias("e"), "shared", F.explode("bins").alias("other"))
    low = F.col("other") * (F.col("n_pivot") * 0.06 + 1) - g * F.col("n_pivot")
    lone = F.col("e") - F.size("shared")
    take = F.least(F.size("shared"), F.col("e") - F.greatest(F.ceil((F.col("h") + low) / 2 - 1e-6), F.lit(1)) + 1 - lone).cast("int")
    x = x.withColumn("take", take).where("take > 0").select("class", "pivot", "of", "h", "n", "bits", "e", lone.alias("lone"), F.least("bin", "other").alias("p"), F.greatest("bin", "other").alias("q"), F.posexplode(F.slice("shared", F.lit(1), F.col("take"))).alias("place", "s"))
    # at the first common one of a pair, no more can be common than stand from there on in either
    x = x.select(F.xxhash64("pivot", "p", "q", "s.part").alias("at"), "pivot", "class", "of", "h", "n", "bits", (F.col("e") - F.col("lone") - F.col("place")).alias("rest"))
    least = F.min(F.struct("h", "class", "of", "rest", "n", "bits")).alias("c")
    hubs = written(x.groupBy("at", "pivot").agg(least, F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo < hi").select("at", "pivot", "c"), "hubs")
    # only entries where components meet, from here on, and only what may be alike with some class of its entry: none has less h than the hub
    near = F.col("rest") >= (F.col("h") + F.col("least")) / 2 - 1e-6
    meet = written(x.join(hubs.select("at", "pivot", F.col("c.h").alias("least")), ["at", "pivot"]).where(near).drop("least"), "meet")
    may = (F.least("rest_a", "rest_b") >= (F.col("h_a") + F.col("h_b")) / 2 - 1e-6) & (estimate("bits_a", "bits_b", DELTA_BITS) <= g * (F.col("n_a") + F.col("n_b")) + 1e-6)
    names = ("class", "of", "h", "rest", "n", "bits")

    def side(rows: DataFrame, v: str, of: str = "") -> DataFrame:
        return rows.select("at", "pivot", *(F.col(of + c).alias(v if c == "class" else f"{c}_{v}") for c in names))

    def alike(pairs: DataFrame) -> DataFrame:
        pairs = pairs.where(may).select("pivot", "a", "b", "of_a", "of_b").distinct()
        left, right = (held.select("pivot", F.col("class").alias(v), F.col("n").alias(f"n_{v}"), F.col("delta").alias(f"delta_{v}")) for v in "ab")
        apart = F.size("delta_a") + F.size("delta_b") - 2 * F.size(F.array_intersect("delta_a", "delta_b"))
        both = F.col("n_a") + F.col("n_b")
        return pairs.join(left, ["pivot", "a"]).join(right, ["pivot", "b"]).where(100 * (both - apart) >= percent * (both + apart)).select("a", "b", "of_a", "of_b")

    with_hub = alike(side(meet, "a").join(side(hubs, "b", "c."), ["at", "pivot"]).where("of_a <> of_b"))
    first = written(stars.unionByName(with_hub), "first")
    dropped(common, order, nearest)
    now = components(first.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))).select(F.col("node").alias("of"), "component")
    # written, as it is read twice
    again = written(meet.join(now, "of", "left").withColumn("of", F.coalesce("component", "of")).drop("component"), "again")
    dropped(meet, hubs)
    mixed = again.groupBy("at", "pivot").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo < hi").select("at", "pivot")
    still = written(again.join(mixed, ["at", "pivot"]), "still")
    dropped(again)
    made += [held, first, still]
    rest = alike(side(still, "a").join(side(still, "b"), ["at", "pivot"]).where("of_a < of_b"))
    return first.select("a", "b").unionByName(rest.select("a", "b"))


def open_groups(group: DataFrame, part: DataFrame) -> DataFrame:
    """(class, pivot, of) of the groups (class, pivot) that two components meet in, with two
    classes or more beside the pivot."""
    of_class = part.select(F.col("node").alias("class"), F.col("component").alias("of"))
    of_pivot = part.select(F.col("node").alias("pivot"), F.col("component").alias("of_pivot"))
    state = group.join(of_class, "class", "left").join(of_pivot, "pivot", "left")
    state = written(state.select("class", "pivot", F.coalesce("of", "class").alias("of"), F.coalesce("of_pivot", "pivot").alias("of_pivot")), "state")
    mixed = state.groupBy("pivot").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("of") != F.col("of_pivot")).alias("apart")).where("n > 1 and apart > 0")
    opened = written(mixed.select("pivot"), "open")
    members = written(state.join(opened, "pivot").select("class", "pivot", "of"), "members")
    dropped(state, opened)
    return members


def linked(docs: DataFrame, classes: DataFrame, percent: int, words: int) -> DataFrame:
    """(node, component) of the classes with links, from confirmed links enough to connect
    all that are linked."""
    keys = classes.select("class", F.explode("bands").alias("key"))
    full = written(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "full")
    # only buckets of two or more, from here on: most others stay where they are
    shared = is_marked(docs.sparkSession, bitmap(full, "key", FILTER_BITS))
    buckets = written(keys.where(shared("key")).join(full, "key"), "buckets")
    weight = buckets.groupBy("class").agg(F.sum("n").alias("weight"))
    centre = written(buckets.join(weight, "class").groupBy("key").agg(F.max(F.struct("weight", "class")).alias("c")), "centre")
    meets = written(buckets.join(centre, "key").select("class", "c.weight", F.col("c.class").alias("pivot")).distinct(), "meets")
    sets = bucketed(sets_of(docs, bitmap(meets, "class", FILTER_BITS), words), "sets", "class")
    centres = written(sets.join(meets.select(F.col("pivot").alias("class")).distinct(), "class", "left_semi"), "centres")
    dropped(full, buckets, centre)
    group = meets.where("class <> pivot").select("class", "pivot")
    sides = classes.select("class", "n_shingles", "filled", "sketch")
    a, b = (sides.select(F.col("class").alias(k), F.col("n_shingles").alias(f"n_{x}"), F.col("filled").alias(f"filled_{x}"), F.col("sketch").alias(f"sketch_{x}")) for k, x in (("class", "a"), ("pivot", "b")))
    stars = group.join(a, "class").join(b, "pivot").withColumn("apart", estimate("sketch_a", "sketch_b")).where(plausible(percent))
    found = written(confirmed(stars.select(F.col("class").alias("a"), F.col("pivot").alias("b")), sets, centres, percent), "links")
    part = components(found)
    # first the groups of each class's greatest centre, then what is still apart in any
    own = meets.groupBy("class").agg(F.max(F.struct("weight", "pivot")).alias("c")).select("class", "c.pivot").where("class <> pivot")
    for groups in (own, group):
        members, made = open_groups(groups, part), []
        if members.limit(1).count():
            more = written(found.unionByName(same_pivot(members, sets, centres, percent, made)), "links")
            dropped(found)
            found, part = more, components(more)
        dropped(members, *made)
    dropped(meets, sets, centres, found)
    return part


def neighbours(docs: DataFrame, percent: int = PERCENT, words: int = 2) -> DataFrame:
    """doc_id, row_key (xxhash64 of doc_id and text), n_shingles, component_id and kept of
    each document."""
    rows = written(signed(docs, words), "signed")
    one = F.min(F.struct("doc_id", "n_shingles", "bands", "sketch", "filled"))
    classes = written(rows.where("class is not null").groupBy("class").agg(one.alias("c"), F.min("doc_id").alias("least")).select("class", "least", "c.n_shingles", "c.bands", "c.sketch", "c.filled"), "classes")
    # samples and sketches of all rows are read no more
    named = written(rows.select("doc_id", "row_key", "n_shingles", "class"), "named")
    dropped(rows)
    part = linked(docs, classes, percent, words)
    of = classes.select("class", "least").join(part.withColumnRenamed("node", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
    # two steps: the smallest doc_id of each component, then of each class
    of = written(of, "of")
    smallest = written(of.groupBy("component").agg(F.min("least").alias("component_id")), "smallest")
    by_class = written(of.join(smallest, "component").select("class", "component_id"), "by_class")
    dropped(classes, of, smallest)
    judged = named.join(by_class, "class", "left").select("doc_id", "row_key", "n_shingles", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
    return judged.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")).drop("row_key")


#: The same rows in DuckDB: all pairs that share a shingle, components by recursion.
SQL = r"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]] ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM doc)
), size AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS n FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL
), link AS (
  SELECT x, y FROM common JOIN size a ON a.doc_id = x JOIN size b ON b.doc_id = y WHERE 100 * common.n >= 80 * (a.n + b.n - common.n)
), edge AS (SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (SELECT DISTINCT x AS a, x AS b FROM edge UNION SELECT reach.a, edge.y FROM reach JOIN edge ON edge.x = reach.b
), least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, coalesce(c, doc.doc_id) AS component_id, coalesce(c, doc.doc_id) = doc.doc_id AS kept
FROM doc LEFT JOIN size ON size.doc_id = doc.doc_id LEFT JOIN least ON least.a = doc.doc_id
"""
