"""Hard negatives, exact deduplication and phrases, against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestone.llm import op5_warc as op5
from lodestone.llm import op8_language as op8
from lodestone.llm import op11_hard_negatives as op11
from lodestone.llm import op12_exact_dedup as op12
from lodestone.llm import op13_phrases as op13

BLANK = re.compile(r"[\x20\x09-\x0D]")


def vectors(seed, n):
    """Rows with ties, repeats, nulls, other lengths and components that are no numbers."""
    rng = random.Random(seed)
    out = [(k, rng.randrange(4), [rng.choice([-0.5, 0.1, 0.25, 0.3]) for _ in range(3)]) for k in range(n)]
    out += rng.sample(out, 20) + [out[0]] * 3
    out += [(700, None, [0.1] * 3), (800, 1, None), (900, 1, [0.1, None, 0.2]), (1000, 1, [0.1, math.nan, 0.2]), (1100, 2, [math.inf, 0.0, 0.1]), (None, 1, [0.3] * 3)]
    out += [(1200, 1, [0.5]), (1201, 1, [0.25]), (1202, 2, [0.25]), (1300, 1, []), (1301, 1, []), (1302, 3, [])]
    rng.shuffle(out)
    return out


def mined(data, anchor, positives=5, negatives=10):
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v in data if i is not None and y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = Counter()
    for k, (i, y, v) in enumerate(rows):
        if not anchor(i):
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w)), j, z) for m, (j, z, w) in enumerate(rows) if m != k and len(w) == len(v))
        for p, j, _ in [x for x in scored if x[2] == y][:positives]:
            met = [x for x in scored if x[2] != y and 30 * -p <= 100 * -x[0] <= 90 * -p][:negatives]
            for rank, (s, other, _) in enumerate(met, 1):
                out[i, j, rank, other, -p, -s] += 1
    return out


@pytest.mark.parametrize(("block_bytes", "slice_rows"), [(1 << 21, 1 << 14), (100, 7)])
def test_hard_negatives(spark, monkeypatch, block_bytes, slice_rows):
    monkeypatch.setattr(op11, "SLICE_ROWS", slice_rows)
    data = vectors(3, 150)
    rows = spark.createDataFrame(data, "vec_id long, label int, embedding array<float>").withColumns({"slot": F.lit("clash"), "score": F.lit(1), "anchor": F.lit(0)}).repartition(3)
    got = op11.mine(rows, F.col("vec_id") % 25 == 0, block_bytes=block_bytes).collect()
    data = [(i, y, None if v is None else [None if x is None else r for x, r in zip(v, f)]) for (i, y, v), f in zip(data, as_floats(data))]
    want = mined(data, lambda i: i % 25 == 0)
    assert Counter(tuple(r) for r in got) == want
    assert len(want) > 100


def as_floats(data):
    """Vectors as the table holds them: in 32 bits."""
    import numpy as np

    return [[] if v is None else [0 if x is None else float(np.float32(x)) for x in v] for _, _, v in data]


def test_hard_negatives_without_anchors(spark):
    rows = spark.createDataFrame([(1, 2, [0.5])], "vec_id long, label int, embedding array<float>")
    assert op11.mine(rows, F.col("vec_id") == 5).collect() == []
    assert op11.mine(rows.limit(0), F.col("vec_id") == 1).collect() == []
    huge = spark.createDataFrame([(1, 2, [1e30]), (2, 2, [1e30])], "vec_id long, label int, embedding array<float>")
    with pytest.raises(Exception, match="64 bits"):
        op11.mine(huge, F.col("vec_id") == 1).collect()


def copies(seed):
    rng = random.Random(seed)
    texts = [None, "", " \n\t", "a b", "ab", " a  b ", "é x", "éx", "a b", "y" * 300_000] + [" ".join(rng.choice("abcd") for _ in range(rng.randint(1, 4))) for _ in range(60)]
    data = [(k, t) for k, t in enumerate(texts)]
    return data + [data[3], data[5], data[5], (None, "ab"), (None, "alone in the world"), (None, " a b  a "), (None, " a b  a ")]


def first_of(data):
    groups = defaultdict(list)
    for i, t in data:
        groups[BLANK.sub("", t or "")].append((-len(t or ""), i is None, i if i is not None else 0))
    return {k: (min(v), len(v)) for k, v in groups.items()}


def judgement(data):
    held = first_of(data)
    out = Counter()
    for i, t in data:
        norm = BLANK.sub("", t or "")
        (_, unnamed, keep), size = held[norm]
        out[i, None if unnamed else keep, size, hashlib.sha256(norm.encode()).hexdigest()] += 1
    return out


@pytest.mark.parametrize("key_bytes", [32, 1, 0])
def test_exact_dedup(spark, tmp_path, key_bytes):
    """Right with a whole digest, and with one that many contents share, as bytes are compared."""
    data = copies(5)
    rows = spark.createDataFrame(data, "doc_id long, text string").withColumns({"key": F.lit(1), "mark": F.lit("x"), "first": F.lit(2), "norm": F.lit(3)})
    rows.repartition(5).write.parquet(f"file://{tmp_path}/docs")
    got = op12.deduplicated(spark, f"file://{tmp_path}/docs", key_bytes, maxFilesPerTrigger=2).collect()
    assert Counter((r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in got) == judgement(data)
    kept = Counter(r["text_sha256"] for r in got if r["kept"])
    assert set(kept.values()) == {1} and len(kept) == len(first_of(data))
    assert all(r["doc_id"] == r["keep_id"] for r in got if r["kept"])


def test_exact_dedup_goes_on_from_its_state(spark, tmp_path):
    """What arrives later is judged against all that was seen, by another query on the same state."""
    where, docs = f"file://{tmp_path}/state", f"file://{tmp_path}/docs"
    spark.createDataFrame([(7, "a b"), (8, "c")], "doc_id long, text string").write.parquet(docs)
    assert [r["kept"] for r in op12.deduplicated(spark, docs, checkpoint=where).collect()] == [True, True]
    spark.createDataFrame([(1, "ab"), (2, " a b"), (3, "d")], "doc_id long, text string").write.mode("append").parquet(docs)
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in op12.deduplicated(spark, docs, checkpoint=where).collect()}
    assert got == {7: (2, 3, False), 1: (2, 3, False), 2: (2, 3, True), 8: (8, 1, True), 3: (3, 1, True)}
    state = op12.seen(spark, where)
    assert state.count() == 3 and state.agg(F.sum("group_size")).first()[0] == 5
    assert all(k not in spark.conf.getAll or spark.conf.get(k) != v for k, v in op12.STATE_CONF.items())


def test_exact_dedup_of_nothing(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"file://{tmp_path}/docs")
    assert op12.deduplicated(spark, f"file://{tmp_path}/docs").collect() == []


def phrase_docs(seed):
    rng = random.Random(seed)
    vocab = ["The", "cat", "sat", "on", "é", "mat-1", "x"]
    fixed = ["red red red red red red", "a b c d e f g", "cat sat on", "the cat"]
    out = [(None, "en"), ("", None), (" \t ", "en"), ("...;;\n", "de"), ("a b " * 20_000, "long")]
    for _ in range(400):
        words = []
        for _ in range(rng.randint(0, 12)):
            words.append(rng.choice(fixed) if rng.random() < 0.2 else rng.choice(vocab))
            words.append(rng.choice([" ", " ", " ", "\t ", ". ", ",", "\n", " ! "]))
        out.append(("".join(words), rng.choice(["en", "en", "de", None])))
    return out + out[7:20]


def collocated(data, least, hidden, top):
    count, total = defaultdict(Counter), Counter()
    for text, lang in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for m in range(1, 6):
                for i in range(len(w) - m + 1):
                    count[lang][tuple(w[i : i + m])] += 1
    out = []
    for lang, f in count.items():
        kept = []
        held = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in held.items():
            inside = any(len(q) > len(p) and 100 * b >= hidden * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in held.items())
            if not inside:
                score, k = min((1000 * a * total[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                kept.append((-score, -a, " ".join(p).encode(), a, f[p[:k]], f[p[k:]]))
        for rank, (s, _, p, a, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, p.decode(), a, left, right, total[lang], -s))
    return sorted(out)


def low(t):
    return (t or "").encode().lower().decode()


@pytest.mark.parametrize(("held", "range_rows", "hidden", "top"), [(1 << 20, 1 << 20, 100, 2000), (50, 20, 80, 7)])
def test_phrases(spark, monkeypatch, held, range_rows, hidden, top):
    monkeypatch.setattr(op13, "RANGE_ROWS", range_rows)
    data = phrase_docs(4)
    docs = spark.createDataFrame(data, "text string, lang string").withColumns({"id": F.lit("clash"), "n": F.lit(1), "w1": F.lit(2), "word": F.lit(3)}).repartition(4)
    got = op13.collocations(docs, 12, hidden, top).collect()
    want = collocated(data, 12, hidden, top)
    assert sorted(tuple(r) for r in got) == want
    assert len(want) > (30 if top > 7 else 20) and {r[0] for r in want} >= {"en", "de", "und", "long"}
    assert any(len(r[2].split()) == 5 for r in want)


def test_growth_is_whole_over_ranges():
    """Sums over ranges of pointers, wherever they are cut, are the counts of all phrases."""
    import numpy as np

    rng = random.Random(2)
    rows = sorted(tuple(rng.choice([1, 2, 3]) if k < (m := rng.randint(2, 5)) else 0 for k in range(5)) for _ in range(300))
    rows = [tuple(x if 0 not in r[:k] else 0 for k, x in enumerate(r)) for r in rows]
    rows = sorted(r for r in rows if r[1])
    want = Counter()
    for r in rows:
        for m in range(2, 6):
            if r[m - 1]:
                want[r[:m] + (0,) * (5 - m)] += 1
    for cuts in ([], [7], [50, 51, 120]):
        got = Counter()
        for a, z in zip([0, *cuts], [*cuts, len(rows)]):
            part = np.array(rows[a:z], np.int64).reshape(-1, 5).T
            out, n = op13.grown(part, np.ones(z - a, np.int64), 6)
            for r, c in zip(out.T.tolist(), n.tolist()):
                got[tuple(r)] += c
        assert {r: c for r, c in got.items() if c >= 6} == {r: c for r, c in want.items() if c >= 6}


def test_phrases_of_nothing(spark):
    assert op13.collocations(spark.createDataFrame([], "text string, lang string")).collect() == []
    assert op13.collocations(spark.createDataFrame([("a b", "en"), (None, None)], "text string, lang string"), 2).collect() == []


def warc(k, size=3000):
    return op5.record([("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:{k}>")], bytes([97 + k % 26]) * size)


def blocks_in(data):
    return [r if isinstance(r, ValueError) else r[1] for r in op5.records_in(data)]


@pytest.mark.parametrize("form", ["plain", "each", "whole"])
def test_warc_files_are_read_in_one_pass(form):
    """Time grows with the file, not its square, and blocks of any size stay whole over the parts that are read."""
    import gzip
    import time

    rng = random.Random(4)
    sizes = [rng.choice([0, 1, 10, 3000, op5.STEP - 1, op5.STEP * 2 + 7]) for _ in range(40)]
    made = [warc(k, n) for k, n in enumerate(sizes)]
    pack = {"plain": b"".join, "each": lambda x: b"".join(gzip.compress(r, 1) for r in x), "whole": lambda x: gzip.compress(b"".join(x), 1)}[form]
    assert blocks_in(pack(made)) == [bytes([97 + k % 26]) * n for k, n in enumerate(sizes)]
    took = []
    for n in (4000, 16000):
        data = pack([warc(k) for k in range(n)])
        began = time.process_time()
        assert sum(1 for _ in op5.records_in(data)) == n
        took.append(time.process_time() - began)
    assert took[1] < 10 * took[0] + 1


def test_warc_reading_goes_on_after_what_is_broken():
    lf = b"WARC/1.0\nContent-Length: 2\n\nok\n\n"
    data = warc(0, 3) + b"WARC/1.0\r\nContent-Length: x\r\n\r\nabc\r\n\r\n" + warc(1, 3) + b"junk\r\n\r\n" + lf + b"WARC/1.0\r\n\r\n" + warc(2, 3) + b"end"
    assert [str(x) if isinstance(x, ValueError) else x for x in blocks_in(data)] == [b"aaa", "content-length is x", b"bbb", "no WARC version line", b"ok", "no content-length", b"ccc", "no WARC version line"]
    import gzip

    packed = gzip.compress(warc(0, 3)) + gzip.compress(warc(1, 50_000))
    got = blocks_in(packed[:-20])
    assert got[0] == b"aaa" and [str(x) for x in got[1:]] == ["a gzip member is cut off"]


def test_language_learns_rare_n_grams_too(spark):
    """What makes up the least share of a small table counts, once seen or more often."""
    docs = spark.createDataFrame([(0, "xq", "a"), (1, "vw", "b"), (4, None, "a"), (5, "zz", None)], "doc_id long, text string, lang string")
    told = op8.identified(docs.select("doc_id", "text"), op8.fitted(docs, F.lit(True))).collect()
    assert {r["doc_id"]: r["lang_pred"] for r in told if r["doc_id"] < 4} == {0: "a", 1: "b"}
    none = docs.limit(0)
    assert op8.identified(none, op8.fitted(none, F.lit(True))).collect() == []
    assert {r["lang_pred"] for r in op8.identified(docs, op8.fitted(none, F.lit(True))).collect()} == {"und"}
