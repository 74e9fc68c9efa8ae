"""Block-max top-k in the sparse space against a full scan."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from lodestone.operators import sparse
from lodestone.operators.sparse import SparseIndex, counted


def full_scan(points, queries, limit):
    out = set()
    for q, asked in queries.items():
        scores = Counter()
        for i, terms in points.items():
            if set(terms) & set(asked):
                scores[i] = sum(w * terms.get(t, 0) for t, w in asked.items())
        for rank, (s, i) in enumerate(sorted((-s, i) for i, s in scores.items())[:limit], 1):
            out.add((q, i, float(-s), rank))
    return out


def made(seed, n=600):
    rng = random.Random(seed)
    points = {}
    for i in range(n):
        # one term is everywhere, a third of all points are equal, others are rare; few weights are large
        points[i] = {"all": 1, "same": 2} if i % 3 == 0 else {"all": 1} | {f"t{rng.randrange(60)}": rng.choice([0, 1, 1, 2, 3, 20 if i % 50 == 1 else 1]) for _ in range(rng.randint(0, 6))}
    queries = {"a": {"all": 1}, "b": {"t1": 2, "t2": 1, "all": 1}, "c": {"same": 1, "t5": 3}, "d": {"none": 1}, "e": {f"t{k}": 1 for k in range(60)}, "f": {"t7": 0}}
    return points, queries


def rows(spark, held, key):
    kind = "string" if key == "query_id" else "int"
    return spark.createDataFrame([(i, t, float(w)) for i, v in held.items() for t, w in v.items()], f"{key} {kind}, term string, weight double")


@pytest.mark.parametrize("limit", [1, 5, 1000])
def test_equals_a_full_scan(spark, tmp_path, monkeypatch, limit):
    monkeypatch.setattr(sparse, "PAGE", 8)
    points, queries = made(3)
    held = SparseIndex(spark, f"file://{tmp_path}/s")
    held.build(rows(spark, points, "id").withColumn("page", F.lit("clash")).repartition(5))
    got = held.search(rows(spark, queries, "query_id"), limit).collect()
    assert {tuple(r) for r in got} == full_scan(points, queries, limit) and len(got) == len(set(got))
    assert held.blocks().agg(F.max(F.size("entries"))).first()[0] <= 8


def test_blocks_are_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sparse, "PAGE", 8)
    points = {i: {"word": 1 + (i % 400 == 7) * 50, "other": 1} for i in range(2000)}
    held = SparseIndex(spark, f"file://{tmp_path}/s")
    held.build(rows(spark, points, "id"))
    asked = rows(spark, {"q": {"word": 1, "other": 2}}, "query_id")
    counts = held.skipped(asked, 5).first()
    assert counts["blocks"] >= 500 and counts["read"] <= 2 * 5 * sparse.FIRST
    assert {r["key"] for r in held.search(asked, 5).collect()} == {7, 407, 807, 1207, 1607}


def test_odd_cases(spark, tmp_path):
    held = SparseIndex(spark, f"file://{tmp_path}/s")
    twice = spark.createDataFrame([(1, "a", 1.0), (1, "a", 2.0), (None, "a", 9.0), (2, None, 9.0), (3, "b", 0.0)], "id int, term string, weight double")
    held.build(twice)
    asked = spark.createDataFrame([("q", "a", 1.0), ("q", "a", 1.0), ("r", None, 1.0), ("s", "b", 1.0)], "query_id string, term string, weight double")
    assert {tuple(r) for r in held.search(asked).collect()} == {("q", 1, 6.0, 1), ("s", 3, 0.0, 1)} and held.search(asked, 0).collect() == []
    with pytest.raises(Exception, match="Wrong weight of term"):
        held.search(asked.withColumn("weight", F.lit(-1.0))).collect()
    with pytest.raises(Exception, match="Wrong weight of term"):
        SparseIndex(spark, f"file://{tmp_path}/w").build(twice.withColumn("weight", F.lit(None).cast("double")))
    empty = SparseIndex(spark, f"file://{tmp_path}/e")
    empty.build(twice.limit(0))
    assert empty.search(asked).collect() == []
    texts = spark.createDataFrame([(1, "One, one TWO"), (2, None), (3, " ")], "k int, text string")
    assert defaultdict(float, {r["term"]: r["weight"] for r in counted(texts, "k", "text").collect()}) == {"one": 2.0, "two": 1.0}
