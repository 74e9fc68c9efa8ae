"""The approximate index of vectors against an exact search."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.operators.vectors import VectorIndex, lloyd

KIND = "id string, full_vector array<float>"


def clustered(n, dimensions=24, groups=30, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dimensions))
    return [(f"p{k}", (centres[k % groups] + 0.25 * rng.normal(size=dimensions)).astype(float).tolist()) for k in range(n)]


def pairs(df):
    return {(r["query_id"], r["key"]) for r in df.collect()}


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    data = clustered(3000)
    data += [(f"same{k}", data[0][1]) for k in range(1000)]  # a quarter of all vectors are equal
    odd = [("null", None), ("short", [1.0]), ("hole", [None] * 24), ("nan", [math.nan] * 24), ("zero", [0.0] * 24), (None, data[1][1])]
    held = VectorIndex(spark, f"file://{tmp_path_factory.mktemp('ix')}/v", 24)
    rows = spark.createDataFrame(data + odd, KIND)
    held.build(rows.withColumn("cell", F.lit("clash")), parts=6)
    return held, data


def test_recall_and_cells_read(spark, built):
    held, data = built
    queries = spark.createDataFrame([(i, v) for i, v in data[5:3000:31]], "query_id string, vector array<float>")
    exact, near = held.search(queries, 10, exact=True), held.search(queries, 10)
    assert pairs(exact) == brute(data, data[5:3000:31], 10)
    found = len(pairs(exact) & pairs(near)) / len(pairs(exact))
    s = held.settings()
    assert found >= 0.95 and s["probes"] < s["cells"] / 4 and held.read().count() == len(data)
    scores = {(r["query_id"], r["key"]): (round(r["score"], 6), r["rank"]) for r in exact.collect()}
    assert all(scores[r["query_id"], r["key"]][0] == round(r["score"], 6) for r in near.collect() if (r["query_id"], r["key"]) in scores)
    # all cells, and as many compared as there are: the exact result
    assert pairs(held.search(queries.limit(5), 10, probes=s["cells"], rerank=400)) == pairs(held.search(queries.limit(5), 10, exact=True))
    plan = held.read([0, 1])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(cell" in plan or "PartitionFilters: [cell" in plan
    some = held.read([0, 1])
    assert some.select("cell").distinct().count() == 2 and some.count() < held.read().count()


def brute(data, asked, limit):
    unit = lambda v: np.array(v, np.float32).astype(float) / np.linalg.norm(np.array(v, np.float32).astype(float))
    m = np.array([unit(v) for _, v in data])
    out = set()
    for i, v in asked:
        s = m @ unit(v)
        out |= {(i, k) for _, k in sorted((-round(x, 9), k) for x, (k, _) in zip(s, data))[:limit]}
    return out


def test_equal_vectors_share_a_cell_not_a_task(spark, built):
    held, _ = built
    cells = held.read().where("key like 'same%'").select("cell").distinct().collect()
    assert len(cells) == 1


def test_vectors_added_later(spark, built):
    held, data = built
    held.add(spark.createDataFrame([("late", [x * 3 for x in data[7][1]])], KIND))
    top = held.search(spark.createDataFrame([(1, data[7][1])], "query_id int, vector array<float>"), 2).orderBy("rank").collect()
    assert {r["key"] for r in top} == {"late", data[7][0]} and [r["rank"] for r in top] == [1, 2]


def test_odd_queries_and_nothing(spark, tmp_path, built):
    held, _ = built
    with pytest.raises(ValueError, match="Wrong vector size: 1"):
        held.search(spark.createDataFrame([(2, [1.0])], "query_id int, vector array<float>"))
    odd = spark.createDataFrame([(1, None), (3, [None] * 24), (4, [0.0] * 24)], "query_id int, vector array<float>")
    assert held.search(odd).collect() == [] and held.search(odd, 0).collect() == []
    empty = VectorIndex(spark, f"file://{tmp_path}/e", 3)
    empty.build(spark.createDataFrame([], KIND))
    assert empty.read().count() == 0 and empty.search(spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "query_id int, vector array<float>")).collect() == []


def test_centres_settle():
    rng = random.Random(1)
    m = np.array([[rng.choice([0, 5, 9]) + rng.random() / 10, 0.0] for _ in range(200)])
    assert sorted(np.round(lloyd(m, 3)[:, 0]).tolist()) == [0, 5, 9]
    assert len(lloyd(np.zeros((4, 2)), 9)) == 4
