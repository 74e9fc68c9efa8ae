"""Stages of the pipeline move only texts that they change or that have copies."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lodestone.llm import op4_neardup as op4
from lodestone.llm import op6_substrings as op6
from lodestone.llm.shared import bitmap, is_marked

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def moved(spark, run):
    """Bytes that the jobs of a call write to shuffles."""
    sc = spark.sparkContext
    sc.setJobGroup(group := f"moved{random.random()}", "")
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    sc._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    store, total = sc._jsc.sc().statusStore(), 0
    for k in {s for j in sc.statusTracker().getJobIdsForGroup(group) for s in sc.statusTracker().getJobInfo(j).stageIds}:
        total += store.lastStageAttempt(k).shuffleWriteBytes()
    return total


@pytest.fixture
def sorted_joins(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    texts = [" ".join(f"{rng.getrandbits(64):x}" for _ in range(2000)) for _ in range(60)]
    texts += [texts[0], texts[1][:800] + texts[2], "", None]
    rows = [(k, t, "en", "s", None) for k, t in enumerate(texts)]
    # repeated rows, also of a null id and of a wordless text
    rows += [rows[5], rows[62], rows[63], (None, texts[3], "en", "s", None), (None, "null id", "en", "s", None), (None, "null id", "en", "s", None)]
    return spark.createDataFrame(rows, DOCS), sum(len(r[1] or "") for r in rows)


@pytest.mark.parametrize("stage", [corpus_pipeline.drop_near_duplicates, corpus_pipeline.cut_repeated_passages])
def test_texts_that_stay_do_not_move(spark, docs, sorted_joins, stage):
    df, size = docs
    assert moved(spark, lambda: stage(spark, df, "").write.format("noop").mode("overwrite").save()) < size / 4


def test_full_maps_change_no_result(spark, docs, monkeypatch):
    df, _ = docs

    def results():
        near = sorted(map(tuple, corpus_pipeline.drop_near_duplicates(spark, df, "").collect()), key=repr)
        kept = op6.deduplicated(df).select("doc_id", "n_words", "n_removed", F.xxhash64("kept_text"))
        named = op4.neighbours(df.select("doc_id", "text"))
        return near, *(sorted(map(tuple, x.collect()), key=repr) for x in (kept, named))

    want = results()
    # the copy and the null id's copy go, as do repeated rows
    assert sorted((r[0] for r in want[0]), key=repr) == sorted([*(k for k in range(64) if k != 60), None], key=repr)
    for m in (corpus_pipeline, op4, op6):
        monkeypatch.setattr(m, "FILTER_BITS", 3)
    assert results() == want


def test_marks(spark):
    of = spark.range(-50, 50, 7).select(F.xxhash64("id").alias("k"))
    test = is_marked(spark, bitmap(of, "k", 12))
    rows = spark.range(-50, 2000).select("id", F.xxhash64("id").alias("k"))
    found = {r.id for r in rows.where(test("k")).collect()}
    assert {r.id for r in spark.range(-50, 50, 7).collect()} <= found and len(found) < 100
    assert {r.id for r in rows.where(~test("k")).collect()} == set(range(-50, 2000)) - found
