"""Work of the queries that grew too fast: plans and costs of the steps they share."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import splitter as W
from lodestone.functions import text as T
from lodestone.operators import plaintext as P


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().sparkPlan().toString()


def shuffles(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_lines_move_nothing_and_blocks_move_once(spark):
    docs = spark.createDataFrame([(1, "A TITLE\n\nbody\nmore\n\nnext"), (2, ""), (3, None)], "doc_id long, text string")
    assert shuffles(P.lines(docs)) == 0
    assert shuffles(P.blocks(docs)) == 1
    got = sorted(tuple(r) for r in P.lines(docs).where("doc_id = 1 and pos in (0, 3, 5) or doc_id > 1").collect())
    assert got == [(1, 0, "A TITLE", "", ""), (1, 3, "more", "body", ""), (1, 5, "next", "", ""), (2, 0, "", "", ""), (3, 0, "", "", "")]
    blocks = sorted(tuple(r) for r in P.blocks(docs).select("doc_id", "pos", "type", "content", "level").collect())
    assert blocks == [(1, 0, "heading", "A TITLE", 1), (1, 1, "paragraph", "body\nmore", None), (1, 2, "paragraph", "next", None)]


def test_splitting_measures_each_part_once(spark):
    """A step of the fold does not look again at what is held."""
    docs = spark.createDataFrame([("x",)], "text string")
    assert "regexp_replace" not in plan(docs.select(W.split_text("text"))).lower()


@pytest.mark.parametrize("text", ["", " ", "a", "é ", "﻿x 😀 ", "😀" * 3, "​ y", "\x85z\x85", "\x1cq\x1c"])
def test_rules_by_bytes(spark, text):
    row = spark.createDataFrame([(text,)], "t string").select(T.js_trim("t"), T.js_length("t"), T.blank("t"), F.regexp_replace("t", rf"^[{T.WS}]+|[{T.WS}]+\z", "")).first()
    assert row[0] == row[3] == W.trim(text)
    assert (row[1], row[2]) == (W.units(text), W.trim(text) == "")


def test_long_texts_of_wide_characters(spark):
    texts = [("Ä wort 😀 ist da. " * 300 + "\n\n") * 2 + "kurz.", "x" * 9000, ("a. " * 700 + "\n\n" + "b! " * 20 + "\n\n") * 4]
    got = [r[0] for r in spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").orderBy("k").select(W.split_text("t")).collect()]
    assert got == [W.split(t) for t in texts]


def test_customers_are_dealt_to_tasks(spark, tmp_path):
    """A table that is read as one part is decoded by more tasks the larger it is, and no row is lost."""
    from lodestone.plans import decoders as D

    def rows(n: int) -> str:
        d = str(tmp_path / str(n))
        spark.range(n).selectExpr("id as c_custkey", "'n' as c_name", "'S' as c_mktsegment", "cast(id % 25 as int) as c_nationkey").coalesce(1).write.parquet(f"{d}/customer.parquet")
        return d

    small, large = rows(10), rows(9_000)
    tasks = [D.blocks(spark, d, "md").rdd.getNumPartitions() for d in (small, large)]
    assert tasks == [1, 5]
    got = D.md_blocks(spark, large).groupBy("doc_id").count()
    assert (got.count(), got.where(f"count <> {len(D.MD)}").count()) == (9_000, 0)
    assert D.md_blocks(spark, rows(0)).count() == 0
    plan_ = D.routed_files(spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert plan_.count("Relation") == 1  # all kinds are made in one pass over the table


def test_mail_headers_are_parsed_once(spark):
    """Each header of a message is parsed once, whatever is asked of it, and the results are those of the package."""
    from email import message_from_bytes, policy

    from lodestone.plans.samples import eml
    from lodestone.sources.parsers import mail

    calls = mail._POLICY.header_factory
    data = eml(123456, "Name", "S", 3)
    before = calls.cache_info().misses
    mail.parse_eml(data)
    assert calls.cache_info().misses - before <= 13  # lines of headers in the message
    want = message_from_bytes(data, policy=policy.default)
    got = message_from_bytes(data, policy=mail._POLICY)
    assert [(k, str(v), type(v).__mro__[1:]) for k, v in got.items()] == [(k, str(v), type(v).__mro__[1:]) for k, v in want.items()]


def test_sample_messages_are_those_of_the_mail_package():
    import re
    from email.message import EmailMessage

    from lodestone.plans.samples import eml, eml_of_html

    def edge(b: bytes) -> bytes:
        return re.sub(rb"={15}\d+==", b"EDGE", b)

    for key, nation in ((1, 0), (1_234_567, 24)):
        m = EmailMessage()
        m["Subject"], m["From"], m["To"], m["Cc"], m["Date"] = "About N", f"S <c{key}@x.org>", f"a@b.c, Bo <n{nation}@b.c>", "c@d.e", f"Tue, 02 Jan 2024 15:{nation:02d}:05 +0000"
        m.set_content(f"Hello N\n\nRegards,\nS\n\nOn Monday he wrote:\n> old {key}\n> text\n")
        m.add_attachment(b"x" * (512 * nation), maintype="application", subtype="pdf", filename=f"f{key}.pdf")
        assert edge(eml(key, "N", "S", nation)) == edge(m.as_bytes())
        h = EmailMessage()
        h.set_content(f"<style>x</style><p>A &amp; S</p><p>C<br>{key}</p>", subtype="html")
        assert eml_of_html(key, "N", "S", nation) == h.as_bytes()


def test_texts_move_and_words_do_not(spark):
    """Words are counted where their text lies, and the shuffle comes before they are made."""
    from lodestone.operators.sparse import counted

    docs = spark.createDataFrame([(1, "A b a"), (2, "b"), (1, "b, c"), (3, None), (4, " ")], "id long, text string")
    df = counted(docs, "id", "text")
    executed = df._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1
    assert executed.index("Generate") < executed.index("Exchange")  # the plan is printed from its end
    assert sorted(tuple(r) for r in df.collect()) == [(1, "a", 2.0), (1, "b", 2.0), (1, "c", 1.0), (2, "b", 1.0)]
