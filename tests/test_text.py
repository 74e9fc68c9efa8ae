"""Scalar rules: Column expressions and their counterparts inside Python workers."""

import pytest
from pyspark.sql import functions as F

from lodestone.functions import splitter as W
from lodestone.functions import text as T
from lodestone.operators.plaintext import heading
from lodestone.sources.parsers import common, mail, txt

TEXTS = [
    "", " ", " x﻿", "One. Two", "No end", "a" * 201, "w " * 150, "b" * 160 + " " + "c" * 80, "x!", "3.14 is pi. Yes", "line sep. z", "\x00a\x07\t \tb\n\n\n\nc\r\n",
    "a😀b", "😀" * 100, "😀" * 101, "x" + "😀" * 150, "😀" * 76 + " " + "y" * 90, "😀" * 75 + " " + "y" * 90, "😀 " * 60 + "end.", "😀" * 99 + ".. z", "y" * 199 + "😀. " + "z" * 60, "|a|b|\n|c|d|", "a\tb\nc\td", "a  b  c\nd  e  f", "- a\n- b\nc", "1) a\n2) b", "x\n    y\n    z\n    u\n    v", "  p\n    q", "--\nJoe", "Best,\n", "On May 1 she wrote:", "> q", "From: a Sent: b To: c", "---- Original Message ----",
]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame([(k, t) for k, t in enumerate(TEXTS)], "k int, t string")


def values(rows, column):
    return [r[0] for r in rows.orderBy("k").select(column).collect()]


@pytest.mark.parametrize(
    ("column", "python"),
    [
        (T.js_trim, W.trim), (T.generate_summary, W.summary), (T.estimate_tokens, W.tokens), (T.clean_text, W.clean), (T.is_table_like, common.is_table), (T.is_code_like, common.is_code),
        (T.is_list_like, common.is_list), (T.is_signature, mail.is_signature), (T.is_quote_line, mail.is_quote), (T.block_type, txt.kind), (T.strip_html, mail.strip_html), (T.js_length, W.units),
    ],
)
def test_both_forms_agree(rows, column, python):
    assert values(rows, column("t")) == [python(t) for t in TEXTS]


def test_known_values(spark, rows):
    assert W.summary("a" * 201) == "a" * 200 + "..." and W.summary("b" * 160 + " " + "c" * 80) == "b" * 160 + "..."
    assert W.summary("components:\n\n1. First") == "components:\n\n1."
    assert W.units("a😀b") == 4 and W.tokens("x" * 1001) == 251
    one = spark.range(1)
    get = lambda c: one.select(c).first()[0]
    assert get(T.filename(F.lit("/a/b.txt"))) == "b.txt" and get(T.filename(F.lit("a/"))) == "a/"
    assert [get(T.extension(F.lit(p))) for p in ("/a.b/c", "/x/.txt", "/x/a.TXT", "/x/a.tar.gz")] == ["", "", "txt", "gz"]
    assert get(T.truncate_text(F.lit("aaaa bbbb"), 6)) == "aaaa..." and get(T.truncate_text(F.lit("abc"), 3)) == "abc"
    assert get(T.truncate_text(F.lit("😀" * 60), 101)) == "😀" * 50 + "..." and get(T.truncate_text(F.lit("😀" * 60), 120)) == "😀" * 60
    assert W.summary("x" + "😀" * 150) == "x" + "😀" * 99 + "..." and W.summary("😀" * 76 + " " + "y" * 90) == "😀" * 76 + "..."
    assert [get(T.format_size(F.lit(n))) for n in (0, 5, 1024, 1 << 20)] == ["unknown size", "5 B", "1.0 KB", "1.0 MB"] == [mail.size_text(n) for n in (0, 5, 1024, 1 << 20)]
    assert get(T.join_heading_path(F.array(F.lit("A"), F.lit(" "), F.lit("B")))) == "A > B"
    assert get(T.embedding_cost(F.lit(5432))) == "$0.71" and get(T.format_count(F.lit(1234567))) == "1,234,567"
    assert get(T.point_uuid(F.lit("a"))).count("-") == 4 and get(T.doc_id(F.lit("/a"))) == get(T.doc_id(F.lit("/a")))


@pytest.mark.parametrize(
    ("line", "above", "below", "want"),
    [
        ("INTRO PART", "", "", ("INTRO PART", 1)), ("INTRO PART", "x", "", None), ("1.1 Background", "", "x", ("1.1 Background", 1)), ("1.1. Background", "", "x", ("1.1. Background", 2)),
        ("chapter 4: On", "", "x", ("chapter 4: On", 1)), ("Key points:", "", "x", ("Key points", 2)), ("Key points:", "", "", ("Key points:", 2)), ("Short title", " ", "\t", ("Short title", 2)),
        ("Short. title", "", "", None), ("x", "", "", None), ("AB", "", "", None), ("1.2.3.4.5.6.7. deep", "", "", ("1.2.3.4.5.6.7. deep", 6)),
    ],
)
def test_headings(spark, line, above, below, want):
    assert txt.heading(line, above, below) == want
    r = spark.createDataFrame([(line, above, below)], "line string, prev string, next string").select(heading().alias("h")).first()["h"]
    assert (tuple(r) if r else None) == want


def test_splitter():
    assert W.split("") == [] and W.split(" x ") == ["x"]
    full, long = "a" * 900, "Sentence number one is here. " * 150
    # a long paragraph after a full enough piece stays whole; after a short one it goes by sentences
    assert W.split(f"{full}\n\n{long}") == [full, long.strip()]
    pieces = W.split(f"short\n\n{long}")
    assert pieces[0] == "short" and len(pieces) > 2 and all(W.tokens(p) <= 500 for p in pieces)
    assert W.by_sentence("a. b.\nc") == ["a. b. c"]
    assert W.split("b" * 4000) == ["b" * 4000]
