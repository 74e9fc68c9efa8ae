"""Findings of round 4: files of all formats are read at little cost, with the results of the libraries."""

import sys
from email import message_from_bytes
from email.message import EmailMessage
from io import BytesIO
from zipfile import ZIP_DEFLATED, BadZipFile, ZipFile

import pytest
from pyspark.sql import functions as F

from lodestone.operators.documents import chunk_files, file_outcomes
from lodestone.plans import samples
from lodestone.sources.parsers import mail, parse
from lodestone.sources.parsers.archive import Archive

ARGS = (7, "Customer#7", "BUILDING", 20)


def calls(data: bytes, kind: str) -> int:
    """Calls, of Python and of C, that reading a file takes."""
    n = 0

    def count(frame, event, arg):
        nonlocal n
        n += event in ("call", "c_call")

    parse(data, kind)  # patterns and caches are made once
    sys.setprofile(count)
    try:
        parse(data, kind)
    finally:
        sys.setprofile(None)
    return n


@pytest.mark.parametrize(("kind", "most"), [("eml", 450), ("pdf", 1000), ("html", 1800), ("docx", 750), ("xlsx", 750), ("pptx", 650)])
def test_calls_of_a_file(kind, most):
    """Before: 2,478, 1,324, 2,697, 1,062, 1,043 and 975."""
    assert calls(samples.MAKERS[kind](*ARGS), kind) <= most


def by_library(data: bytes, monkeypatch) -> tuple:
    """A mail as read when nothing of it is of the usual form."""

    def unusual(_):
        raise mail._Unusual

    with monkeypatch.context() as m:
        m.setattr(mail, "_usual", unusual)
        return mail.parse_eml(data)


def test_mails_are_as_the_library_reads_them(monkeypatch):
    """Mails of the usual form, which are read directly, and others, which are not."""
    m = EmailMessage()
    m["Subject"], m["From"], m["To"], m["Date"], m["Message-ID"] = "Two words", "Ann B <a.b@y.co.uk>", "a@b.c,d@e.f, G H <g@h.i>", "Mon, 01 Jan 2024 10:00:00 +0200", "<abc.1@x.org>"
    m.set_content("Wörld = equal " + "long " * 40 + "\n\n-- \nsig\n")
    alone = m.as_bytes()
    m.add_attachment(b"1234567", maintype="application", subtype="octet-stream", filename="a b.bin")
    m.add_attachment("some text\nmore\n", filename="t.txt")
    flat = m.as_bytes()
    folded = b'Subject: folded\n line two\nFrom: x@y.z\nContent-Type: multipart/alternative;\n\tboundary="b1"\n\npre\n--b1\nContent-Type: text/html; charset=iso-8859-1\nContent-Transfer-Encoding: quoted-printable\n\n<b>caf=E9</b><br>x=\ny\n--b1--\n'
    usual = [samples.eml(*ARGS), samples.eml_of_html(*ARGS), alone, flat, folded]
    usual += [x.replace(b"\n", b"\r\n") for x in usual]
    m = EmailMessage()
    m["Subject"], m["From"] = "Grüße", '"Doe, John" <j@x.org>'
    m.set_content("plain")
    m.add_alternative("<p>html</p>", subtype="html")
    m.add_attachment(b"1", maintype="image", subtype="png")  # holds the alternatives as a multipart
    odd = [m.as_bytes(), flat[:-10], flat.replace(b"base64", b"x-unknown"), flat.replace(b"boundary=", b"boundary*=utf-8''"), samples.eml(*ARGS).replace(b"\n--===", b"\n--=== ", 1), alone.replace(b"Mon, 01", b"Mon, 99"), b"From me\n\nx", b"", b"no header at all"]
    for data in usual:
        mail._usual(data)
        assert mail.parse_eml(data) == by_library(data, monkeypatch)
    for data in odd:
        assert mail.parse_eml(data) == by_library(data, monkeypatch)
    assert len(message_from_bytes(flat).get_payload()) == 3


def test_archives_are_as_the_library_reads_them():
    """Stored and deflated parts directly; damaged and unusual archives with the library's errors."""

    def zipped(**options) -> bytes:
        out = BytesIO()
        with ZipFile(out, "w", **options) as z:
            z.writestr("a/b.xml", "<b/>" * 9)
            z.writestr("c.xml", "ü")
        return out.getvalue()

    for data in (zipped(), zipped(compression=ZIP_DEFLATED), samples.archive({"a/b.xml": "<b/>" * 9, "c.xml": "ü"})):
        z = Archive(data)
        assert z.library is None and z.names() == ["a/b.xml", "c.xml"] and "c.xml" in z and "d" not in z
        assert [z.read(n) for n in z.names()] == [b"<b/>" * 9, "ü".encode()]
        assert [Archive(b"junk" + data).read(n) for n in z.names()] == [b"<b/>" * 9, "ü".encode()]
        at = data.index(b"a/b.xml") + 8
        broken = data[:at] + bytes([data[at] ^ 255]) + data[at + 1 :]
        with pytest.raises((BadZipFile, OSError)):
            Archive(broken).read("a/b.xml")
        with pytest.raises(BadZipFile):
            Archive(data[:-30])


def test_outcomes_of_files(spark):
    """A row for each file, with as many chunks as chunk_files makes of it, and nothing shuffled."""
    rows = [(f"/x/{k}.{kind}", kind, bytearray(b"x" if k == 3 else samples.MAKERS[kind](*ARGS)), "unread" if k == 5 else None) for kind in ("md", "html", "pdf", "eml", "docx") for k in range(6)]
    files = spark.createDataFrame(rows, "path string, doc_type string, content binary, error string").select(
        "path", F.lit("n").alias("file_name"), F.length("content").cast("long").alias("file_size"), F.lit(None).cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("modified_at"), "doc_type", "content", "error"
    )
    got = file_outcomes(files)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    want = chunk_files(files).groupBy("source_path").agg(F.count("id").alias("chunks"), F.max("error").alias("error"))
    assert sorted(tuple(r) for r in got.select("source_path", "chunks", "error").collect()) == sorted(tuple(r) for r in want.collect())


def test_routed_files_are_read_where_they_are_made(spark, tmp_path):
    """One function and the one shuffle that deals customers to tasks; outcomes as before."""
    from lodestone.plans import decoders as D

    rows = spark.createDataFrame([(k, f"Customer#{k}", "BUILDING", k % 25) for k in range(1, 31)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int")
    rows.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    got = D.routed_files(spark, str(tmp_path))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("MapInArrow"), plan.count("Exchange")) == (1, 1)
    found = {(r.source_path, r.outcome, r.chunks) for r in got.collect()}
    chunks = {"md": 2, "html": 2, "docx": 2, "xlsx": 1, "pptx": 2, "pdf": 2, "eml": 1, "msg": 1}
    want = {(f"/files/{k}.{kind}", "unsupported" if kind == "exe" else "failed" if kind == "broken.pdf" else "read", chunks.get(kind, 0)) for k in range(1, 31) for kind in D._KINDS}
    assert found == want


def test_tags_are_as_the_library_reads_them(monkeypatch):
    """Tags, comments and raw text that are read directly give the same tree as those left to the library."""
    from lodestone.sources.parsers import html

    pages = [
        samples.html(*ARGS).decode(), "a < b & c <!-- x --> <p>one paragraph<p class='x' id=y>two &amp; &copy three</P><BR/>tail of it<script>if (a<b) '</p>'</script><b>bold<i>both</b>italic",
        "<!doctype html><title>T &amp x</title><table><tr><td>1<td>2</table><h1>H</h1 ><ul><li>a<li>b</ul><!-- open <p>never closed paragraph</p>", "<p a=b/c d>text that is long enough</p><p/>x</ p>y<!>z<?q?>end of the page <", "",
    ]
    direct = [html.parse(p.encode()) for p in pages]
    monkeypatch.setattr(html.Tree, "_plainly", lambda self, page: 0)
    for name in ("parse_starttag", "parse_endtag", "updatepos"):
        monkeypatch.delattr(html.Tree, name)
    assert [html.parse(p.encode()) for p in pages] == direct
