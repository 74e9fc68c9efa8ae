"""Sections, files, index, search, streaming and programs end to end."""

import json
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestone.config import Config
from lodestone.functions import splitter
from lodestone.functions import text as T
from lodestone.operators import embed, index, search, sections
from lodestone.operators.documents import chunk_files, chunks
from lodestone.plans import cli
from lodestone.sources.files import find_documents, read_directory, read_files
from lodestone.sources.sinks import chunk_dict, json_array, write_json_array, write_json_lines

BLOCKS = "doc_id string, pos int, type string, content string, level int, is_table boolean, is_code boolean, page_number int, slide_number int, sheet_name string, metadata map<string,string>"


def random_blocks(rng, doc):
    out = []
    for pos in range(rng.randint(0, 14)):
        kind = rng.choice(["heading", "paragraph", "paragraph", "table", "code"])
        long = "Words of a sentence. " * rng.choice([1, 3, 60, 260])
        text = rng.choice(["", "T", "Head"]) if kind == "heading" else rng.choice(["", long, "a  b\n\n\n\nc", "par\n\n" + long])
        out.append((doc, pos, kind, text, rng.randint(1, 6) if kind == "heading" else None, kind == "table", kind == "code", rng.choice([None, pos]), None, rng.choice([None, "S"]), rng.choice([None, {"k": str(pos)}, {"m": "x", "k": "y"}])))
    return out


def test_relational_and_fused_chunks_agree(spark):
    rng = random.Random(6)
    docs = {f"d{k}": random_blocks(rng, f"d{k}") for k in range(40)}
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    frame = spark.createDataFrame([b for rows in docs.values() for b in rows], BLOCKS).repartition(5)
    keys = spark.createDataFrame([(d, "txt", f"/{d}", {"f": "1", "k": "doc"}) for d in docs], "doc_id string, doc_type string, source_path string, doc_metadata map<string,string>")
    got = {r["id"]: r.asDict() for r in sections.chunk_blocks(frame, keys).collect()}
    want = {}
    for d, rows in docs.items():
        for c in chunks([dict(zip(names, r)) for r in rows], d, "txt", f"/{d}", {"f": "1", "k": "doc"}):
            want[c["id"]] = c
    assert set(got) == set(want) and len(want) > 60
    for k, c in want.items():
        for field in ("chunk_index", "full_text", "summary_text", "title_text", "heading_path", "section_title", "is_table", "is_code", "page_number", "sheet_name"):
            assert got[k][field] == c.get(field), (k, field)
        assert got[k]["metadata"] == {n: v if isinstance(v, str) else json.dumps(v) for n, v in c["metadata"].items()}


@pytest.fixture
def tree(tmp_path):
    files = {
        "a.txt": "HEAD\n\nBody text.\n", "_b.MD": "# M\n\ntext", ".c.html": "<p>hello there</p>", "d.htm": "<p>x</p>", "e.pdf": "no pdf", "sub/f.txt": "", "node_modules/g.txt": "x", ".hid/h.txt": "x", "sub/i.exe": "x",
    }
    for name, text in files.items():
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_text(text)
    os.symlink(tmp_path / "a.txt", tmp_path / "link.txt")
    return tmp_path


def test_files(spark, tree):
    assert [os.path.relpath(p, tree) for p in find_documents(str(tree))] == [".c.html", "_b.MD", "a.txt", "e.pdf", "sub/f.txt"]
    assert find_documents(str(tree / "nowhere")) == []
    got = {os.path.relpath(r["source_path"], tree): r for r in chunk_files(read_directory(spark, str(tree))).collect()}
    assert got["a.txt"]["full_text"] == "HEAD\n\nBody text." and got["a.txt"]["metadata"]["fileName"] == "a.txt" and got["a.txt"]["metadata"]["fileSize"] == "17"
    assert got["sub/f.txt"]["full_text"] == "[Empty document]" and got["sub/f.txt"]["metadata"]["isEmpty"] == "true"
    assert "not a PDF" in got["e.pdf"]["error"] and got["e.pdf"]["id"] is None
    store = {os.path.basename(r["path"]): r["doc_type"] for r in read_directory(spark, f"file://{tree}").collect()}
    assert store == {"a.txt": "txt", "e.pdf": "pdf", "link.txt": "txt"}
    given = {os.path.basename(r["path"]): r for r in read_files(spark, [str(tree / n) for n in ("d.htm", "none.txt", "sub", "sub/i.exe")]).collect()}
    assert given["d.htm"]["doc_type"] == "html" and given["none.txt"]["error"].startswith("File not found") and given["sub"]["error"].startswith("Not a file") and "extension: .exe" in given["i.exe"]["error"]


def test_cli(spark, tree, tmp_path, capsys):
    out = tmp_path / "o.json"
    assert cli.main(["chunk", str(tree / "a.txt"), str(tree / "none.txt"), "-o", str(out), "-p"]) == 1
    held = json.loads(out.read_text())
    assert [c["fullText"] for c in held] == ["HEAD\n\nBody text."] and "pageNumber" not in held[0] and held[0]["sectionTitle"] == "HEAD"
    assert "1/2 files" in capsys.readouterr().err
    assert cli.main(["chunk", str(tree / "a.txt"), "-q"]) == 0
    assert [c["chunkIndex"] for c in json.loads(capsys.readouterr().out)] == [0]
    assert cli.main(["chunk", *(str(tree / n) for n in ("sub/f.txt", ".c.html", "a.txt", "sub/f.txt")), "-o", str(out)]) == 0
    assert [os.path.basename(c["sourcePath"]) for c in json.loads(out.read_text())] == ["f.txt", ".c.html", "a.txt", "f.txt"] and "4/4 files, 4 chunks, 0 errors" in capsys.readouterr().err
    config = Config(index_dir=str(tmp_path / "index"), collection="c", dimensions=32)
    counts = cli.process(spark, str(tree), config)
    assert (counts["files"], counts["failed"], counts["chunks"], counts["points"]) == (5, 1, 4, 4) and counts["cost"].startswith("$")
    again = cli.process(spark, str(tree), config)
    assert again["points"] == 4
    held = index.Collection(spark, config.index_dir, "c", 32)
    top = search.display(search.search(held.read(), "body text", embed.HashingProvider(32), limit="2")).collect()
    assert top[0]["file"] == "a.txt" and top[0]["type"] == "TXT"
    by_words = search.text_search_postings(held.postings(), held.read(), "Body TEXT", 5).collect()
    assert [r["source_path"].endswith("a.txt") for r in by_words] == [True]
    with pytest.raises(ValueError):
        held.reset()
    held.reset(force=True)
    assert held.count() == 0 and held.exists() and not held.create()
    assert index.Collection(spark, config.index_dir, "nothing").count() == 0


def test_index_errors(spark, tmp_path):
    c = spark.createDataFrame([("a::0",)], "id string")
    e = spark.createDataFrame([("b::0", [1.0], [1.0])], "chunk_id string, full_vector array<float>, summary_vector array<float>")
    with pytest.raises(Exception, match="Missing embedding for chunk: a::0"):
        index.embedded(c, e).collect()
    assert [r[0] for r in index.missing_embeddings(c, e).collect()] == ["a::0"]


def test_providers():
    calls = []

    class Limited:
        dimensions = 2

        def embed(self, texts):
            calls.append(list(texts))
            if len(calls) < 3:
                raise embed.RateLimited
            return np.ones((len(texts), 2), np.float32)

    waits = []
    assert embed.with_retry(lambda: Limited().embed(["x"]), 3, 1.0, waits.append).shape == (1, 2) and waits == [1.0, 2.0]
    calls.clear()
    with pytest.raises(embed.RateLimited):
        embed.with_retry(lambda: Limited().embed(["x"]), 2, 1.0, waits.append)
    calls[:] = [[], [], []]
    assert embed.embed_texts(Limited(), ["a", "", "b"], "full text", 2).shape == (3, 2) and calls[3:] == [["a", " "], ["b"]]

    class Broken:
        dimensions = 2

        def embed(self, texts):
            raise KeyError("x")

    with pytest.raises(RuntimeError, match="Failed to embed summary batch 1"):
        embed.embed_texts(Broken(), ["a"], "summary")
    v = embed.HashingProvider(16).embed(["a b", "a b", "", "c"])
    assert np.allclose(v[0], v[1]) and np.allclose(np.linalg.norm(v, axis=1), 1)
    assert embed.batches(5, 2) == [(0, 2), (2, 4), (4, 5)]


def test_search(spark):
    rows = [(f"p{k}", [x, y], t) for k, (x, y, t) in enumerate([(1.0, 0.0, "red apple"), (1.0, 0.0, "green"), (0.6, 0.8, "Apple RED"), (0.0, 1.0, "red, apple?"), (-1.0, 0.0, "apple")])]
    p = spark.createDataFrame(rows, "id string, full_vector array<float>, text string")
    assert [r["id"] for r in search.vector_search(p, [2.0, 0.0], 3).collect()] == ["p0", "p1", "p2"]
    t = search.text_search(p, "red apple", 2).collect()
    assert [(r["id"], r["score"]) for r in t] == [("p0", 1.0), ("p2", 0.5)]
    assert search.text_search(p, "?!", 2).collect() == [] and search.text_search(p, "blue", 2).collect() == []
    h = search.hybrid_search(p, "red apple", [0.0, 1.0], 5)
    got = [(r["id"], r["vector_rank"], r["text_rank"]) for r in h.collect()]
    assert got[0] == ("p3", 1, 3) and len(got) == 5 and {i for i, _, t in got if t is None} == {"p1", "p4"}
    assert tuple(search.impact(h).first()) == (3, 2, 0)
    assert [search.parse_limit(x) for x in ("7", "x", "0", None, "-2", "3abc", 4)] == [7, 5, 5, 5, -2, 3, 4]
    with pytest.raises(ValueError):
        search.search(p, "  ", embed.HashingProvider(2))
    q = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], "query_id long, vector array<float>")
    pts = p.withColumn("n", F.substring("id", 2, 9).cast("long"))
    batch = sorted((r["query_id"], r["rank"], r["n"]) for r in search.vector_search_batch(pts, q, 2, "n").collect())
    assert batch == [(1, 1, 0), (1, 2, 1), (2, 1, 3), (2, 2, 2)]


def test_heading_stack_and_location(spark):
    rows = [("d", k, "heading", f"h{k}", n, False, False, None, None, None, None) for k, n in enumerate([1, 2, 4, 2, 1])]
    out = sections.with_heading_path(spark.createDataFrame(rows, BLOCKS)).orderBy("pos").collect()
    assert [r["heading_path"] for r in out] == [["h0"], ["h0", "h1"], ["h0", "h1", "h2"], ["h0", "h3"], ["h4"]]


def test_stream(spark, tmp_path):
    from lodestone.streaming.ingest import ingest

    held = index.Collection(spark, str(tmp_path / "ix"), "s", 8)
    held.create()
    data = str(tmp_path / "in")
    for text in ("First text here.", "Second text here."):
        spark.createDataFrame([("/a", text), (f"/{text[0]}", text)], "path string, text string").write.mode("append").parquet(data)
        ingest(spark, data, held, embed.HashingProvider(8), str(tmp_path / "cp")).awaitTermination()
    got = {r["source_path"]: r["text"] for r in held.read().collect()}
    assert got == {"/a": "Second text here.", "/F": "First text here.", "/S": "Second text here."}


def test_stream_of_files(spark, tmp_path):
    """Each file comes once over restarts, and again when it changes; broken ones do not stop the rest."""
    from lodestone.streaming.ingest import ingest_directory

    held = index.Collection(spark, str(tmp_path / "ix"), "s", 8)
    held.create()
    root, sizes = tmp_path / "in", []
    (root / "sub").mkdir(parents=True)

    def run():
        time.sleep(0.3)
        q = ingest_directory(spark, str(root), held, embed.HashingProvider(8), str(tmp_path / "cp"), str(tmp_path / "bad"), settle=0.1)
        q.awaitTermination()
        sizes.append(sum(p["numInputRows"] for p in q.recentProgress))
        now = held.read()
        return {os.path.relpath(r["source_path"], root): r["text"] for r in now.collect()} if now is not None else {}

    assert run() == {} and sizes == [0]
    (root / "a.txt").write_text("First text here.")
    (root / "b.md").write_text("Words of b.")
    (root / "broken.pdf").write_text("no such thing")
    (root / "other.exe").write_text("passed over")
    assert run() == {"a.txt": "First text here.", "b.md": "Words of b."}
    old = tmp_path / "c.txt"
    old.write_text("Moved in, written long ago.")
    os.utime(old, (1, 1))
    os.rename(old, root / "sub" / "c.txt")
    (root / "b.md").write_text("Other words of b.")
    (root / "broken.pdf").unlink()
    got = {"a.txt": "First text here.", "b.md": "Other words of b.", "sub/c.txt": "Moved in, written long ago."}
    assert run() == got and run() == got
    bad = spark.read.json(str(tmp_path / "bad")).collect()
    assert [os.path.basename(r["source_path"]) for r in bad] == ["broken.pdf"] and "not a PDF" in bad[0]["error"]
    assert sizes[1:] == [3, 2, 0]


@pytest.mark.parametrize("pretty", [False, True])
def test_json_array(spark, tmp_path, pretty):
    """Parts of all tasks, empty ones too, give the bytes of one array; an error leaves what was there."""
    rows = [(f"d::{i}", "d", i, f'line\n"{i}" \u00e9\U0001f600', "s", "", ["h"] * (i % 3), None, False, False, "txt", "/p", None, i if i % 2 else None, None, {"k": "v"} if i % 4 else {}) for i in range(23)]
    ddl = "id string, doc_id string, chunk_index int, full_text string, summary_text string, title_text string, heading_path array<string>, section_title string, is_table boolean, is_code boolean, doc_type string, source_path string, page_number int, slide_number int, sheet_name string, metadata map<string,string>"
    c = spark.createDataFrame(rows, ddl).repartitionByRange(5, "chunk_index").sortWithinPartitions("chunk_index")
    out = tmp_path / "o.json"
    for kept in (c, c.where("chunk_index % 9 = 8"), c.where("false")):
        expected = json.dumps([chunk_dict(r) for r in kept.collect()], ensure_ascii=False, indent=2 if pretty else None, separators=None if pretty else (",", ":"))
        assert "".join(json_array(kept.toLocalIterator(), pretty)) == expected
        write_json_array(kept, str(out), pretty)
        assert out.read_bytes() == expected.encode() and os.listdir(tmp_path) == ["o.json"]
    with pytest.raises(Exception, match="stop here"):
        write_json_array(c.withColumn("full_text", F.expr("if(chunk_index = 20, raise_error('stop here'), full_text)")), str(out), pretty)
    assert out.read_bytes() == b"[]" and os.listdir(tmp_path) == ["o.json"]


def test_sinks(spark, tmp_path):
    c = spark.sql("SELECT 'i' id, 'd' doc_id, 0 chunk_index, 'f' full_text, 's' summary_text, '' title_text, array('h') heading_path, CAST(NULL AS string) section_title, false is_table, false is_code, 'txt' doc_type, '/p' source_path, 3 page_number, CAST(NULL AS int) slide_number, CAST(NULL AS string) sheet_name, map('k', 'v') metadata")
    assert chunk_dict(c.first()) == {"id": "i", "docId": "d", "chunkIndex": 0, "fullText": "f", "summaryText": "s", "titleText": "", "headingPath": ["h"], "sectionTitle": None, "isTable": False, "isCode": False, "docType": "txt", "sourcePath": "/p", "pageNumber": 3, "metadata": {"k": "v"}}
    write_json_lines(c, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).first()["fullText"] == "f"


def test_config(monkeypatch):
    monkeypatch.setenv("BATCH_SIZE", "7")
    monkeypatch.setenv("API_KEY", "secret")
    c = Config.from_env(collection="x")
    assert c.batch_size == 7 and c.collection == "x" and c.shown()["api_key"] == "***"
    monkeypatch.setenv("MAX_RETRIES", "many")
    with pytest.raises(ValueError):
        Config.from_env()


def test_supported_types(spark):
    got = spark.createDataFrame([("/a.MD",), ("/b.xls",), ("/c.exe",)], "p string").select(T.doc_type("p")).collect()
    assert [r[0] for r in got] == ["md", "xlsx", None]


def test_table_function(spark):
    from lodestone.operators.documents import register

    register(spark)
    spark.createDataFrame([(1, "# A\n\none\n\n# B\n\ntwo"), (2, None)], "k int, t string").createOrReplaceTempView("texts_to_chunk")
    got = spark.sql("SELECT k, c.* FROM texts_to_chunk, LATERAL chunk_text(t, 'md') c ORDER BY k, chunk_index").collect()
    assert [(r["k"], r["full_text"]) for r in got] == [(1, "A\n\none"), (1, "B\n\ntwo"), (2, "[Empty document]")]


def bytes_of(folder):
    return sum(os.path.getsize(f"{d}/{f}") for d, _, names in os.walk(folder) for f in names)


def index_rows(spark, *points_):
    return spark.createDataFrame([(i, [1.0, 2.0], t, "d", "txt", n) for i, t, n in points_], "id string, full_vector array<float>, text string, doc_id string, doc_type string, updated_at int")


def test_upsert_writes_what_is_new(spark, tmp_path):
    held = index.Collection(spark, str(tmp_path), "b", 2)
    assert held.create() and not held.create() and held.count() == 0 and held.read() is None
    rows = lambda *x: index_rows(spark, *x)
    assert held.upsert(rows(*((f"p{k}", f"first {k}", 0) for k in range(40)))) == 1
    before = held.segments()
    held.upsert(rows(("p1", "old", 1), ("p1", "new words", 3), ("p1", "older", 2)))
    after = held.segments()
    assert after[:1] == before and [s["rows"] for s in after] == [40, 1] and held.count() == 40
    assert [r["text"] for r in held.read().where("id = 'p1'").collect()] == ["new words"]
    assert {r["id"] for r in held.postings().where("word = 'words'").collect()} == {"p1"}
    assert held.postings().where("word = 'first'").count() == 39
    assert held.upsert(rows()) == 0 and held.segments() == after
    with pytest.raises(RuntimeError, match="Failed to upsert batch 1: .*Wrong vector size"):
        held.upsert(rows(("x", "t", 0)).withColumn("full_vector", F.expr("array(1f)")))
    assert held.count() == 40
    held.delete(rows(("p1", "", 0), ("p2", "", 0), ("none", "", 0)).select("id"))
    assert held.count() == 38 and held.read().where("id in ('p1', 'p2')").count() == 0 and held.postings().where("id = 'p1'").count() == 0
    held.upsert(rows(("p2", "back", 9)))
    assert [r["text"] for r in held.read().where("id = 'p2'").collect()] == ["back"] and held.count() == 39
    want = sorted(map(repr, held.read().collect()))
    held.compact()
    assert [s["rows"] for s in held.segments()] == [39] and sorted(map(repr, held.read().collect())) == want
    assert "Join" not in held.read()._jdf.queryExecution().toString()
    # a second writer that began from the same manifest fails
    with pytest.raises(Exception, match="exist"):
        held._commit(held._held()[0], [])
    with pytest.raises(ValueError):
        held.reset()
    held.reset(force=True)
    assert held.count() == 0 and held.read() is None


def test_batch_search_of_odd_vectors(spark):
    data = [(1, [1.0, 0.0]), (2, None), (3, [0.0, 1.0]), (5, [1.0, None])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    asked = df.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    got = search.vector_search_batch(df, asked, 1, "vec_id", "embedding").collect()
    assert {(r["query_id"], r["vec_id"]) for r in got} == {(1, 1), (3, 3)}
    assert search.vector_search_batch(df, asked, 0, "vec_id", "embedding").collect() == []
    assert search.vector_search_batch(df.limit(0), asked, 3, "vec_id", "embedding").collect() == []
    assert search.vector_search_batch(df, asked.limit(0), 3, "vec_id", "embedding").collect() == []
    # another length is an error, for queries and points, never a row that is left out
    short = spark.createDataFrame([(4, [1.0])], "vec_id long, embedding array<float>")
    with pytest.raises(ValueError, match="Wrong vector size"):
        search.vector_search_batch(df, asked.unionByName(short.toDF("query_id", "vector")), 1, "vec_id", "embedding")
    with pytest.raises(Exception, match="Wrong vector size: 1"):
        search.vector_search_batch(df.unionByName(short), asked, 1, "vec_id", "embedding").collect()


def test_sparse_sheet():
    from lodestone.sources.parsers import office

    cells = "".join(f'<row><c r="{ref}" t="str"><v>{v}</v></c></row>' for ref, v in (("A1", "a"), ("XFD1048576", "z"), ("B2", "b")))
    rows = office._sheet(office.ET.fromstring(f"<worksheet><sheetData>{cells}</sheetData></worksheet>"), [], [], office.datetime(1899, 12, 30))
    assert rows == [["a", ""], ["", "b"], [], ["z"], []]
    assert office.regions(rows) == [[["a", ""], ["", "b"]], [["z"]]]


def test_fold_of_pieces_in_both_forms(spark):
    rng = random.Random(2)
    sentence = lambda: " ".join(["word"] * rng.randint(1, 30)) + rng.choice([". ", "! ", " ", "?\n"])
    texts = ["", "  \n", "short", *("\n\n".join("".join(sentence() for _ in range(rng.randint(0, 25))) for _ in range(rng.randint(1, 8))) for _ in range(60))]
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string").select("k", splitter.split_text("t", 60, 25).alias("a"), splitter.split_sentences("t", 60, 25).alias("b"))
    for r in df.collect():
        assert r["a"] == splitter.split(texts[r["k"]], 60, 25) and r["b"] == splitter.by_sentence(texts[r["k"]], 60, 25)
    assert df.where("a is null").count() == 0


def test_upsert_of_few_points_writes_little(spark, tmp_path):
    held = index.Collection(spark, str(tmp_path), "b", 2)
    many = spark.range(40_000).selectExpr("cast(id as string) id", "array(float(id), float(rand(1))) full_vector", "concat('some words of ', id, ' ', uuid()) text", "concat('d', id % 100) doc_id", "'txt' doc_type", "0 updated_at")
    held.upsert(many)
    before = bytes_of(tmp_path)
    few = many.where("cast(id as int) % 100 = 7")
    held.upsert(few.withColumn("updated_at", F.lit(1)))
    assert bytes_of(tmp_path) - before < 0.05 * before and held.read().where("updated_at = 1").count() == 400 and held.count() == 40_000
    # upserts again and again become one segment in time
    for k in range(2, 5):
        held.upsert(many.where(f"cast(id as int) % 5 = {k}").withColumn("updated_at", F.lit(k)))
    assert len(held.segments()) <= 3 and held.count() == 40_000


def test_upsert_batches(spark, tmp_path):
    """Batches before one that fails stay, and the index can be read."""
    held = index.Collection(spark, str(tmp_path), "b", 2, compact_share=9.0)
    rows = index_rows(spark, *((f"p{k}", f"first {k}", 0) for k in range(60)))
    assert held.upsert(rows, batch_size=20) == 3 and held.count() == 60 and len(held.segments()) == 3
    broken = rows.withColumn("text", F.lit("second")).withColumn("full_vector", F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 1, F.expr("array(1f)")).otherwise(F.col("full_vector")))
    with pytest.raises(RuntimeError, match="Failed to upsert batch 2"):
        held.upsert(broken, batch_size=20)
    first = rows.where(F.pmod(F.xxhash64("id"), F.lit(3)) == 0).count()
    assert held.count() == 60 and held.read().where("text = 'second'").count() == first > 0
    assert not [x for x in os.listdir(tmp_path / "b") if x.startswith("staged")]


def test_filters_read_matching_files_only(spark, tmp_path):
    held = index.Collection(spark, str(tmp_path), "f", 1, compact_share=9.0)
    rows = spark.range(4000).selectExpr("cast(id as string) id", "array(1f) full_vector", "'t' text", "format_string('d%04d', id) doc_id", "element_at(array('pdf', 'txt', 'md', 'html'), cast(1 + id div 1000 as int)) doc_type", "id >= 2000 is_table", "id < 10 is_code")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        held.upsert(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    held.upsert(rows.where("id = '5'").withColumn("doc_type", F.lit("md")))
    every = len([f for f in held.read().inputFiles() if "/points/" in f])
    for where, n in (({"doc_type": "pdf"}, 999), ({"doc_type": ["md"], "is_table": False}, 1), ({"doc_id": "d0007"}, 1), ({"is_code": True}, 10), ({"doc_type": "eml"}, 0)):
        got = held.read(where)
        assert (0 if got is None else got.count()) == n, where
        files = [] if got is None else [f for f in got.inputFiles() if "/points/" in f]
        assert len(files) < every, where
    with pytest.raises(ValueError, match="No index on text"):
        held.read({"text": "t"})


def test_hybrid_lists(spark, tmp_path, capsys, monkeypatch):
    """The heads of both lists with what is left of them, and a hybrid preview of 150 characters."""
    held = index.Collection(spark, str(tmp_path), "dev_docs", 32)
    text = "apple " + "long words here " * 20
    rows = spark.range(14).selectExpr("cast(id as string) id", f"'{text}' text", "concat('/d/', id, '.txt') source_path", "'txt' doc_type", "'d' doc_id", "concat('Title ', id) title_text", "'' summary_text", "false is_table", "false is_code", "cast(null as int) page_number", "cast(null as int) slide_number", "cast(null as string) sheet_name", "array_repeat(float(id + 1), 32) full_vector")
    held.upsert(rows)
    lines = search.hybrid_lists(held.read(), "apple", [1.0] * 32, 2)
    assert lines[0] == "Vector search: 14 results" and lines[1].startswith("  [1] Score: 1.0000 | ") and lines[13] == "  [1] 0.txt | Title 0" and lines[11] == "  ... and 4 more" and lines[12] == "Text search: 14 results" and lines[-1] == "  ... and 4 more"
    assert search.hybrid_lists(held.read(), "pear", [1.0] * 32, 1)[-2:] == ["Text search: 0 results", "  No keyword matches found"]
    monkeypatch.setenv("INDEX_DIR", str(tmp_path))
    monkeypatch.setenv("DIMENSIONS", "32")
    assert cli.main(["search", "apple", "-n", "1", "-f", "doc_type=txt", "-f", "is_table=false"]) == 0
    shown = capsys.readouterr().out
    assert "Text search: 10 results" in shown and len(eval(shown.splitlines()[-1])["preview"]) <= 153
    assert cli.main(["search", "apple", "-f", "doc_type=pdf"]) == 1
    # typed searches: a blank one asks again, one that fails is told, and both ways to end
    capsys.readouterr()
    typed = iter(["  ", "apple", "2", "TEXT", "apple", "x", "", "apple", "1", "vector", "Quit"])
    monkeypatch.setattr("builtins.input", lambda prompt: next(typed))
    assert cli.main(["search"]) == 0
    shown = capsys.readouterr().out.splitlines()
    assert shown[1] == "Please enter a query." and [x[0] for x in shown[2:4]] == ["{", "{"] and shown[4] == "Vector search: 14 results"
    assert sum(x[0] == "{" for x in shown) == 2 + 5 + 1 and shown[-1] == "Goodbye!"

    class Broken(embed.HashingProvider):
        def embed(self, texts):
            raise RuntimeError("no vectors")

    typed = iter(["apple", "", "vector", "apple", "1", "text"])

    def read(prompt):
        try:
            return next(typed)
        except StopIteration:
            raise EOFError from None

    cli.ask(held.read(), Broken(32), read)
    told = capsys.readouterr()
    assert "Search error: no vectors" in told.err and sum(x[:1] == "{" for x in told.out.splitlines()) == 1 and told.out.endswith("Goodbye!\n")
