"""Files to chunks in one pass without a shuffle: each row is decoded, sectioned and cut
in the task that reads it. operators/sections.py has the same rules over rows of blocks."""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

from lodestone.functions.splitter import SPLIT_ABOVE, clean, split, summary, tokens, trim
from lodestone.schema import CHUNK, EMPTY_SUMMARY, EMPTY_TEXT, names
from lodestone.sources.parsers import parse

_META = pa.map_(pa.string(), pa.string())
_TYPES = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_()}


def doc_id(path: str) -> str:
    return hashlib.sha256(path.encode()).hexdigest()[:16]


def scalar(v: object) -> str:
    """A metadata value as text: strings as they are, the rest as JSON."""
    return v if isinstance(v, str) else json.dumps(v, ensure_ascii=False, separators=(",", ":"))


def sections(blocks: Iterable[dict]) -> Iterator[tuple[list[str], dict, list[dict]]]:
    """(heading path, last location, blocks) of each run of content under its headings."""
    stack: list[tuple[int, str]] = []
    where: dict = {}
    held: list[dict] = []
    for b in blocks:
        if b["type"] == "heading":
            if held:
                yield [t for _, t in stack], dict(where), held
                held = []
            level = b.get("level") or 1
            stack = [(n, t) for n, t in stack if n < level]
            stack.append((level, b["content"]))
        else:
            held.append(b)
        where |= {k: b[k] for k in ("page_number", "slide_number", "sheet_name") if b.get(k) is not None}
    if held:
        yield [t for _, t in stack], where, held


def chunks(blocks: Iterable[dict], doc: str, doc_type: str, path: str, metadata: dict) -> list[dict]:
    """The chunks of a document's blocks, as CHUNK rows."""
    out: list[dict] = []
    base = {"doc_id": doc, "doc_type": doc_type, "source_path": path}
    for path_, where, held in sections(blocks):
        text = clean("\n\n".join(b["content"] for b in held if b["content"]))
        if not text:
            continue
        title = " > ".join(h for h in path_ if trim(h))
        meta = dict(metadata)
        for b in held:
            meta |= b.get("metadata") or {}
        long = tokens(text) > SPLIT_ABOVE
        parts = split(text) if long else [text]
        for k, part in enumerate(parts, 1):
            more = {"splitPart": k, "totalParts": len(parts)} if long else {}
            out.append(
                base | where | {
                    "id": f"{doc}::{len(out)}", "chunk_index": len(out), "full_text": f"{title}\n\n{part}" if title else part, "summary_text": summary(part), "title_text": title,
                    "heading_path": path_, "section_title": path_[-1] if path_ else None, "is_table": any(b.get("is_table") for b in held), "is_code": any(b.get("is_code") for b in held),
                    "metadata": meta | more,
                }
            )
    if not out:
        out.append(base | {"id": f"{doc}::0", "chunk_index": 0, "full_text": EMPTY_TEXT, "summary_text": EMPTY_SUMMARY, "title_text": "", "heading_path": [], "section_title": None, "is_table": False, "is_code": False, "metadata": metadata | {"isEmpty": True}})
    return out


def _arrow(rows: list[dict], ddl: str) -> pa.RecordBatch:
    cols = []
    for field in ddl.split(", "):
        name, kind = field.split(" ", 1)
        if kind.startswith("map"):
            cols.append(pa.array([list({k: scalar(v) for k, v in (r.get(name) or {}).items()}.items()) if r.get(name) is not None else None for r in rows], _META))
        elif kind.startswith("array"):
            cols.append(pa.array([r.get(name) for r in rows], pa.list_(pa.string())))
        else:
            cols.append(pa.array([r.get(name) for r in rows], _TYPES[kind]))
    return pa.RecordBatch.from_arrays(cols, names=names(ddl))


def _of_file(f: dict) -> list[dict]:
    """What chunk_files gives of one file."""
    at = {"source_path": f["path"], "doc_type": f["doc_type"], "doc_id": doc_id(f["path"])}
    if f["error"] is not None:
        return [at | {"error": f["error"], "elapsed_ms": 0}]
    began = time.perf_counter()
    try:
        blocks, meta = parse(f["content"] or b"", f["doc_type"])
        stats = {"fileName": f["file_name"], "fileSize": f["file_size"], "createdAt": f["created"], "modifiedAt": f["modified"], "absolutePath": f["path"]}
        rows = chunks(blocks, at["doc_id"], f["doc_type"], f["path"], {k: v for k, v in stats.items() if v is not None} | meta)
    except Exception as e:  # a broken file is a row, not a failed job
        rows = [at | {"error": f"{type(e).__name__}: {e}"}]
    elapsed = round((time.perf_counter() - began) * 1000)
    for r in rows:
        r["elapsed_ms"] = elapsed
    return rows


def _ready(files: DataFrame) -> DataFrame:
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return files.select("path", "file_name", "file_size", iso("created_at").alias("created"), iso("modified_at").alias("modified"), "doc_type", "content", "error")


def chunk_files(files: DataFrame) -> DataFrame:
    """CHUNK rows of all files (FILE rows), and one row with `error` and no id for each
    file that cannot be read or parsed; no file stops another. elapsed_ms is that of its file."""
    ddl = CHUNK + ", error string, elapsed_ms long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                yield _arrow([r for f in b.slice(i, 64).to_pylist() for r in _of_file(f)], ddl)

    return _ready(files).mapInArrow(run, ddl)


#: How a file fares in chunk_files.
OUTCOME = "source_path string, chunks int, error string, elapsed_ms long"


def outcomes(files: Iterable[dict]) -> pa.RecordBatch:
    """OUTCOME rows of files at hand in a task: dicts of the columns of FILE, with its times as text."""
    rows = []
    for f in files:
        made = _of_file(f)
        rows.append(made[0] | {"chunks": sum(r.get("id") is not None for r in made)})
    return _arrow(rows, OUTCOME)


def file_outcomes(files: DataFrame) -> DataFrame:
    """OUTCOME rows of files (FILE rows). All chunks of a file are made where it is read, so they are counted there:
    no chunk leaves its task and nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 64):
                yield outcomes(b.slice(i, 64).to_pylist())

    return _ready(files).mapInArrow(run, OUTCOME)


def run_summary(chunks: DataFrame) -> DataFrame:
    """files, failed, chunks of a result of chunk_files."""
    per_file = chunks.groupBy("source_path").agg(F.count("id").alias("n"), F.max("error").alias("error"))
    return per_file.agg(F.count(F.lit(1)).alias("files"), F.count("error").alias("failed"), F.coalesce(F.sum("n"), F.lit(0)).alias("chunks"))


def chunk_texts(docs: DataFrame, doc_type: str = "txt") -> DataFrame:
    """CHUNK rows of texts held in a table (path, text): as files of one type."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                rows: list[dict] = []
                for path, text in zip(b.column(0).slice(i, 256).to_pylist(), b.column(1).slice(i, 256).to_pylist()):
                    blocks, meta = parse((text or "").encode(), doc_type)
                    rows += chunks(blocks, doc_id(path), doc_type, path, meta)
                yield _arrow(rows, CHUNK)

    return docs.select("path", "text").mapInArrow(run, CHUNK)


def blocks_of(docs: DataFrame, doc_type: str) -> DataFrame:
    """Block rows (doc_id, pos, ...) of texts, or of files as binary, held in a table (doc_id, text)."""
    ddl = "pos int, type string, content string, level int, is_table boolean, is_code boolean, page_number int, slide_number int, sheet_name string, metadata map<string,string>"
    key = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 256):
                rows, at = [], []
                for k, text in enumerate(b.column(1).slice(i, 256).to_pylist()):
                    found = parse(text.encode() if isinstance(text, str) else text or b"", doc_type)[0]
                    rows += [x | {"pos": n} for n, x in enumerate(found)]
                    at += [i + k] * len(found)
                r = _arrow(rows, ddl)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *r.columns], names=["doc_id", *r.schema.names])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {key}, {ddl}")


@udtf(returnType="chunk_index int, full_text string, summary_text string, title_text string")
class ChunkText:
    """SQL: SELECT ... FROM docs, LATERAL chunk_text(text, 'md')."""

    def eval(self, text: str | None, doc_type: str) -> Iterator[tuple]:
        blocks, meta = parse((text or "").encode(), doc_type)
        for c in chunks(blocks, "", doc_type, "", meta):
            yield c["chunk_index"], c["full_text"], c["summary_text"], c["title_text"]


def register(spark: SparkSession) -> None:
    """Makes chunk_text known to SQL."""
    spark.udtf.register("chunk_text", ChunkText)
