"""Sinks of chunks: one JSON array, and JSON lines for large results."""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

#: The names of a chunk's fields in JSON.
FIELDS = {
    "id": "id", "doc_id": "docId", "chunk_index": "chunkIndex", "full_text": "fullText", "summary_text": "summaryText", "title_text": "titleText", "heading_path": "headingPath",
    "section_title": "sectionTitle", "is_table": "isTable", "is_code": "isCode", "doc_type": "docType", "source_path": "sourcePath", "page_number": "pageNumber",
    "slide_number": "slideNumber", "sheet_name": "sheetName", "metadata": "metadata",
}
_OPTIONAL = ("page_number", "slide_number", "sheet_name")


def chunk_dict(row: Row | dict) -> dict:
    """A chunk as JSON holds it: places that it has not are left out, a null title stays."""
    out = {name: row[c] for c, name in FIELDS.items() if not (c in _OPTIONAL and row[c] is None)}
    out["metadata"] = dict(row["metadata"] or {})
    return out


def _items(rows: Iterable[Row | dict], pretty: bool) -> Iterator[str]:
    """Each chunk as it stands in the array; all but the first with what parts it from the one before."""
    for k, row in enumerate(rows):
        if pretty:  # line breaks inside strings are escaped, so all of these are of the layout
            text = "  " + json.dumps(chunk_dict(row), ensure_ascii=False, indent=2).replace("\n", "\n  ")
        else:
            text = json.dumps(chunk_dict(row), ensure_ascii=False, separators=(",", ":"))
        yield (_between(pretty) if k else "") + text


def _between(pretty: bool) -> str:
    return ",\n" if pretty else ","


def _ends(pretty: bool, empty: bool) -> tuple[str, str]:
    return ("[\n", "\n]") if pretty and not empty else ("[", "]")


def json_array(rows: Iterable[Row], pretty: bool = False) -> Iterator[str]:
    """One array of all chunks in pieces, for results that a program prints as they come."""
    empty = True
    for item in _items(rows, pretty):
        yield _ends(pretty, False)[0] * empty + item
        empty = False
    yield "[]" if empty else _ends(pretty, False)[1]


@dataclass
class Part(WriterCommitMessage):
    """The file that one task has written; none if it had no rows."""

    path: str | None


class JsonArrayWriter(DataSourceArrowWriter):
    """Each task writes its chunks beside the output; the commit joins the parts of the tasks that count, in the
    order of the partitions, and puts the whole in place at once. So what is seen at the path is an old array or a
    whole new one, whichever tasks ran twice or were lost. The commit copies bytes and holds no rows."""

    def __init__(self, path: str, pretty: bool):
        self.path, self.pretty = os.path.abspath(path), pretty
        self.folder = os.path.join(os.path.dirname(self.path), f".{os.path.basename(path)}-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        rows = (r for b in iterator for i in range(0, b.num_rows, 256) for r in b.slice(i, 256).to_pylist())
        path = None
        for item in _items(rows, self.pretty):
            if path is None:
                path = os.path.join(self.folder, uuid.uuid4().hex)
                out = open(path, "w", encoding="utf-8", newline="")  # noqa: SIM115  closed below
            out.write(item)
        if path is not None:
            out.close()
        return Part(path)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        parts = [m.path for m in messages if m is not None and m.path is not None]
        first, last = _ends(self.pretty, not parts)
        whole = os.path.join(self.folder, "whole")
        with open(whole, "wb") as out:
            for k, p in enumerate(parts):
                out.write((_between(self.pretty) if k else first).encode())
                with open(p, "rb") as f:
                    shutil.copyfileobj(f, out, 1 << 20)
            out.write((last if parts else first + last).encode())
        os.replace(whole, self.path)
        self._remove()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._remove()

    def _remove(self) -> None:
        """Moved away first: tasks that still run then find no folder to write to, and fail."""
        gone = f"{self.folder}-gone"
        os.rename(self.folder, gone)
        shutil.rmtree(gone, ignore_errors=True)


class JsonArraySink(DataSource):
    """Options: path, a file in a folder that all machines share; pretty."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def writer(self, schema, overwrite: bool) -> JsonArrayWriter:
        if not overwrite:
            raise ValueError("an array is written whole: use mode('overwrite')")
        out = JsonArrayWriter(self.options["path"], self.options.get("pretty", "false").lower() == "true")
        os.makedirs(out.folder)
        return out


def write_json_array(chunks: DataFrame, path: str, pretty: bool = False) -> None:
    """One file with an array of all chunks, in the order of the partitions of `chunks`."""
    chunks.sparkSession.dataSource.register(JsonArraySink)
    chunks.select(*FIELDS).write.format("json_array").mode("overwrite").option("pretty", str(pretty)).save(path)


def write_json_lines(chunks: DataFrame, path: str) -> None:
    """A folder of JSON lines, written by the executors."""
    chunks.select(*(chunks[c].alias(n) for c, n in FIELDS.items())).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
