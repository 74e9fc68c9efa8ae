"""A data source of document files: spark.read.format("documents").load(directory)."""

from __future__ import annotations

import os
import stat
import time
from collections.abc import Iterator
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from lodestone.functions import text as T
from lodestone.functions.text import DOC_TYPES, SCANNED
from lodestone.schema import FILE

#: Bytes of files that one task reads.
GROUP_BYTES = 64 << 20


def extension(path: str) -> str:
    """Lower-cased, without the dot; none for names that only begin with one."""
    return os.path.splitext(os.path.basename(path))[1].lower()[1:]


def find_documents(root: str) -> list[str]:
    """Absolute paths of all supported files below a directory, sorted. Directories that
    begin with a dot or are named node_modules, links, and what cannot be read are passed over."""
    out, todo = [], [os.path.abspath(root)]
    while todo:
        try:
            entries = list(os.scandir(todo.pop()))
        except OSError:
            continue
        for e in entries:
            if e.is_dir(follow_symlinks=False):
                if not e.name.startswith(".") and e.name != "node_modules":
                    todo.append(e.path)
            elif e.is_file(follow_symlinks=False) and extension(e.name) in SCANNED:
                out.append(e.path)
    return sorted(out, key=lambda p: p.encode("utf-16-be"))


class Group(InputPartition):
    """Files that one task reads."""

    def __init__(self, paths: list[str]):
        self.paths = paths


def grouped(paths: list[str]) -> list[Group]:
    """Groups of GROUP_BYTES or of one larger file, in the order of the paths."""
    groups: list[list[str]] = []
    size = 0
    for p in paths:
        n = os.path.getsize(p) if os.path.isfile(p) else 0
        if not groups or size + n > GROUP_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(p)
        size += n
    return [Group(g) for g in groups]


def file_row(p: str) -> tuple:
    """The FILE row of a path, with `error` where it cannot be read."""
    kind = DOC_TYPES.get(extension(p))
    row: tuple = (p, os.path.basename(p), None, None, None, kind, None)
    try:
        s = os.stat(p)
        if not stat.S_ISREG(s.st_mode):
            return (*row, f"Not a file: {p}")
        if kind is None:
            return (*row, f"Unsupported file extension: .{extension(p)}")
        with open(p, "rb") as f:
            content = f.read()
        born = getattr(s, "st_birthtime", s.st_ctime)
        at = [datetime.fromtimestamp(t, UTC) for t in (born, s.st_mtime)]
        return (p, os.path.basename(p), s.st_size, *at, kind, content, None)
    except FileNotFoundError:
        return (*row, f"File not found: {p}")
    except OSError as e:
        return (*row, str(e))


class DocumentReader(DataSourceReader):
    def __init__(self, paths: list[str]):
        self.paths = paths

    def partitions(self) -> list[Group]:
        return grouped(self.paths)

    def read(self, partition: Group) -> Iterator[tuple]:
        return map(file_row, partition.paths)


class DocumentStream(DataSourceStreamReader):
    """Documents below a directory as they arrive. An offset is a time in nanoseconds: a batch has the files
    whose status changed after its start and up to its end, so a file comes once for each time that it is
    written, replaced or moved in, and a restart goes on from the time in the checkpoint.

    Files that changed less than `settle` seconds ago wait, for all of one time must be there before that
    time is passed; set it above the difference of the clocks of the machines that write. A whole folder
    that is moved in does not change the times of its files: move files, or write them."""

    def __init__(self, root: str, settle: float):
        self.root, self.settle = root, settle

    def _changed(self) -> Iterator[tuple[int, str]]:
        for p in find_documents(self.root):
            try:
                yield os.stat(p).st_ctime_ns, p
            except OSError:  # gone since the directory was listed
                continue

    def initialOffset(self) -> dict:
        return {"ns": 0}

    def latestOffset(self) -> dict:
        until = time.time_ns() - round(self.settle * 1e9)
        return {"ns": max((at for at, _ in self._changed() if at <= until), default=0)}

    def partitions(self, start: dict, end: dict) -> list[Group]:
        return grouped([p for at, p in self._changed() if start["ns"] < at <= end["ns"]])

    def read(self, partition: Group) -> Iterator[tuple]:
        return map(file_row, partition.paths)


class DocumentSource(DataSource):
    """Options: path, a directory to scan; or paths, files one a line, taken as they are. As a stream: path,
    and settle, the seconds that a file must have stood unchanged (1)."""

    @classmethod
    def name(cls) -> str:
        return "documents"

    def schema(self) -> str:
        return FILE

    def reader(self, schema) -> DocumentReader:
        if given := self.options.get("paths"):
            return DocumentReader([os.path.abspath(p) for p in given.split("\n") if p])
        return DocumentReader(find_documents(self.options["path"]))

    def streamReader(self, schema) -> DocumentStream:
        return DocumentStream(self.options["path"], float(self.options.get("settle", "1")))


def read_store(spark: SparkSession, root: str) -> DataFrame:
    """FILE rows of a folder in any store that Spark reads. Its reader passes over empty
    files and names that begin with a dot or an underscore, and knows no time of creation."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    below = F.substring_index("path", root.rstrip("/").rsplit("://", 1)[-1], -1)
    kept = raw.where(T.extension("path").isin(*SCANNED) & ~below.rlike(r"/(\.[^/]*|node_modules)/"))
    return kept.select(
        "path", T.filename("path").alias("file_name"), F.col("length").alias("file_size"), F.lit(None).cast("timestamp").alias("created_at"), F.col("modificationTime").alias("modified_at"),
        T.doc_type("path").alias("doc_type"), "content", F.lit(None).cast("string").alias("error"),
    )


def read_directory(spark: SparkSession, root: str) -> DataFrame:
    """FILE rows of all documents below a directory; `scheme://` paths go by read_store."""
    if "://" in root:
        return read_store(spark, root)
    spark.dataSource.register(DocumentSource)
    return spark.read.format("documents").load(root)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """FILE rows of the files named, with `error` for those that are missing, no files or
    not supported."""
    spark.dataSource.register(DocumentSource)
    return spark.read.format("documents").option("paths", "\n".join(paths)).load()


def stream_directory(spark: SparkSession, root: str, settle: float = 1) -> DataFrame:
    """FILE rows of the documents below a directory, as they arrive and change (DocumentStream)."""
    spark.dataSource.register(DocumentSource)
    return spark.readStream.format("documents").option("settle", str(settle)).load(root)
