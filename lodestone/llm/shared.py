"""Tables that cut a job's lineage, in the folder that the cluster shares."""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, GroupedData, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, a temporary one of the
    session's own, if all of Spark runs in this machine's one process. A cluster must name
    a folder that all its machines share: without one this raises ValueError."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "file://" + tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def _file_system(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def written(df: DataFrame, name: str, **options: int) -> DataFrame:
    """Write a table to the shared folder and read it again: a lost executor costs no
    more than its own running tasks, and nothing is computed twice. It goes with
    `dropped`, or else when the driver ends. options: of the writer."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    df.write.options(compression="zstd", **options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """As `written`, dealt into buckets by a column: joins on it need not move the table again."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/{table}"
    fs, p = _file_system(spark, path)
    fs.deleteOnExit(p)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.format("parquet").options(compression="zstd", path=path).bucketBy(n, column).sortBy(column).saveAsTable(table)
    out = spark.table(table)
    out._written_to, out._named = path, table
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove tables that `written` or `bucketed` made and nothing reads any more."""
    for t in tables:
        if name := getattr(t, "_named", None):
            t.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
        if path := getattr(t, "_written_to", None):
            fs, p = _file_system(t.sparkSession, path)
            fs.delete(p, True)


def partitions(df: DataFrame, column: str, bytes_each: int, least: int = 8) -> int:
    """How many partitions of `bytes_each` bytes of text the column makes; for planning
    the number of tasks only."""
    total = df.agg(F.sum(F.octet_length(column))).first()[0] or 0
    return max(least, -(-int(total) // bytes_each))


_SLICE = 1 << 16


def bitmap(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """A map of 2**bits bits, packed, with those of the low bits of a long column set:
    of one size for any number of rows. Executors make it, in parts of 8 KB."""
    bit = F.col(column).bitwiseAND((1 << bits) - 1)
    parts = df.select(bit.alias("bit")).distinct().groupBy((F.col("bit") / _SLICE).cast("int").alias("part")).agg(F.collect_list((F.col("bit") % _SLICE).cast("int")).alias("bits"))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for held in b.column(1):
                m = np.zeros(_SLICE, bool)
                m[held.values.to_numpy()] = True
                out.append(np.packbits(m, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["part", "bytes"])

    found = np.zeros(max(1 << bits, _SLICE) // 8, np.uint8)
    for part, raw in mapped(parts, packed, "part int, bytes binary").collect():  # 2**bits bits at the most
        found[part * _SLICE // 8 : (part + 1) * _SLICE // 8] = np.frombuffer(raw, np.uint8)
    return found[: max(1, (1 << bits) // 8)]


def marked(found: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which of some 64-bit values have their bit set in a map of `bitmap`."""
    bit = values.astype(np.uint64) & np.uint64(len(found) * 8 - 1)
    return (found[(bit >> np.uint64(3)).astype(np.int64)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1


def is_marked(spark: SparkSession, found: np.ndarray) -> Callable[[str], Column]:
    """As `marked`, of a long column: a filter that moves no row. What is not marked is surely not
    among the values that the map was made of."""
    held = spark.sparkContext.broadcast(found)

    @F.arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        return pa.array(marked(held.value, values.to_numpy(zero_copy_only=False)))

    return test


def give_back() -> None:
    """Returns freed memory to the system, where the C library can: a Python worker lives on
    beside the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


_kept: dict[str, object] = {}


def kept(key: str, make: Callable[[], object]) -> object:
    """What `make` gives, made once in a Python worker and kept for tasks that are `mapped` with `keeps=key`."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def let_go(keeps: str | None = None) -> None:
    """Drops what tasks of other kinds have kept in this worker, which lives on beside them."""
    for key in [k for k in _kept if k != keeps]:
        del _kept[key]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str, keeps: str | None = None) -> DataFrame:
    """mapInArrow; the functions work on slices of a batch, which Spark bounds in bytes. keeps: see `kept`."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go(keeps)
        yield from run(batches)
        give_back()

    return df.mapInArrow(task, schema)


def grouped(groups: GroupedData, run: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """applyInArrow of a function over groups of bounded size."""

    def group(table: pa.Table) -> pa.Table:
        let_go()
        out = run(table)
        give_back()
        return out

    return groups.applyInArrow(group, schema)
