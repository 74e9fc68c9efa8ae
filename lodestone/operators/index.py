"""The index: points (chunks with their vectors) as a log of Parquet segments, and postings of words."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.functions import text as T

#: Points of a bounded task in a batch of a report.
BATCH = 50


def words(text: Column | str) -> Column:
    """The distinct words of a text for full-text matching: lower-cased runs of letters and digits."""
    c = F.col(text) if isinstance(text, str) else text
    return F.array_distinct(F.filter(F.split(F.lower(c), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def embedded(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    """Chunks with their vectors; a chunk without vectors fails the query with its id. Of
    several vectors of one chunk the greatest stands."""
    one = embeddings.groupBy("chunk_id").agg(F.max(F.struct("full_vector", "summary_vector")).alias("v"))
    missing = F.raise_error(F.concat(F.lit("Missing embedding for chunk: "), F.col("id")))
    both = chunks.join(one, F.col("id") == F.col("chunk_id"), "left")
    return both.select(*chunks.columns, F.when(F.col("v").isNull(), missing.cast("array<float>")).otherwise(F.col("v.full_vector")).alias("full_vector"), F.col("v.summary_vector").alias("summary_vector"))


def missing_embeddings(chunks: DataFrame, embeddings: DataFrame) -> DataFrame:
    return chunks.join(embeddings, chunks["id"] == embeddings["chunk_id"], "left_anti").select("id")


def points(chunks: DataFrame, now: Column | None = None) -> DataFrame:
    """Point rows of chunks with vectors; created and updated at one time for all."""
    now = F.current_timestamp() if now is None else now
    none = F.create_map().cast("map<string,string>")
    return chunks.select(
        T.point_uuid("id").alias("id"), "full_vector", "summary_vector", F.col("full_text").alias("text"), F.col("id").alias("chunk_id"), "doc_id", "chunk_index", "doc_type",
        "source_path", "heading_path", "section_title", "title_text", "summary_text", "is_table", "is_code", "page_number", "slide_number", "sheet_name",
        now.alias("created_at"), now.alias("updated_at"), F.coalesce("metadata", none).alias("metadata"),
    )


def latest(rows: DataFrame, key: str, version: str) -> DataFrame:
    """Of the rows of each key the one with the greatest version: a sum, not a window, so
    a key with very many versions is counted before it moves."""
    return rows.groupBy(key).agg(F.max(F.struct(version, *(c for c in rows.columns if c not in (key, version)))).alias("r")).select(key, "r.*").select(*rows.columns)


def batch_numbers(rows: DataFrame, order: str, size: int = BATCH) -> DataFrame:
    """batch: consecutive slices of `size` rows by the order of a unique integer key that is
    dense from 0; no row moves."""
    return rows.withColumn("batch", F.floor(F.col(order) / size).cast("long"))


#: Columns that a filter may name. Each file of points has its least and greatest value of them, doc_type all values.
FILTERS = ("doc_type", "doc_id", "is_table", "is_code")
#: Share of the first segment's points that later ones may have, and how many there may be, before all become one.
COMPACT_SHARE, COMPACT_SEGMENTS = 0.5, 32


class Collection:
    """A named index as a log of segments under a folder, and a manifest of those that count.

    A segment has the points of one upserted batch, their ids by themselves, the postings of their words
    and what each of its files holds; or the ids of points that are gone. An upsert writes its own
    points alone. Readers merge: of a point's versions that of the latest segment counts, so older segments are held
    against the ids of later ones, and a log of one segment is read without a join. When later segments have grown to a share
    of the first, all become one.

    A batch counts from its manifest on, so readers see all of it or nothing, and a writer that dies leaves
    the batches before. Of two writers at once the second fails and changes nothing; that needs a store that creates a file only
    where there is none, as file systems do (on an object store without it, let one writer at a time in).
    Segments that neither the newest manifest nor the one before names are removed.

    Points lie in order of document type and id, postings in that of words, so readers pass over files and
    row groups that they do not ask for.
    """

    def __init__(self, spark: SparkSession, root: str, name: str, dimensions: int = 3072, compact_share: float = COMPACT_SHARE):
        self.spark, self.path, self.dimensions, self.compact_share = spark, f"{root.rstrip('/')}/{name}", dimensions, compact_share
        self._jvm = spark.sparkContext._jvm
        self._Path = self._jvm.org.apache.hadoop.fs.Path
        self._fs = self._Path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # The log: manifests and segments ---------------------------------------------------

    def _manifests(self) -> list[str]:
        mark = self._Path(f"{self.path}/manifests")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(mark)) if self._fs.exists(mark) else []

    def _manifest(self, name: str) -> list[dict]:
        stream = self._fs.open(self._Path(f"{self.path}/manifests/{name}"))
        try:
            return json.loads(bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _commit(self, number: int, segments: list[dict]) -> None:
        """Adds a manifest; fails where another writer has added it."""
        stream = self._fs.create(self._Path(f"{self.path}/manifests/{number:08d}"), False)
        stream.write(bytearray(json.dumps(segments).encode()))
        stream.close()

    def _held(self) -> tuple[int, list[dict]]:
        names = self._manifests()
        return (int(names[-1]), self._manifest(names[-1])) if names else (-1, [])

    def _table(self, segment: dict, what: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{segment['at']}/{what}")

    def segments(self) -> list[dict]:
        """(at, rows, gone) of the segments that count, oldest first."""
        return self._held()[1]

    def _live(self, segments: list[dict], of: Callable[[dict], DataFrame | None]) -> DataFrame | None:
        """Rows with an id of all segments, without those that a later segment replaces or drops."""
        out, older = None, None
        for k, s in enumerate(segments):
            part = None if s["gone"] else of(s)
            if part is None:
                continue
            if k == len(segments) - 1:
                out = part
            else:
                part = part.withColumn("_segment", F.lit(k))
                older = part if older is None else older.unionByName(part, True)
        if older is not None:
            newer = None
            for k, s in enumerate(segments[1:], 1):
                ids = self._table(s, "ids").select("id", F.lit(k).alias("_later"))
                newer = ids if newer is None else newer.unionByName(ids)
            last = newer.groupBy(F.col("id").alias("_id")).agg(F.max("_later").alias("_later"))
            older = older.join(last, (F.col("id") == F.col("_id")) & (F.col("_segment") < F.col("_later")), "left_anti").drop("_segment")
            out = older if out is None else older.unionByName(out, True)
        return out

    # Readers ---------------------------------------------------------------------------

    def exists(self) -> bool:
        return self._fs.exists(self._Path(self.path))

    def create(self) -> bool:
        """Makes the collection; False where it exists."""
        if self.exists():
            return False
        self._commit(0, [])
        return True

    def read(self, where: Mapping[str, object] | None = None) -> DataFrame | None:
        """The points; None where there are none. where: values (or lists of values) of FILTERS; only files whose
        statistics allow them are listed and read."""
        if not where:
            return self._live(self._held()[1], lambda s: self._table(s, "points"))
        if unknown := set(where) - set(FILTERS):
            raise ValueError(f"No index on {', '.join(sorted(unknown))}")
        asked = {c: list(v) if isinstance(v, list | tuple | set) else [v] for c, v in where.items()}

        def matching(s: dict) -> DataFrame | None:
            at = f"{self.path}/{s['at']}"
            stats = self._table(s, "stats")
            for c, values in asked.items():
                some = F.lit(False)
                for v in values:
                    some |= F.array_contains("doc_types", v) if c == "doc_type" else F.lit(v).between(F.col(f"min_{c}"), F.col(f"max_{c}"))
                stats = stats.where(some)
            names = [r["file"] for r in stats.select("file").collect()]  # of this segment's files, those that match
            return self.spark.read.parquet(*(f"{at}/points/{n}" for n in names)) if names else None

        rows = self._live(self._held()[1], matching)
        for c, values in asked.items():
            rows = rows if rows is None else rows.where(F.col(c).isin(values))
        return rows

    def postings(self) -> DataFrame | None:
        return self._live(self._held()[1], lambda s: self._table(s, "postings"))

    def count(self) -> int:
        """Points; 0 where there is no table."""
        held = self._live(self._held()[1], lambda s: self._table(s, "ids")) if self.exists() else None
        return 0 if held is None else held.count()

    # Writers ---------------------------------------------------------------------------

    def upsert(self, new: DataFrame, order: Sequence[str] = ("updated_at",), batch_size: int | None = None) -> int:
        """Replaces points by id. Of new points with one id that with the greatest `order`
        stands (columns that new has; all others in their order decide ties). Full vectors must
        have the collection's dimensions. Without points nothing changes.

        batch_size: points of a batch, about, dealt by their ids; by default all are one. Batches go in one after
        the other, and the first that fails ends the upsert with `Failed to upsert batch N`; those before it stay.
        Returns how many went in."""
        first = [c for c in order if c in new.columns]
        # maps cannot be compared: they follow what can
        rest = [f.name for f in new.schema if f.name not in ("id", *first) and f.dataType.typeName() != "map"]
        maps = [f.name for f in new.schema if f.dataType.typeName() == "map"]
        one = F.max_by(F.struct(*[c for c in new.columns if c != "id"]), F.struct(*first, *rest)) if first or rest else F.first(F.struct(*maps))
        rows = new.groupBy("id").agg(one.alias("p")).select("id", "p.*").select(*new.columns)
        staged = f"{self.path}/staged-{uuid.uuid4().hex}"
        try:
            rows.write.parquet(staged)
            rows = self.spark.read.schema(rows.schema).parquet(staged)
            n = rows.count()
            batches = -(-n // (batch_size or max(n, 1)))
            if batches > 1:  # dealt once, so that each batch reads its own points
                dealt = F.pmod(F.xxhash64("id"), F.lit(batches)).alias("_batch")
                rows.select("*", dealt).repartition("_batch").write.partitionBy("_batch").parquet(f"{staged}-dealt")
                rows = self.spark.read.parquet(f"{staged}-dealt")
            for k in range(batches):
                try:
                    self._append(rows if batches == 1 else rows.where(F.col("_batch") == k).drop("_batch"))
                except Exception as e:
                    raise RuntimeError(f"Failed to upsert batch {k + 1}: {e}") from e
        finally:
            self._fs.delete(self._Path(staged), True)
            self._fs.delete(self._Path(f"{staged}-dealt"), True)
        if batches:
            self._settle()
        return batches

    def delete(self, ids: DataFrame) -> None:
        """Drops the points of some ids (a column id)."""
        number, held = self._held()
        at = self._new(number)
        ids.select("id").distinct().write.parquet(f"{self.path}/{at}/ids")
        self._commit(number + 1, [*held, {"at": at, "rows": 0, "gone": True}])
        self._settle()

    def compact(self) -> None:
        """Makes one segment of the points that count."""
        number, held = self._held()
        rows = self._live(held, lambda s: self._table(s, "points"))
        written = None if rows is None else self._write(number, rows)
        self._commit(number + 1, [written] if written else [])
        self._clean()

    def _new(self, number: int) -> str:
        return f"s{number + 1:08d}-{uuid.uuid4().hex[:8]}"

    def _append(self, rows: DataFrame) -> None:
        number, held = self._held()
        size = F.size("full_vector")
        right = F.when(size == self.dimensions, F.col("full_vector")).otherwise(F.raise_error(F.concat(F.lit("Wrong vector size: "), size.cast("string"))).cast("array<float>"))
        if written := self._write(number, rows.withColumn("full_vector", right)):
            self._commit(number + 1, [*held, written])

    def _write(self, number: int, rows: DataFrame) -> dict | None:
        """A segment of points with distinct ids; None without points."""
        at = self._new(number)
        path = f"{self.path}/{at}"
        by = [c for c in ("doc_type", "doc_id") if c in rows.columns] or ["id"]
        rows.repartitionByRange(*by).sortWithinPartitions(*by).write.parquet(f"{path}/points")
        rows = self.spark.read.schema(rows.schema).parquet(f"{path}/points")
        kept = [c for c in FILTERS[1:] if c in rows.columns]
        sums = [x for c in kept for x in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
        sums += [F.collect_set("doc_type").alias("doc_types")] if "doc_type" in rows.columns else []
        file = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file")
        rows.groupBy(file).agg(F.count(F.lit(1)).alias("rows"), *sums).coalesce(1).write.parquet(f"{path}/stats")  # a row for each file
        n = self.spark.read.parquet(f"{path}/stats").agg(F.sum("rows")).first()[0] or 0
        if not n:
            self._fs.delete(self._Path(path), True)
            return None
        rows.select("id").write.parquet(f"{path}/ids")
        posted = rows.select("id", F.explode(words("text")).alias("word")) if "text" in rows.columns else rows.select("id", F.lit("").alias("word")).limit(0)
        posted.repartitionByRange("word", "id").sortWithinPartitions("word", "id").write.parquet(f"{path}/postings")
        return {"at": at, "rows": n, "gone": False}

    def _settle(self) -> None:
        held = self._held()[1]
        if len(held) > COMPACT_SEGMENTS or sum(s["rows"] for s in held[1:]) > self.compact_share * held[0]["rows"]:
            self.compact()
        else:
            self._clean()

    def _clean(self) -> None:
        names = self._manifests()[-2:]
        used = {s["at"] for n in names for s in self._manifest(n)}
        newest = names[-1] if names else ""
        for s in self._fs.listStatus(self._Path(self.path)):
            v = s.getPath().getName()
            if v.startswith("s0") and v not in used and v[1:9] < newest:
                self._fs.delete(s.getPath(), True)

    def reset(self, force: bool = False) -> None:
        """Drops and makes the collection anew; one with points only with force."""
        if self.exists():
            if not force and self.count():
                raise ValueError("the collection has points; reset it with force=True")
            self._fs.delete(self._Path(self.path), True)
        self.create()
