"""Programs: chunk files to JSON, build the index, search it, reset it.

    python -m lodestone.plans.cli chunk FILE... [-o OUT] [-p] [-q]
    python -m lodestone.plans.cli process [DIRECTORY]
    python -m lodestone.plans.cli search [QUERY] [-m MODE] [-n LIMIT]     without a query: asks for them in turn
    python -m lodestone.plans.cli reset [--force]
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.config import Config
from lodestone.functions import text as T
from lodestone.operators.documents import chunk_files, run_summary
from lodestone.operators.embed import HashingProvider, Provider, embed_chunks, total_tokens
from lodestone.operators.index import Collection, embedded, points
from lodestone.operators.search import display, hybrid_lists, parse_limit, search
from lodestone.sources.files import read_directory, read_files
from lodestone.sources.sinks import json_array, write_json_array

VERSION = "1.0.0"


def chunk(spark: SparkSession, files: list[str], output: str | None = None, pretty: bool = False, quiet: bool = False) -> int:
    """Chunks of the files as a JSON array, to a file or printed; 1 if any file failed. The array has the order of
    the arguments, which tasks read in turn, and a file that is given twice comes twice."""
    log = (lambda *_: None) if quiet else lambda *x: print(*x, file=sys.stderr)
    rows = chunk_files(read_files(spark, files)).persist()
    try:
        good = rows.where("error is null")
        if output:
            write_json_array(good, output, pretty)
        else:
            for piece in json_array(good.toLocalIterator(), pretty):
                sys.stdout.write(piece)
            print()
        per_file = rows.groupBy("source_path").agg(F.count("id").alias("n"), F.max("error").alias("error"), F.max("elapsed_ms").alias("ms"))
        of = {r["source_path"]: r for r in per_file.collect()}  # a row for each argument
    finally:
        rows.unpersist()
    told = [(f, of[os.path.abspath(f)]) for f in files]
    for f, r in told:
        log(f"{f}: {r['ms']} ms")
    bad = [r for _, r in told if r["error"] is not None]
    for r in bad:
        log(f"{r['source_path']}: {r['error']}")
    log(f"Processed {len(told) - len(bad)}/{len(told)} files, {sum(r['n'] for r in of.values())} chunks, {len(bad)} errors")
    return 1 if bad else 0


def process(spark: SparkSession, root: str, config: Config, provider: Provider | None = None) -> dict:
    """Chunks, embeds and upserts a directory: each file is parsed once, and failed files
    are counted and do not stop the rest."""
    provider = provider or HashingProvider(config.dimensions)
    index = Collection(spark, config.index_dir, config.collection, config.dimensions)
    index.create()
    chunks = chunk_files(read_directory(spark, root)).persist()
    try:
        counts = run_summary(chunks).first().asDict()
        good = chunks.where("error is null").drop("error", "elapsed_ms")
        if counts["chunks"]:
            counts["tokens"] = good.agg(total_tokens()).first()[0]
            counts["cost"] = spark.range(1).select(T.embedding_cost(F.lit(counts["chunks"]))).first()[0]
            vectors = embed_chunks(good, provider, config.embedding_batch_size, config.max_retries)
            index.upsert(points(embedded(good, vectors)))
        counts["points"] = index.count()
        return counts
    finally:
        chunks.unpersist()


def filters(given: list[str]) -> dict[str, list[object]]:
    """Values by name of `name=value` arguments; several of one name are alternatives."""
    out: dict[str, list[object]] = {}
    for name, _, value in (x.partition("=") for x in given):
        out.setdefault(name, []).append(value.lower() == "true" if name.startswith("is_") else value)
    return out


def show(held: DataFrame, query: str, provider: Provider, mode: str, limit: str | int | None) -> None:
    """Prints what a search finds; of a hybrid one also the heads of the two lists that it fuses."""
    hybrid = mode not in ("vector", "text")
    if hybrid and query.strip():
        print("\n".join(hybrid_lists(held, query, provider.embed([query])[0].tolist(), max(parse_limit(limit), 0))))
    for r in display(search(held, query, provider, mode, limit), 150 if hybrid else 200).collect():
        print(r.asDict())


def ask(held: DataFrame, provider: Provider, read: Callable[[str], str] | None = None) -> None:
    """Searches for what is typed, each with its own limit and mode, until exit, quit or the end of the input. A
    search that fails is told and does not end the rest."""
    read = read or input
    print("Search modes: vector, text, hybrid (default); exit ends")
    try:
        while (query := read("Search query: ")).lower() not in ("exit", "quit"):
            try:
                if not query.strip():
                    print("Please enter a query.")
                    continue
                limit = read("Number of results (default: 5): ")
                show(held, query, provider, read("Search mode [vector/text/hybrid] (default: hybrid): ").lower() or "hybrid", limit)
            except EOFError:
                raise
            except Exception as e:
                print(f"Search error: {e}", file=sys.stderr)
    except EOFError:
        print()
    print("Goodbye!")


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lodestone")
    p.add_argument("-V", "--version", action="version", version=VERSION)
    sub = p.add_subparsers(dest="command", required=True)
    c = sub.add_parser("chunk")
    c.add_argument("files", nargs="+")
    c.add_argument("-o", "--output")
    c.add_argument("-p", "--pretty", action="store_true")
    c.add_argument("-q", "--quiet", action="store_true")
    c = sub.add_parser("process")
    c.add_argument("directory", nargs="?")
    c = sub.add_parser("search")
    c.add_argument("query", nargs="?")
    c.add_argument("-m", "--mode", default="hybrid")
    c.add_argument("-n", "--limit", default="5")
    c.add_argument("-f", "--filter", action="append", default=[], metavar="NAME=VALUE")
    c = sub.add_parser("reset")
    c.add_argument("--force", action="store_true")
    a = p.parse_args(args)
    config = Config.from_env()
    spark = SparkSession.builder.appName("lodestone").getOrCreate()
    if a.command == "chunk":
        return chunk(spark, a.files, a.output, a.pretty, a.quiet)
    if a.command == "process":
        for k, v in process(spark, a.directory or config.samples_dir, config).items():
            print(f"{k}: {v}")
        return 0
    index = Collection(spark, config.index_dir, config.collection, config.dimensions)
    if a.command == "reset":
        index.reset(a.force)
        return 0
    held = index.read(filters(a.filter)) if index.exists() else None
    if held is None:
        print(f"No points in {config.collection}", file=sys.stderr)
        return 1
    provider = HashingProvider(config.dimensions)
    if a.query is None:
        ask(held, provider)
    else:
        show(held, a.query, provider, a.mode, a.limit)
    return 0


if __name__ == "__main__":
    sys.exit(main())
