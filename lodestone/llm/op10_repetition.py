"""Quality rules from repetition, by suffix arrays.

Each text's words get a suffix array (prefix doubling over a whole batch of texts; a
suffix ends with its text). The longest common prefix of a suffix with its two
neighbours in that order is the depth of the deepest LCP interval that holds it: the
longest substring that starts there and occurs again. The spans of the maximal repeats
of `min_repeat` words or more are united; a text fails when they cover more than
`max_covered` of its words, or when the longest of them is over `max_longest` of them.

Every word of such a repeat also counts for the base rule, which bears up to half of a
text. The limits are far below that, so that long repeats fail a text whose short ones do
not. Web corpora commonly drop texts of which copies of ten-word runs make up a tenth; as
all copies are counted here, the first too, that is a fifth. A single passage copied once
covers twice its length and fails from 8 %, sooner than scattered formulas do.

Null, empty and blank texts have no words: all counts are 0, base_failed is true (fewer
than 50 words) and kept is false. Repeated rows and ids are judged row by row. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lodestone.llm import textvec as tv
from lodestone.llm.suffix import adjacent_lcp, suffix_ranks
from lodestone.llm.shared import mapped

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long"
)
SYMBOLS = tv.byte_table(b"#*$%&|<>")
NOT_NEWLINE = ~tv.byte_table(b"\n")


def neighbour_lcp(sym: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """For each place, the longest prefix of its suffix that also starts elsewhere in
    the same string: the greater LCP with a neighbour in the suffix array."""
    n = len(sym)
    best = np.zeros(n, np.int64)
    if n < 2:
        return best
    ends = np.repeat(firsts[1:], np.diff(firsts))
    order, levels = suffix_ranks((sym, tv.owner(firsts, n)), ends)
    lcp = adjacent_lcp(order, levels, ends)
    best[order[1:]] = lcp
    best[order[:-1]] = np.maximum(best[order[:-1]], lcp)
    return best


def measure(data: np.ndarray, offs: np.ndarray, min_repeat: int) -> dict[str, np.ndarray]:
    """The counts of a slice of texts."""
    starts, ends, firsts = tv.spans(data, offs, tv.NOT_SPACE)
    n = len(starts)
    sym = tv.hash_spans(data, starts, ends)
    out = {"n_words": np.diff(firsts)}
    # a code point is a byte that does not continue another
    lead = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    out["word_chars"] = tv.per_text(lead[ends] - lead[starts], firsts)
    c = np.concatenate(([0], np.cumsum(SYMBOLS[data])))
    out["n_symbols"] = c[offs[1:]] - c[offs[:-1]]
    out["n_dup_lines"] = dup_lines(data, offs, starts)
    best = neighbour_lcp(sym, firsts)
    at = np.flatnonzero(best >= 3)
    out["n_repeat_words"] = tv.per_text(tv.covered(n, at, at + 3), firsts)
    at = np.flatnonzero(best >= min_repeat)
    out["covered_words"] = tv.per_text(tv.covered(n, at, at + best[at]), firsts)
    top = np.zeros(len(offs) - 1, np.int64)
    np.maximum.at(top, tv.owner(firsts, n), best)
    out["longest_repeat"] = top
    return out


def dup_lines(data: np.ndarray, offs: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Lines that hold a word and equal an earlier line of their text."""
    starts, ends, firsts = tv.spans(data, offs, NOT_NEWLINE)
    has = np.searchsorted(word_starts, ends) > np.searchsorted(word_starts, starts)
    h, who = tv.hash_spans(data, starts, ends)[has], tv.owner(firsts, len(starts))[has]
    order = np.lexsort((h, who))
    same = np.zeros(len(h), bool)
    same[1:] = (h[order][1:] == h[order][:-1]) & (who[order][1:] == who[order][:-1])
    return np.bincount(who[order][same], minlength=len(offs) - 1).astype(np.int64)


def repetition(docs: DataFrame, min_repeat: int = 10, max_covered: float = 0.2, max_longest: float = 0.08) -> DataFrame:
    """One row per document with its counts and verdict (see the module's text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            for i, j, data, offs in tv.text_slices(b.column(1)):
                m = measure(data, offs, min_repeat)
                n, words = m["n_words"], np.maximum(m["n_words"], 1)
                m["base_failed"] = (n < 50) | (100 * m["n_repeat_words"] > 50 * n)
                long = (m["longest_repeat"] >= min_repeat) & (m["longest_repeat"] > max_longest * words)
                m["kept"] = ~m["base_failed"] & (m["covered_words"] <= max_covered * words) & ~long
                cols = [b.column(0).slice(i, j - i), *(pa.array(m[x]) for x in names[1:])]
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return mapped(docs.select("doc_id", "text"), run, SCHEMA)


def op10_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(spark.read.parquet(f"{sf_dir}/documents.parquet"))
