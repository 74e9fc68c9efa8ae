"""Byte-level BPE by dynamic programming over prefixes.

For every prefix of a piece of text exactly one token can come last in its encoding.
A suffix automaton of the vocabulary's byte strings follows the text and holds, at each place,
the state of the longest match that ends there; the tokens that end there are the states on
its path of suffix links whose longest string is a token. The one kept is that which the last token
of the prefix before it may precede (`Vocabulary.fits`). Following the kept tokens back from the end gives the ids.
No list of merges is applied to the text.

Two neighbours fit when no merge ever joins bytes of both. Each token is the last of a
chain of merges along its edge; walking the right edge of the left token and the left
edge of the right one in the order of their merges, they fit if no merge across comes
before both edges' next one.

Pieces are the vocabulary's own: special tokens first, then the byte-level pattern.
The new pieces of a slice of texts are encoded in sorted order, so that a prefix that several
of them share is worked out once. Encoded pieces of at most 64 characters are kept; beyond
`CACHE_PIECES` of them those of the last slice, up to half as many, stay.

Null and empty texts give no ids and decode to the empty text. Texts of any length are
encoded whole. Repeated rows are encoded row by row; other columns are ignored; an
empty table gives an empty result.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import accumulate, chain, islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.shared import kept, mapped
from lodestone.llm.suffix_automaton import SuffixAutomaton

CACHE_PIECES, CACHE_PAIRS = 100_000, 100_000
#: Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable Latin-1 bytes
    for themselves, the others from U+0100 on in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = (b for b in range(256) if b not in own)
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE vocabulary file, ready to encode and decode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, letters = spec["model"], byte_letters()
        if model.get("byte_fallback") or model.get("dropout") or spec.get("normalizer"):
            raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
        self.special = {x["content"]: x["id"] for x in spec["added_tokens"]}
        vocab, never = model["vocab"], len(model["merges"])
        top = 1 + max(chain(vocab.values(), self.special.values()), default=0)
        #: of a token: the halves of the merge that makes it (-1: none), and that merge's rank
        self.halves, self.up = (array("i", [-1]) * top, array("i", [-1]) * top), array("i", [never]) * top
        pairs = array("q")
        for k, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            x, y, made = vocab[a], vocab[b], vocab[a + b]
            pairs.append(x << 20 | y)
            if self.halves[0][made] < 0:
                self.halves[0][made], self.halves[1][made], self.up[made] = x, y, k
        raw = sorted((bytes(letters[c] for c in t), i) for t, i in vocab.items())
        sizes, ids, flat = array("i", (len(t) for t, _ in raw)), array("i", (i for _, i in raw)), b"".join(t for t, _ in raw)
        # what is read and the states as they are built go before what stays is made, which else lies scattered among them
        del spec, model, vocab, raw
        ends = list(accumulate(sizes))
        tokens = [(flat[z - n : z], i) for z, n, i in zip(ends, sizes, ids)]
        self._automaton([(t, i) for t, i in tokens if len(t) == 1 or self.halves[0][i] >= 0])
        self.never = never
        self.rank: dict[int, int] = {}
        for k, pair in enumerate(pairs):
            self.rank.setdefault(pair, k)
        self.bytes_of: list[bytes] = [b""] * top
        for t, i in chain(tokens, ((t.encode(), i) for t, i in self.special.items())):
            self.bytes_of[i] = t
        self.size = array("i", map(len, self.bytes_of))
        self.special_ids = {t: array("i", [i]).tobytes() for t, i in self.special.items()}
        self.forget()
        self.pattern = regex.compile(PATTERN)
        self.cut = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None

    def forget(self) -> None:
        """Drops what earlier texts have left: encoded pieces, edges and which tokens fit."""
        self.edges: tuple[dict[int, list], dict[int, list]] = ({}, {})
        self.fit: dict[int, bool] = {}
        self.cache: dict[str, bytes] = dict(self.special_ids)

    def _automaton(self, tokens: list[tuple[bytes, int]]) -> None:
        """Of tokens, sorted. step: where a state (shifted by 8 bits) and a byte lead; length and link of the states;
        ends: of a state, the tokens on its path of links, the longest first, as nested (id, bytes, rest)."""
        auto = SuffixAutomaton()
        path, before = [0], b""
        for t, _ in tokens:
            # states of what it shares with the one before stay as they are
            k = 0
            while k < len(before) and k < len(t) and before[k] == t[k]:
                k += 1
            del path[k + 1 :]
            for c in t[k:]:
                path.append(auto.add(path[-1], c))
            before = t
        keys = array("q", (s << 8 | c for s, out in enumerate(auto.nxt) for c in out))
        leads = array("i", chain.from_iterable(out.values() for out in auto.nxt))
        length, link = array("i", auto.length), array("i", auto.link)
        del auto, path
        self.length, self.link, self.step = list(length), list(link), dict(zip(keys, leads))
        of: dict[int, tuple[int, int]] = {}
        for t, i in tokens:
            s = 0
            for c in t:
                s = self.step[s << 8 | c]
            of[s] = (i, len(t))
        self.ends: list[tuple | None] = [None] * len(self.length)
        for s in np.argsort(self.length, kind="stable").tolist()[1:]:
            rest = self.ends[self.link[s]]
            self.ends[s] = (*of[s], rest) if s in of else rest

    def edge(self, t: int, right: int) -> list[tuple[int, int]]:
        """(token, rank of the merge that takes it up) along an edge of t, from the byte up."""
        if (e := self.edges[right].get(t)) is None:
            e, at, up = [], t, self.never
            while True:
                e.append((at, up))
                if self.halves[0][at] < 0:
                    break
                at, up = self.halves[right][at], self.up[at]
            e.reverse()
            self.edges[right][t] = e
        return e

    def fits(self, a: int, b: int) -> bool:
        """Whether tokens a and b can stand side by side in an encoding. Of two equal
        merges that overlap, the left one comes first."""
        left, right, rank, never = self.edge(a, 1), self.edge(b, 0), self.rank, self.never
        i = j = 0
        while True:
            (x, up_x), (y, up_y) = left[i], right[j]
            m = rank.get(x << 20 | y, never)
            if m < never and m < up_x and m <= up_y:
                ok = False
                break
            if up_x == never and up_y == never:
                ok = True
                break
            if up_x <= up_y:
                i += 1
            else:
                j += 1
        if len(self.fit) < CACHE_PAIRS:
            self.fit[a << 20 | b] = ok
        return ok

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text, special tokens among them: no other piece holds one."""
        find = self.pattern.findall
        if self.cut is None or not self.cut.search(text):
            return find(text)
        out, z = [], 0
        for m in self.cut.finditer(text):
            out += find(text[z : m.start()])
            out.append(m[0])
            z = m.end()
        return out + find(text[z:])

    def learn(self, pieces: Iterable[str]) -> Iterator[tuple[str, bytes]]:
        """Pieces, sorted, with their ids as int32 bytes. What is stored for the prefixes that a
        piece shares with the one before it stands."""
        get, fits, step, longest, link, ends = self.fit.get, self.fits, self.step, self.length, self.link, self.ends
        size, before = self.size, b""
        # of each prefix: its last token, and the longest match that ends there
        last, states, matches = [-1], [0], [0]
        for text in sorted(pieces):
            s, k = text.encode(), 0
            for x, y in zip(s, before):
                if x != y:
                    break
                k += 1
            del last[k + 1 :], states[k + 1 :], matches[k + 1 :]
            state, match, end, before = states[k], matches[k], k, s
            for c in s[k:]:
                end += 1
                while (to := step.get(state << 8 | c)) is None:
                    state = link[state]
                    match = longest[state]
                state, match = to, match + 1
                # a match that is not its state's longest string is no token itself
                found = ends[state] if match == longest[state] else ends[link[state]]
                while True:
                    t, length, found = found
                    if length == end:
                        break
                    a = last[end - length]
                    ok = get(a << 20 | t)
                    if fits(a, t) if ok is None else ok:
                        break
                last.append(t)
                states.append(state)
                matches.append(match)
            ids, at = array("i"), end
            while at:
                ids.append(last[at])
                at -= size[last[at]]
            ids.reverse()
            yield text, ids.tobytes()

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as int32."""
        parts = [self.pieces(t) for t in texts]
        used, cache = set(chain.from_iterable(parts)), self.cache
        cache.update(self.learn(used.difference(cache)))
        get = cache.__getitem__
        out = [np.frombuffer(b"".join(map(get, p)), np.int32) for p in parts]
        for p in used:
            if len(p) > 64:
                del cache[p]
        if len(cache) > CACHE_PIECES:  # those in use stay
            cache = {p: cache[p] for p in islice((p for p in used if p in cache), CACHE_PIECES // 2)}
            self.cache = cache
        cache.update(self.special_ids)  # whatever their length
        return out

    def encode(self, text: str) -> np.ndarray:
        """The ids of a text, as int32."""
        return self.encode_all([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids; bytes that are not UTF-8 become U+FFFD."""
        return b"".join(map(self.bytes_of.__getitem__, ids.tolist())).decode("utf-8", "replace")


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a file, read once in a process as long as no task of another kind comes."""
    return kept(path, lambda: Vocabulary(path))


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids array<int>, decoded string (the text that the ids give back)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in batches:
            texts, i = b.column(1), 0
            while i < len(texts):
                held, j, size = [], i, 0
                while j < len(texts) and size < 1 << 20:
                    held.append(texts[j].as_py() or "")
                    size += len(held[-1])
                    j += 1
                ids = v.encode_all(held)
                decoded = [v.decode(x) for x in ids]
                offs = np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int32)
                flat = pa.array(np.concatenate(ids), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.ListArray.from_arrays(pa.array(offs), flat), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])
                i = j
        v.forget()  # a worker waits beside those of other tasks

    return mapped(docs.select("doc_id", "text"), run, "doc_id long, ids array<int>, decoded string", keeps=path)


def digests(tokens: DataFrame) -> DataFrame:
    """Sizes and digests of what `encoded` gives."""
    return tokens.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def default_path() -> str:
    """The byte-level vocabulary among the installed public ones."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_path()))
