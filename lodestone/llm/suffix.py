"""Suffix arrays of many symbol strings at once, by prefix doubling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np


def doubled(keys: tuple[np.ndarray, ...], ends: np.ndarray, depth: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The suffix array so far and the rank of every suffix by its first 2^k symbols, for
    k = 0, 1, ... The array is sorted further in place; each rank array (32 bits) is a new one.

    keys: what a symbol is compared by, the most important last (as for np.lexsort);
    ends: for each place, the end of its string, beyond which a suffix has nothing.
    depth: symbols after which suffixes may stay in any order; none: they are all ordered,
    but equal suffixes of two strings, which need keys that tell the strings apart.
    """
    n = len(ends)
    order = np.lexsort(keys).astype(np.int32)
    new = np.zeros(n, bool)
    new[:1] = True
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    # the rank of a class is the place of its first member, so it stays while others split
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n, dtype=np.int32), 0))
    h = 1
    yield order, rank
    while depth is None or h < depth:
        open_ = ~new
        open_[:-1] |= ~new[1:]
        at = np.flatnonzero(open_).astype(np.int32)
        if not len(at):
            break
        ids = order[at]
        nxt = ids + h
        second = np.where(nxt < ends[ids], rank[np.minimum(nxt, n - 1)] + 1, 0)
        key = rank[ids].astype(np.int64) * (n + 2) + second
        re = np.argsort(key, kind="stable")
        ids, key = ids[re], key[re]
        del re, second, nxt
        order[at] = ids
        split = np.ones(len(ids), bool)
        split[1:] = key[1:] != key[:-1]
        new[at] = split
        rank = rank.copy()
        rank[ids] = np.maximum.accumulate(np.where(split, at, 0))
        h *= 2
        yield order, rank


def suffix_ranks(keys: tuple[np.ndarray, ...], ends: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array, and the ranks of all of its levels: 4 bytes for each symbol and level."""
    order, levels = np.zeros(0, np.int32), []
    for order, rank in doubled(keys, ends):
        levels.append(rank)
    return order, levels


def adjacent_lcp(order: np.ndarray, levels: list[np.ndarray], ends: np.ndarray) -> np.ndarray:
    """The longest common prefix of each suffix and the next in the array, as far as
    the levels tell."""
    n = len(order)
    if n < 2:
        return np.zeros(0, np.int64)
    a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
    ea, eb = ends[a], ends[b]
    lcp = np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        live = np.flatnonzero((a < ea) & (b < eb))
        live = live[levels[k][a[live]] == levels[k][b[live]]]
        lcp[live] += 1 << k
        a[live] += 1 << k
        b[live] += 1 << k
    return lcp
