"""Gibbs sampling of Chinese-restaurant seatings, many restaurants at once."""

from __future__ import annotations

import numpy as np

#: Tables drawn at a time for a customer that joins one.
TRIES = 8
ONE = np.int32(1)


def seat(context: np.ndarray, dish: np.ndarray, count: np.ndarray, discount: float, strength: float, copies: np.ndarray, burn: int, draws: int, seed: int) -> np.ndarray:
    """The tables of each (context, dish) pair in each of `draws` Gibbs samples, one row each
    (one row of one table a pair where there are none).

    context, dish: codes from 0; count: customers of each pair, 1 or more. copies: for each
    context, over how many parts its restaurant is dealt (this is one of them).
    Customers of a pair all eat its dish, so a customer that is seated anew joins a table
    of the pair with mass (size - discount), or opens one with mass
    (strength + discount * tables of the restaurant) * parent's probability of the dish.
    The parent is the restaurant of all tables of these contexts, whose probabilities
    change with the tables. A pair with one customer has one table. In a sweep each
    customer is seated anew; those of a large pair in 64 parts, a part's at one time.
    """
    drawn = np.ones((max(1, draws), len(count)), np.int64)
    at = np.flatnonzero(count > 1)
    if not len(at) or not draws:
        return drawn
    rng = np.random.default_rng(seed)
    c = count[at]
    first = np.concatenate(([0], np.cumsum(c)))
    n = int(first[-1])
    first = first.astype(np.int32 if n < 1 << 31 else np.int64)
    pair = np.repeat(np.arange(len(at)), c)
    table = first[pair]  # all at their pair's first table
    size = np.zeros(n, np.int32)
    size[first[:-1]] = c
    tables = np.ones(len(at))
    of_context = np.bincount(context).astype(float)
    of_dish = np.bincount(dish).astype(float)
    u, w = context[at], dish[at]
    c = c.astype(float)
    total = float(len(count))
    kinds = max(1, len(of_dish))
    # a customer's turn in a sweep: pairs of up to 64 customers one at a time
    turn = (np.arange(n) - first[pair]) * np.minimum(64, count[at])[pair] // count[at][pair]
    order = np.argsort(turn.astype(np.int8), kind="stable").astype(first.dtype)
    cuts = np.concatenate(([0], np.cumsum(np.bincount(turn, minlength=64))))
    mark = np.zeros(n, np.int32)

    def one_each(keys: np.ndarray) -> np.ndarray:
        """Places of one entry of each value."""
        here = np.arange(len(keys), dtype=np.int32)
        mark[keys] = here
        return np.flatnonzero(mark[keys] == here)

    def move(where: np.ndarray, by: float) -> None:
        """Opens or closes one table for each entry: pairs of the tables."""
        np.add.at(tables, where, by)
        np.add.at(of_context, u[where], by)
        np.add.at(of_dish, w[where], by)

    for sweep in range(burn + draws):
        for a, z in zip(cuts[:-1], cuts[1:]):
            i = order[a:z]
            if not len(i):
                break
            p, t = pair[i], table[i].astype(np.intp)
            np.subtract.at(size, t, ONE)
            left = t[size[t] == 0]
            left = left[one_each(left)]
            move(pair[left], -1.0)
            total -= len(left)
            share = np.bincount(p)[p]
            old = np.maximum(c[p] - share - discount * tables[p], 0.0)
            base = (np.maximum(of_dish[w[p]] - discount, 0.0) + (strength + discount * kinds) / kinds) / (strength + total)
            context_ = u[p]
            new = (strength + discount * of_context[context_] * copies[context_]) * base
            opens = rng.random(len(i)) * (old + new) >= old
            # a table in proportion to size - discount: that of another customer, kept or drawn again
            join = i[~opens]
            todo, tries = np.arange(len(join)), 1
            got = np.empty(len(join), np.intp)
            q = p[~opens]
            while len(todo):
                k = table[first[q][:, None] + (rng.random((len(todo), tries)) * c[q][:, None]).astype(first.dtype)]
                held = size[k]
                ok = rng.random(k.shape, np.float32) * held < held - discount
                found = ok.any(axis=1)
                got[todo[found]] = k[found, ok[found].argmax(axis=1)]
                todo, q, tries = todo[~found], q[~found], TRIES
            table[join] = got
            np.add.at(size, got, ONE)
            # a free place of the pair for each table that is opened: that just left, the
            # customer's own, or any
            todo, k, q = i[opens], t[opens], p[opens]
            k = np.where(size[k] == 0, k, todo)[:, None]
            while len(todo):
                free = size[k] == 0
                some = np.flatnonzero(free.any(axis=1))
                k = k[some, free[some].argmax(axis=1)]
                one = one_each(k)
                k, done = k[one], some[one]
                table[todo[done]] = k
                size[k] = 1
                move(q[done], 1.0)
                total += len(done)
                rest = np.ones(len(todo), bool)
                rest[done] = False
                todo, q = todo[rest], q[rest]
                k = first[q][:, None] + (rng.random((len(todo), TRIES)) * c[q][:, None]).astype(first.dtype)
        if sweep >= burn:
            drawn[sweep - burn, at] = tables
    return drawn
