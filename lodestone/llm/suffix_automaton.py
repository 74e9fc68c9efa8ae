"""A generalised suffix automaton: the substrings of many sequences, by states."""

from __future__ import annotations

from collections.abc import Hashable


class SuffixAutomaton:
    """State 0 is the empty string. nxt, link and length are those of the states: where a symbol
    leads, the state of the longest suffix that ends at more places, and the longest string.

    A string that begins a sequence is the longest one of its state, whatever is added later:
    no other string ends at its place.
    """

    def __init__(self) -> None:
        self.nxt: list[dict[Hashable, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _new(self, length: int, nxt: dict[Hashable, int], link: int) -> int:
        self.nxt.append(nxt)
        self.length.append(length)
        self.link.append(link)
        return len(self.nxt) - 1

    def _split(self, p: int, w: Hashable, q: int) -> int:
        """The state of the strings of q that p and w make; q keeps the longer ones."""
        copy = self._new(self.length[p] + 1, dict(self.nxt[q]), self.link[q])
        self.link[q] = copy
        while p >= 0 and self.nxt[p].get(w) == q:
            self.nxt[p][w] = copy
            p = self.link[p]
        return copy

    def add(self, last: int, w: Hashable) -> int:
        """The state of a sequence that goes on by w; last is that of the sequence so far."""
        if (q := self.nxt[last].get(w)) is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, w, q)
        new, p = self._new(self.length[last] + 1, {}, 0), last
        while p >= 0 and w not in self.nxt[p]:
            self.nxt[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.nxt[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, w, q)
        return new
