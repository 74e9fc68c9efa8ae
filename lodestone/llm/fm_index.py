"""A compressed FM-index over word symbols: Burrows-Wheeler transform in a wavelet matrix."""

from __future__ import annotations

import numpy as np

from lodestone.llm.suffix import doubled


class Bits:
    """A packed bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        n = len(bits) // 64 + 1
        raw = np.zeros(n * 64, bool)
        raw[: len(bits)] = bits
        self.words = np.packbits(raw, bitorder="little").view(np.uint64)
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words[:-1]), dtype=np.int64))).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        w = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[w] + np.bitwise_count(self.words[w] & mask)


class WaveletMatrix:
    """Symbols below `sigma` in bit vectors, the highest bit first; of rank only."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.depth = max(1, int(sigma - 1).bit_length())
        self.levels: list[Bits] = []
        self.zeros: list[int] = []
        s = symbols.astype(np.int32)
        for k in range(self.depth - 1, -1, -1):
            bit = ((s >> k) & 1).astype(bool)
            self.levels.append(Bits(bit))
            self.zeros.append(int(len(s) - bit.sum()))
            s = np.concatenate((s[~bit], s[bit]))
        # where each symbol's run begins below the last level
        self.begin = np.searchsorted(_reversed_bits(s, self.depth), _reversed_bits(np.arange(sigma), self.depth))

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        for k, (bits, zeros) in enumerate(zip(self.levels, self.zeros)):
            ones = bits.rank(at)
            at = np.where((symbol >> (self.depth - 1 - k)) & 1, zeros + ones, at - ones)
        return at - self.begin[symbol]


def _reversed_bits(x: np.ndarray, depth: int) -> np.ndarray:
    """The order below the last level: by the lowest bit first."""
    out = np.zeros_like(x)
    for k in range(depth):
        out |= ((x >> k) & 1) << (depth - 1 - k)
    return out


class FMIndex:
    """An index of texts (runs of 64-bit word hashes) with a number each.

    For every window of `width` words of a streamed text it gives the smallest number of
    a text that holds that window. Suffixes are sorted by `width` words at least, which
    is as far as any interval that is asked for reaches.
    """

    def __init__(self, words: np.ndarray, firsts: np.ndarray, number: np.ndarray, width: int):
        self.width = width
        self.alphabet, coded = np.unique(words, return_inverse=True)
        sizes = np.diff(firsts)
        n = len(words) + len(sizes)
        who = np.repeat(np.arange(len(sizes)), sizes + 1)
        text = np.zeros(n, np.int64)  # 0 ends a text
        text[np.arange(len(words)) + np.repeat(np.arange(len(sizes)), sizes)] = coded + 1
        ends = np.cumsum(sizes + 1)[who]
        # two suffixes share w symbols, h <= w <= 2 h, if they share h, and h from w - h on
        h = 1 << max(0, (width - 1).bit_length() - 1)
        for k, (order, rank) in enumerate(doubled((text,), ends, width)):
            if 1 << k <= h:
                held = rank
        del rank

        def cut(w: int) -> np.ndarray:
            """Where suffixes with other first w symbols begin."""
            a, b = order[:-1].astype(np.int64), order[1:].astype(np.int64)
            same = held[a] == held[b]
            d = w - h
            same &= (a + d < ends[a]) & (b + d < ends[b])
            a, b = np.minimum(a + d, n - 1), np.minimum(b + d, n - 1)
            same &= held[a] == held[b]
            return np.concatenate(([True], ~same))[:n]

        self.sigma = len(self.alphabet) + 1
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=self.sigma))))
        self.bwt = WaveletMatrix(text[order - 1], self.sigma)
        # runs of suffixes with the same first `width` words: their smallest number
        first = cut(width)
        self.run = np.cumsum(first, dtype=np.int32) - 1
        self.smallest = np.minimum.reduceat(number[who[order]], np.flatnonzero(first)) if n else number[:0]
        # those with one word less: where they begin and end
        first = cut(width - 1)
        self.wide = np.cumsum(first, dtype=np.int32) - 1
        self.wide_begin = np.flatnonzero(first)
        self.wide_end = np.append(self.wide_begin[1:], n)

    def code(self, words: np.ndarray) -> np.ndarray:
        """Symbols of words; -1 for those that the index has not."""
        at = np.minimum(np.searchsorted(self.alphabet, words), max(len(self.alphabet) - 1, 0))
        return np.where(self.alphabet[at] == words, at + 1, -1) if len(self.alphabet) else np.full(len(words), -1)

    def matches(self, words: np.ndarray, firsts: np.ndarray, none: int) -> np.ndarray:
        """For each word of the streamed texts, the smallest number of a text that holds
        the window that starts there; `none` where no text does or no window starts.

        Backward search goes through all texts together, one word to the left each step.
        An interval's match grows by one word; at `width` words its window is met, and it
        is widened to all suffixes with the same first `width - 1`. Where it would be empty, the match starts
        anew with the word alone: shorter matches cannot become windows before they
        reach `width` again, and are searched anew by `_restart`.
        """
        out = np.full(len(words), none, np.int64)
        sizes = np.diff(firsts)
        order = np.argsort(-sizes, kind="stable")
        sizes, ends = sizes[order], firsts[1:][order]
        sym = self.code(words)
        n = len(sizes)
        lo, hi, length = np.zeros(n, np.int64), np.full(n, self.less[-1]), np.zeros(n, np.int64)
        live = n
        for t in range(int(sizes[0]) if n else 0):
            while live and sizes[live - 1] <= t:
                live -= 1
            at = ends[:live] - 1 - t
            lo_, hi_ = self._back(sym[at], lo[:live], hi[:live])
            grown = lo_ < hi_
            length[:live] = np.where(grown, length[:live] + 1, 0)
            if not grown.all():
                for i in np.flatnonzero(~grown):
                    lo_[i], hi_[i], length[i] = self._restart(sym, int(at[i]), int(ends[i]))
            full = np.flatnonzero(length[:live] >= self.width)
            out[at[full]] = self.smallest[self.run[lo_[full]]]
            r = self.wide[lo_[full]]
            lo_[full], hi_[full], length[full] = self.wide_begin[r], self.wide_end[r], self.width - 1
            lo[:live], hi[:live] = lo_, hi_
        return out

    def _back(self, sym: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the suffixes that put a symbol before those of an interval."""
        s = np.maximum(sym, 0)
        both = self.bwt.rank(np.concatenate((s, s)), np.concatenate((lo, hi))) + np.tile(self.less[s], 2)
        m = len(sym)
        return np.where(sym > 0, both[:m], 0), np.where(sym > 0, both[m:], 0)

    def _restart(self, sym: np.ndarray, at: int, end: int) -> tuple[int, int, int]:
        """The longest match that begins at a word, of fewer than `width` words: its interval and length."""
        a, b = 0, min(self.width - 1, end - at)
        best = (0, int(self.less[-1]), 0)
        while a < b:  # a longer match holds every shorter one
            m = (a + b + 1) // 2
            lo, hi = np.zeros(1, np.int64), np.full(1, self.less[-1])
            for k in range(at + m - 1, at - 1, -1):
                lo, hi = self._back(sym[k : k + 1], lo, hi)
                if lo[0] >= hi[0]:
                    break
            if lo[0] < hi[0]:
                a, best = m, (int(lo[0]), int(hi[0]), m)
            else:
                b = m - 1
        return best
