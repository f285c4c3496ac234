"""A word-pair trie in Elias-Fano form, kept in one memory map.

Level 1 holds the contexts (64-bit word hashes, sorted), pointers say where each one's
successors begin. Level 2 holds the successors by their rank among the distinct ones of the
trie, sorted within their context, and a quantised log10 probability each. Contexts,
pointers, distinct successors and level 2 are monotone sequences: the low bits are packed,
the high bits stand in unary, and a directory counts one kind of bit up to every 64th.
"""

from __future__ import annotations

import mmap

import numpy as np

#: Codes 1..65535 stand for log10 values from FLOOR up to 0; 0 stands for "not there".
FLOOR, CODES = -16.0, 65534
#: Places looked up at a time: bounds the bits that are unpacked at once.
CHUNK = 1 << 17


def quantise(log10: np.ndarray) -> np.ndarray:
    return (1 + np.rint((1 - np.maximum(log10, FLOOR) / FLOOR) * CODES)).astype(np.uint16)


def dequantise(codes: np.ndarray) -> np.ndarray:
    return (1 - (codes.astype(np.float64) - 1) / CODES) * FLOOR


class Monotone:
    """A sorted sequence of ``n`` unsigned numbers, searched by their high bits.

    ``low``: ``bits`` low bits of each, packed. ``high``: number ``i`` is a one behind as many
    zeros as its high part says. A sequence that is searched counts the zeros in its
    directory, one that is read by place the ones.
    """

    def __init__(self, low: np.ndarray, high: np.ndarray, bits: int, n: int, searched: bool = True):
        self.low, self.high, self.bits, self.n, self.searched = low, high.reshape(-1, 8), bits, n, searched
        held = np.bitwise_count(high.view(np.uint64)).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(64 - held if searched else held)]).astype(np.uint32)

    @staticmethod
    def parts(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        n, top = len(values), int(values[-1]) if len(values) else 0
        bits = min(56, max(0, (top // max(n, 1)).bit_length() - 1))
        each = (values[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)
        low = np.packbits(each.astype(bool).ravel(), bitorder="little")
        rest = (values >> np.uint64(bits)).astype(np.int64)
        unary = np.zeros(-(-(n + (int(rest[-1]) if n else 0) + 1) // 64) * 64, bool)
        unary[rest + np.arange(n)] = True
        return np.pad(low, (0, 8 + -len(low) % 8)), np.packbits(unary, bitorder="little"), bits

    def select(self, k: np.ndarray) -> np.ndarray:
        """The place of the ``k``-th counted bit, from 0."""
        out = np.empty(len(k), np.int64)
        for x in range(0, len(k), CHUNK):
            own = k[x:x + CHUNK]
            word = np.searchsorted(self.before, own, "right") - 1
            bits = np.unpackbits(self.high[word], axis=1, bitorder="little")
            seen = np.cumsum(bits ^ 1 if self.searched else bits, axis=1, dtype=np.uint8)
            wanted = (own - self.before[word] + 1).astype(np.uint8)
            out[x:x + CHUNK] = word * 64 + np.argmax(seen == wanted[:, None], axis=1)
        return out

    def lows(self, at: np.ndarray) -> np.ndarray:
        bit = at * self.bits
        window = self.low[(bit >> 3)[:, None] + np.arange(8)].view("<u8").ravel()
        return (window >> (bit & 7).astype(np.uint64)) & np.uint64((1 << self.bits) - 1)

    def get(self, at: np.ndarray) -> np.ndarray:
        """The numbers at places ``at``, of a sequence that isn't searched."""
        return ((self.select(at) - at).astype(np.uint64) << np.uint64(self.bits)) | self.lows(at)

    def find(self, wanted: np.ndarray, start: np.ndarray | None = None, end: np.ndarray | None = None) -> np.ndarray:
        """The place of each wanted number, between ``start`` and ``end`` if given, or -1. Two
        looks at the directory bound the numbers of the same high part; their low bits are
        searched."""
        out = np.full(len(wanted), -1, np.int64)
        high = (wanted >> np.uint64(self.bits)).astype(np.int64)
        some = np.flatnonzero(high < len(self.high) * 64 - self.n)     # zeros there are
        if not self.n or not len(some):
            return out
        high, low = high[some], wanted[some] & np.uint64((1 << self.bits) - 1)
        hi = self.select(high) - high
        lo = np.where(high > 0, self.select(np.maximum(high - 1, 0)) - high + 1, 0)
        if start is not None:
            lo, hi = np.maximum(lo, start[some]), np.minimum(hi, end[some])
        last = hi.copy()
        while len(open_ := np.flatnonzero(lo < hi)):
            mid = (lo[open_] + hi[open_]) // 2
            below = self.lows(mid) < low[open_]
            lo[open_[below]] = mid[below] + 1
            hi[open_[~below]] = mid[~below]
        there = np.flatnonzero(lo < last)
        there = there[self.lows(lo[there]) == low[there]]
        out[some[there]] = lo[there]
        return out


class Trie:
    """Built from sorted contexts, their first successor's place and the sorted successors."""

    def __init__(self, contexts: np.ndarray, first: np.ndarray, successors: np.ndarray, log10: np.ndarray):
        names, rank = np.unique(successors.astype(np.uint64), return_inverse=True)
        self.names = len(names)
        of = np.repeat(np.arange(len(contexts), dtype=np.uint64), np.diff(first))
        level2 = of * np.uint64(self.names) + rank.astype(np.uint64)
        levels = [(values, *Monotone.parts(values)) for values in (contexts, first.astype(np.uint64), names, level2)]
        codes = quantise(log10).view(np.uint8)
        parts = [a for _, low, high, _ in levels for a in (low, high)] + [codes]
        self.map = mmap.mmap(-1, max(1, sum(len(a) for a in parts)))
        views, at = [], 0
        for a in parts:
            view = np.frombuffer(self.map, np.uint8, len(a), at)
            view[:] = a
            views.append(view)
            at += len(a)
        sequences = [Monotone(views[2 * i], views[2 * i + 1], bits, len(values), i != 1) for i, (values, _, _, bits) in enumerate(levels)]
        self.level1, self.pointers, self.successors, self.level2 = sequences
        self.codes = views[-1].view(np.uint16)
        #: All that is held, directories included.
        self.bytes = at + sum(m.before.nbytes for m in sequences)

    def context(self, hashes: np.ndarray) -> np.ndarray:
        """The place of each context, -1 where it is unknown."""
        return self.level1.find(hashes)

    def lookup(self, context: np.ndarray, successors: np.ndarray) -> np.ndarray:
        """Codes of successors within their contexts' ranges; 0 where there is none."""
        out = np.zeros(len(context), np.uint16)
        words, of = np.unique(successors.astype(np.uint64), return_inverse=True)
        name = self.successors.find(words)[of]
        some = np.flatnonzero((context >= 0) & (name >= 0))
        own, of = np.unique(context[some], return_inverse=True)
        start, end = (self.pointers.get(own + i).astype(np.int64)[of] for i in (0, 1))
        at = self.level2.find((own[of] * self.names + name[some]).astype(np.uint64), start, end)
        out[some[at >= 0]] = self.codes[at[at >= 0]]
        return out
