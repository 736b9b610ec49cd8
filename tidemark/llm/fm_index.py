"""An FM-index over word sequences: a Burrows-Wheeler transform in a wavelet matrix, searched backwards.

Suffixes are sorted by their first `length` words, which is all that searches for so many words need. Searches run in
lockstep: one step of all patterns is a handful of array operations on each bit of the alphabet.
"""

from __future__ import annotations

import numpy as np


class Wavelet:
    """rank queries over a sequence of symbols below 2**bits: one bit vector a level, with counts every 64 bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.levels, n = bits, [], len(symbols)
        for b in range(bits - 1, -1, -1):
            bit = ((symbols >> b) & 1).astype(bool)
            words = np.packbits(np.concatenate([bit, np.zeros(-n % 64 + 64, bool)]), bitorder="little").view(np.uint64)
            counts = np.concatenate([[0], np.cumsum(np.bitwise_count(words))[:-1]]).astype(np.int64)
            self.levels.append((words, counts, n - int(bit.sum())))
            symbols = np.concatenate([symbols[~bit], symbols[bit]])
        every = np.arange(1 << bits) if bits <= 20 else None
        self.base = self._walk(every, np.zeros(len(every), np.int64)) if every is not None else None

    def _walk(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for k, (words, counts, zeros) in enumerate(self.levels):
            w = at >> 6
            ones = counts[w] + np.bitwise_count(words[w] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)))
            at = np.where((symbols >> (self.bits - 1 - k)) & 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        before = self.base[symbols] if self.base is not None else self._walk(symbols, np.zeros(len(symbols), np.int64))
        return self._walk(symbols, at) - before


class FMIndex:
    """Over sequences of symbols (0 to sigma - 1), given one after another with their lengths."""

    def __init__(self, symbols: np.ndarray, lengths: np.ndarray, sigma: int, length: int):
        self.length, self.lengths = length, lengths
        ends = np.cumsum(lengths + 1)
        text = np.zeros(int(ends[-1]) + length, np.int64)
        self.starts = ends - lengths - 1
        inner = np.repeat(self.starts - np.cumsum(lengths) + lengths, lengths) + np.arange(len(symbols))
        text[inner] = symbols + 1  # 0 ends each sequence
        self.text, n = text, int(ends[-1])
        short, ranks, size = self._ranks(text, n, length)
        self.sa = np.argsort(ranks, kind="stable")
        new = np.ones(n + 1, bool)
        new[1:n] = np.diff(ranks[self.sa]) > 0
        bounds = np.flatnonzero(new)
        self.classes = np.cumsum(new[:n]) - 1  # suffixes that agree in all length words
        self.class_starts = bounds[:-1]
        wide = np.ones(n + 1, bool)
        wide[1:n] = np.diff(short[self.sa]) != 0
        bounds = np.flatnonzero(wide)
        which = np.cumsum(wide[:n]) - 1
        self.low, self.high = bounds[which], bounds[which + 1]  # and in all but the last
        self.owner = np.repeat(np.arange(len(lengths)), lengths + 1)[self.sa]
        before = text[self.sa - 1]
        before[self.sa == 0] = 0
        self.wavelet = Wavelet(before, max(1, int(sigma).bit_length()))
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text[:n], minlength=sigma + 1))])
        self.size = n

    @staticmethod
    def _ranks(text: np.ndarray, n: int, length: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ranks of all suffixes by their first length - 1 and by their first length words."""

        def doubled(have: np.ndarray, more: np.ndarray) -> np.ndarray:
            return np.unique(have * (int(more.max()) + 1) + more, return_inverse=True)[1]

        def shifted(r: np.ndarray, k: int) -> np.ndarray:
            return np.concatenate([r[k:], np.zeros(k, r.dtype)])

        r, have, out = text.copy(), 1, []
        for goal in (length - 1, length):
            while have < goal:
                step = min(have, goal - have)
                r = doubled(r, shifted(r, step))
                have += step
            out.append(r[:n])
        return out[0], out[1], n

    def matching_classes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Streams every sequence through the index, backwards, and reports each run of `length` words that is matched.

        The three arrays name the sequence, the run's first word in it, and its class. A match grows by one word to
        the left in each step; at `length` words it is reported and loses its last word.
        """
        order = np.argsort(-self.lengths, kind="stable")
        lengths = self.lengths[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.size, np.int64)
        at = self.starts[order] + lengths
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for step in range(int(lengths[0]) if len(lengths) else 0):
            m = int(np.searchsorted(-lengths, -step, side="left"))
            c = self.text[at[:m] - 1 - step]
            base = self.first[c]
            low[:m], high[:m] = base + self.wavelet.rank(c, low[:m]), base + self.wavelet.rank(c, high[:m])
            if step >= self.length - 1:
                found.append((order[:m], lengths[:m] - 1 - step, self.classes[low[:m]]))
                low[:m], high[:m] = self.low[low[:m]], self.high[low[:m]]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))
