"""FM-index over word sequences: suffix order, a wavelet matrix of its preceding words, backward search."""

from __future__ import annotations

import numpy as np


class BitRank:
    """A bit sequence, packed, with the number of ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, np.uint64)
        self.words.view(np.uint8)[:len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, np.int32)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        block = at >> 6
        inside = self.words[block] & ((np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1))
        return self.before[block] + np.bitwise_count(inside)


class WaveletMatrix:
    """Counts of any symbol before any place, one packed bit sequence a binary digit."""

    def __init__(self, symbols: np.ndarray, alphabet: int):
        self.levels = []
        for digit in reversed(range(max(1, (alphabet - 1).bit_length()))):
            bits = (symbols >> digit & 1).astype(bool)
            self.levels.append((digit, BitRank(bits), int(len(bits) - bits.sum())))
            symbols = np.concatenate([symbols[~bits], symbols[bits]])
        every = np.arange(alphabet)
        self.first = self._down(every, np.zeros(alphabet, np.int64))

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for digit, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where(symbols >> digit & 1, zeros + ones, at - ones)
        return at

    def count(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._down(symbols, at) - self.first[symbols]


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order, by prefix doubling. The text's suffixes must differ before they end."""
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    width = 1
    while True:
        after = np.zeros(len(rank), np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (len(rank) + 1) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        new = np.zeros(len(rank), np.int64)
        new[order[1:]] = np.cumsum(key[1:] != key[:-1])
        rank = new
        width *= 2
        if rank[order[-1]] == len(rank) - 1 or width >= len(rank):
            return order


class FMIndex:
    """Index of segments (word codes from 1 up), each closed by a mark of its own."""

    def __init__(self, segments: list[np.ndarray], window: int):
        sizes = np.array([len(s) for s in segments])
        ends = np.cumsum(sizes + 1) - 1
        n = int(ends[-1]) + 1
        text = np.zeros(n, np.int64)
        is_mark = np.zeros(n, bool)
        is_mark[ends] = True
        text[~is_mark] = np.concatenate(segments) + len(segments)
        text[is_mark] = np.arange(len(segments))  # marks sort before words, each its own symbol
        order = suffix_order(text)
        words = np.where(is_mark, 0, text - len(segments))
        self.alphabet = int(words.max()) + 1
        self.rows = n
        self.matrix = WaveletMatrix(words[order - 1], self.alphabet)
        self.start = np.concatenate([[0], np.cumsum(np.bincount(words, minlength=self.alphabet))])[:-1]
        self.segment = np.searchsorted(ends, order)  # of each row
        # rows whose suffixes share their first ``window`` words form one class
        room = ends[self.segment] - order >= window
        same = np.zeros(n, bool)
        near = np.flatnonzero(room[1:] & room[:-1])
        lcp = self._common(words, order[near], order[near + 1], window)
        same[near[lcp >= window] + 1] = True
        self.window_class = np.cumsum(~same) - 1

    @staticmethod
    def _common(words: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
        """Common prefix lengths, counted up to ``most``."""
        length = np.zeros(len(a), np.int64)
        open_ = np.arange(len(a))
        for step in range(most):
            open_ = open_[words[a[open_] + step] == words[b[open_] + step]]
            if not len(open_):
                break
            length[open_] += 1
        return length

    def least_by_class(self, value_of_segment: np.ndarray) -> np.ndarray:
        """For each class of rows the least value of the segments it lies in."""
        first = np.flatnonzero(np.concatenate([[True], self.window_class[1:] != self.window_class[:-1]]))
        return np.minimum.reduceat(value_of_segment[self.segment], first)

    def matches(self, segments: list[np.ndarray], window: int):
        """Backward search of streamed segments, all in step, each from its end.

        Yields (segments' positions, starts, first rows) wherever the match from a start to the end of its
        segment has at least ``window`` words; an empty interval ends a segment's search."""
        sizes = np.array([len(s) for s in segments])
        alive = np.argsort(-sizes, kind="stable")
        padded = np.concatenate(segments)
        offset = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        low, high = np.zeros(len(segments), np.int64), np.full(len(segments), self.rows, np.int64)
        for step in range(int(sizes.max())):
            alive = alive[sizes[alive] > step]
            at = sizes[alive] - 1 - step
            words = padded[offset[alive] + at]
            low[alive] = self.start[words] + self.matrix.count(words, low[alive])
            high[alive] = self.start[words] + self.matrix.count(words, high[alive])
            found = low[alive] < high[alive]
            alive, at = alive[found], at[found]
            if step + 1 >= window and len(alive):
                yield alive, at, low[alive]
