"""Words as 64-bit numbers, and hashes of runs of words."""

from __future__ import annotations

import numpy as np
import xxhash

_FACTOR = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_FACTOR, -1, 1 << 64)


class WordIds(dict):
    """Ids of words (bytes), remembered between texts; emptied beyond ``most`` words, which changes no id."""

    def __init__(self, most: int = 500_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        self[word] = number = xxhash.xxh64_intdigest(word)
        return number

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


class _Powers:
    """Powers of the factor and of its inverse, as many as were needed so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            steps = np.full(n, _FACTOR, np.uint64)
            steps[0] = 1
            back = np.full(n, _INVERSE, np.uint64)
            back[0] = 1
            self.up, self.down = np.multiply.accumulate(steps), np.multiply.accumulate(back)
        return self.up[:n], self.down[:n]


_powers = _Powers()


def mixed(x: np.ndarray) -> np.ndarray:
    """Each number's bits spread over the whole word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def run_hashes(ids: np.ndarray, length: int) -> np.ndarray:
    """A hash for every run of ``length`` words, by where it starts; equal runs have equal hashes."""
    n = len(ids) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    up, down = _powers(len(ids))
    sums = np.zeros(len(ids) + 1, np.uint64)
    np.cumsum(ids * up[:len(ids)], out=sums[1:])
    return mixed((sums[length:] - sums[:n]) * down[:n] + np.uint64(length))


def window_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """For every window of hashes the position of its (first) least one."""
    if len(hashes) < window:
        return np.zeros(0, np.int64)
    if window < 9:
        views = np.lib.stride_tricks.sliding_window_view(hashes, window)
        return views.argmin(axis=1) + np.arange(len(views))
    # the least of a window of length 2**j from two of half the length, then two that overlap
    at = np.arange(len(hashes))
    size = 1
    while 2 * size <= window:
        a, b = at[:-size], at[size:]
        at = np.where(hashes[b] < hashes[a], b, a)
        size *= 2
    if size < window:
        rest = window - size
        a, b = at[:-rest], at[rest:]
        at = np.where((hashes[b] < hashes[a]), b, a)
    return at


_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of a text (its bytes) start and end, as ``bytes.split`` cuts it."""
    inside = np.concatenate([[False], ~_WHITE[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def word_numbers(text: bytes, spans: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
    """A 64-bit number for each word of a text: equal words have equal numbers.

    Numbers come from running sums over all bytes at once, without a look-up per word.
    """
    data = np.frombuffer(text, np.uint8)
    start, end = word_spans(data) if spans is None else spans
    up, down = _powers(len(data) or 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))
