"""FM-index over a sequence of integers in numpy: suffix order, transform, wavelet matrix, backward search.

All searches of a batch advance together. Each position has an owner; a match counts only if the
smallest owner among its occurrences is below the searcher's own.
"""

from __future__ import annotations

import numpy as np


def suffix_order(tokens: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` tokens at least, by doubling the compared length."""
    size = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order, length = np.argsort(rank, kind="stable"), 1
    while length < depth and size:
        behind = np.zeros(size, np.int64)
        behind[:size - length] = rank[length:] + 1
        pair = rank * (size + 1) + behind
        order = np.argsort(pair, kind="stable")
        steps = np.append(0, pair[order[1:]] != pair[order[:-1]])
        rank[order] = np.cumsum(steps)
        length *= 2
        if rank[order[-1]] == size - 1:
            break
    return order


class WaveletMatrix:
    """Counts of a symbol before a position, from one bit vector per bit of the symbols."""

    def __init__(self, symbols: np.ndarray, count: int):
        self.bits = max(1, int(count - 1).bit_length())
        self.words, self.before, self.zeros = [], [], []
        size = len(symbols)
        current = symbols
        for level in range(self.bits - 1, -1, -1):
            ones = (current >> level) & 1
            padded = np.zeros((size // 64 + 1) * 64, np.uint8)
            padded[:size] = ones
            words = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(words)
            self.before.append(np.append(0, np.cumsum(np.bitwise_count(words).astype(np.int64)))[:-1])
            self.zeros.append(int(size - ones.sum()))
            current = np.concatenate([current[ones == 0], current[ones == 1]])
        everything = np.arange(count)
        self.base = self._descend(everything, np.zeros(count, np.int64))

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for n, level in enumerate(range(self.bits - 1, -1, -1)):
            block = at >> 6
            inside = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
            ones = self.before[n][block] + np.bitwise_count(self.words[n][block] & inside)
            at = np.where((symbols >> level) & 1, self.zeros[n] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before each position."""
        return self._descend(symbols, at) - self.base[symbols]


class FMIndex:
    """``tokens`` are 0 (separator) to ``count - 1``; no search contains a separator."""

    def __init__(self, tokens: np.ndarray, owners: np.ndarray, count: int, depth: int):
        self.tokens = tokens
        order = suffix_order(tokens, depth)
        self.starts = np.append(0, np.cumsum(np.bincount(tokens, minlength=count))).astype(np.int64)
        self.wavelet = WaveletMatrix(tokens[order - 1], count)
        # smallest owner of any stretch of the suffix order: minima over lengths 1, 2, 4, ...
        self.minima = [owners[order].astype(np.int32)]
        while 1 << len(self.minima) <= len(order):
            last, half = self.minima[-1], 1 << (len(self.minima) - 1)
            self.minima.append(np.minimum(last[:-half], last[half:]))
        sizes = np.array([len(m) for m in self.minima])
        self.flat, self.offsets = np.concatenate(self.minima), np.append(0, np.cumsum(sizes))[:-1]
        del self.minima

    def smallest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Smallest owner in each non-empty [low, high) of the suffix order."""
        level = np.frexp((high - low).astype(float))[1] - 1
        base = self.offsets[level]
        return np.minimum(self.flat[base + low], self.flat[base + high - (1 << level)])

    def extend(self, limit: np.ndarray, end: np.ndarray, own: np.ndarray) -> np.ndarray:
        """Matching statistics: the smallest start >= ``limit`` of a match that ends at ``end``.

        Tokens [start, end] occur with an owner below ``own``; ``end + 1`` if not even the last one does.
        """
        reached = end + 1
        who, at = np.arange(len(end)), end.copy()
        symbol = self.tokens[at]
        low, high = self.starts[symbol], self.starts[symbol + 1]
        while len(who):
            good = high > low
            good[good] = self.smallest(low[good], high[good]) < own[who[good]]
            who, at, low, high = who[good], at[good], low[good], high[good]
            reached[who] = at
            more = at > limit[who]
            who, at, low, high = who[more], at[more] - 1, low[more], high[more]
            if not len(who):
                break
            symbol = self.tokens[at]
            found = self.wavelet.rank(np.concatenate([symbol, symbol]), np.concatenate([low, high]))
            low, high = self.starts[symbol] + found[:len(who)], self.starts[symbol] + found[len(who):]
        return reached


def intervals(index: FMIndex, begin: np.ndarray, length: np.ndarray, own: np.ndarray, window: int):
    """(search number, start, end) of maximal runs of matching windows, relative to ``begin``; end exclusive.

    A search is a stretch of the index's own tokens. Its windows are tried from the left, each matched
    backwards from its end: a mismatch rules out all windows that hold it, a match is first tried to
    the stretch's end and then by halving, as far as it goes.
    """
    out = []

    def note(who, start, stop):
        if len(who):
            out.append(np.stack([who, start, stop], axis=1))

    who = np.flatnonzero(length >= window)
    start, last = np.zeros(len(who), np.int64), length[who] - window
    reached = index.extend(begin[who], begin[who] + length[who] - 1, own[who]) - begin[who]
    fits = length[who] - reached >= window
    note(who[fits], reached[fits], length[who][fits])
    last = np.where(fits, reached - 1, last)
    open_ = last >= 0
    who, start, last = who[open_], start[open_], last[open_]
    while len(who):
        end = start + window - 1
        reached = index.extend(begin[who] + start, begin[who] + end, own[who]) - begin[who]
        matched = reached <= start
        # the farthest end up to which the text from ``start`` matches, by halving
        some = np.flatnonzero(matched)
        if len(some):
            good, bad = end[some], last[some] + window
            while True:
                going = np.flatnonzero(bad - good > 1)
                if not len(going):
                    break
                middle = (good[going] + bad[going]) // 2
                rows = some[going]
                far = index.extend(begin[who[rows]] + start[rows], begin[who[rows]] + middle, own[who[rows]])
                whole = far <= begin[who[rows]] + start[rows]
                good[going] = np.where(whole, middle, good[going])
                bad[going] = np.where(whole, bad[going], middle)
            note(who[some], start[some], good + 1)
            reached[some] = good - window + 2
        start = reached
        open_ = start <= last
        who, start, last = who[open_], start[open_], last[open_]
    return np.concatenate(out) if out else np.empty((0, 3), np.int64)
