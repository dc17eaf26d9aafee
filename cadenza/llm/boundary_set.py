"""A compressed ordered set of offsets that answers "which is the n-th?", as roaring bitmaps do.

Offsets are split by their high 16 bits into containers of low halves. A container is held in the
smallest of three forms: a sorted array, a bitmap of 65536 bits, or runs of neighbours. Cumulative
cardinalities lead to the container that has the n-th offset; a select inside it finds the low half.
"""

from __future__ import annotations

import numpy as np

CONTAINER_BITS = 16
BITMAP_WORDS = (1 << CONTAINER_BITS) // 64
_BITS = np.arange(64, dtype=np.uint64)


class ArrayContainer:
    def __init__(self, low: np.ndarray):
        self.low = low.astype(np.uint16)

    def select(self, ranks: np.ndarray) -> np.ndarray:
        return self.low[ranks].astype(np.int64)


class BitmapContainer:
    def __init__(self, low: np.ndarray):
        bits = np.zeros(1 << CONTAINER_BITS, bool)
        bits[low] = True
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.below = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])

    def select(self, ranks: np.ndarray) -> np.ndarray:
        word = np.searchsorted(self.below, ranks, "right") - 1
        ones = ((self.words[word, None] >> _BITS) & np.uint64(1)).cumsum(axis=1, dtype=np.int64)
        # the first bit at which the word's count of ones exceeds what is left of the rank
        return word * 64 + (ones <= (ranks - self.below[word])[:, None]).sum(axis=1)


class RunContainer:
    def __init__(self, low: np.ndarray):
        heads = np.flatnonzero(np.diff(low, prepend=low[0] - 2) != 1)
        self.starts = low[heads].astype(np.uint16)
        self.below = np.append(heads, len(low))

    def select(self, ranks: np.ndarray) -> np.ndarray:
        run = np.searchsorted(self.below, ranks, "right") - 1
        return self.starts[run].astype(np.int64) + ranks - self.below[run]


def container(low: np.ndarray):
    """The smallest form of one container's low halves, which ascend."""
    runs = int(np.count_nonzero(np.diff(low) != 1)) + 1
    sizes = {ArrayContainer: 2 * len(low), BitmapContainer: 8 * BITMAP_WORDS, RunContainer: 2 + 4 * runs}
    return min(sizes, key=sizes.get)(low)


class BoundarySet:
    """Ascending distinct offsets >= 0."""

    def __init__(self, offsets: np.ndarray):
        offsets = np.asarray(offsets, np.int64)
        high = offsets >> CONTAINER_BITS
        heads = np.flatnonzero(np.diff(high, prepend=-1))
        low = offsets & ((1 << CONTAINER_BITS) - 1)
        self.keys = high[heads]
        self.containers = [container(part) for part in np.split(low, heads[1:])] if len(heads) else []
        #: How many offsets lie before each container, and in all.
        self.below = np.append(heads, len(offsets)).astype(np.int64)

    def __len__(self) -> int:
        return int(self.below[-1])

    def select(self, ranks) -> np.ndarray:
        """The offsets of these ranks, counted from 0."""
        ranks = np.asarray(ranks, np.int64)
        if len(ranks) and (ranks.min() < 0 or ranks.max() >= len(self)):
            raise IndexError("rank outside the set")
        at = np.searchsorted(self.below, ranks, "right") - 1
        out = np.empty(len(ranks), np.int64)
        for i in np.unique(at):
            here = at == i
            out[here] = (self.keys[i] << CONTAINER_BITS) + self.containers[i].select(ranks[here] - self.below[i])
        return out
