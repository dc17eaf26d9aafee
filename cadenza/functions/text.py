"""Text expressions, and the one string measure Spark has no function for."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, functions as F, types as T

GRAM_SIZES = (2, 4)
WHITESPACE = r"(?U)[\s\x1c-\x1f]+"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    blank = WHITESPACE.removeprefix("(?U)")
    return F.regexp_replace(text, f"(?U)^{blank}|{blank}$", "")


def words(text: Column) -> Column:
    return F.filter(F.split(text, WHITESPACE), lambda w: w != "")


def char_grams(text: Column, low: int = GRAM_SIZES[0], high: int = GRAM_SIZES[1]) -> Column:
    """Character n-grams inside word boundaries: each word padded with one blank on both sides."""
    def of_word(word):
        padded = F.concat(F.lit(" "), word, F.lit(" "))
        size = F.length(padded)

        def of_size(n):
            starts = F.sequence(F.lit(1), size - (n - 1))
            return F.when(size >= n, F.transform(starts, lambda i: F.substring(padded, i, F.lit(n)))) \
                .otherwise(F.array().cast("array<string>"))

        return F.concat(*[of_size(n) for n in range(low, high + 1)])

    return F.flatten(F.transform(words(F.lower(text)), of_word))


def token_sort(text: Column) -> Column:
    return F.array_join(F.array_sort(words(text)), " ")


def pair_ratio(left: list, right: list) -> np.ndarray:
    """200 * common subsequence / (sum of lengths) of two equally long lists of strings, pair by pair.

    Pairs with the same right side are scored together.
    """
    out = np.empty(len(left))
    codes, patterns = pd.factorize(np.asarray(right, dtype=object))
    order = np.argsort(codes, kind="stable")
    for rows in np.split(order, np.flatnonzero(np.diff(codes[order])) + 1) if len(order) else []:
        out[rows] = TextBlock([left[i] for i in rows]).ratio(patterns[codes[rows[0]]])
    return out


@F.pandas_udf(T.DoubleType())
def _pair_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    given = left.notna() & right.notna()
    out = pd.Series(np.nan, index=left.index, dtype="Float64")
    if given.any():
        out[given] = pair_ratio(left[given].tolist(), right[given].tolist())
    return out.where(given, None)


def token_sort_ratio(left: Column, right: Column) -> Column:
    """Similarity 0..100 of two texts whatever the order of their words."""
    return _pair_ratio(token_sort(left), token_sort(right))


class TextBlock:
    """Strings as rows of code points, longest first, in pieces of bounded size."""

    CELLS = 2_000_000

    def __init__(self, texts):
        texts = np.asarray(texts, dtype=object)
        lengths = np.array([len(t) for t in texts], dtype=np.int64)
        self.size = len(texts)
        self.lengths = lengths
        self.pieces = []
        order = np.argsort(-lengths, kind="stable")
        at = 0
        while at < len(order):
            longest = max(int(lengths[order[at]]), 1)
            rows = order[at:at + max(self.CELLS // longest, 1)]
            codes = np.zeros((len(rows), longest), dtype=np.uint32)
            for r, i in enumerate(rows):
                codes[r, :lengths[i]] = np.frombuffer(texts[i].encode("utf-32-le"), dtype=np.uint32)
            self.pieces.append((rows, codes))
            at += len(rows)

    def common(self, pattern: str, chosen: np.ndarray | None = None) -> np.ndarray:
        """Length of the longest common subsequence of ``pattern`` with every string, or those flagged in ``chosen``.

        Bit-parallel over the pattern (64 positions per word, any number of words) and
        vectorised over the strings.
        """
        out = np.zeros(self.size, dtype=np.int64)
        if not pattern:
            return out
        n_words = (len(pattern) + 63) // 64
        alphabet = np.array(sorted({ord(c) for c in pattern}), dtype=np.uint32)
        masks = np.zeros((len(alphabet) + 1, n_words), dtype=np.uint64)
        for i, c in enumerate(pattern):
            row = np.searchsorted(alphabet, ord(c))
            masks[row, i // 64] |= np.uint64(1) << np.uint64(i % 64)
        for rows, codes in self.pieces:
            if chosen is not None:
                wanted = chosen[rows]
                rows = rows[wanted]
                if not len(rows):
                    continue
                codes = codes[wanted, :max(int(self.lengths[rows[0]]), 1)]
            index = np.searchsorted(alphabet, codes)
            known = index < len(alphabet)
            known[known] = alphabet[index[known]] == codes[known]
            index[~known] = len(alphabet)
            lens = self.lengths[rows]
            state = np.full((len(rows), n_words), ~np.uint64(0))
            for j in range(codes.shape[1]):
                alive = int(np.count_nonzero(lens > j))
                if not alive:
                    break
                hit = masks[index[:alive, j]]
                old = state[:alive]
                carry = np.zeros(alive, dtype=np.uint64)
                new = np.empty_like(old)
                for w in range(n_words):
                    first = old[:, w] + (old[:, w] & hit[:, w])
                    total = first + carry
                    carry = ((first < old[:, w]) | (total < first)).astype(np.uint64)
                    new[:, w] = total | (old[:, w] & ~hit[:, w])
                state[:alive] = new
            spare = n_words * 64 - len(pattern)
            if spare:
                state[:, -1] |= ~np.uint64(0) << np.uint64(64 - spare)
            out[rows] = np.bitwise_count(~state).sum(axis=1)
        return out

    def ratio(self, pattern: str, chosen: np.ndarray | None = None) -> np.ndarray:
        """200 * common / (sum of lengths); two empty strings are equal. Only the flagged strings' values count."""
        total = self.lengths + len(pattern)
        return np.where(total == 0, 100.0, 200.0 * self.common(pattern, chosen) / np.maximum(total, 1))
