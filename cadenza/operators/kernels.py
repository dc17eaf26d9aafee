"""Scores of queries against catalog rows in numpy blocks, and the best k of them inside one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from cadenza.functions.text import TextBlock

#: Scores are compared at so many decimals, then by id.
DECIMALS = 9
SLACK = 10.0 ** -DECIMALS
SCORE_CELLS = 4_000_000


def _plain(column: pa.ChunkedArray) -> pa.Array:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column


def _values(column) -> np.ndarray:
    column = _plain(column)
    if pa.types.is_string(column.type) or pa.types.is_large_string(column.type):
        return np.array(column.to_pylist(), dtype=str)
    return column.to_numpy(zero_copy_only=False)


def _lists(column):
    """Flat values and row numbers of a list column."""
    column = _plain(column)
    counts = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten(), np.repeat(np.arange(len(counts)), counts)


class Dot:
    """Inner product of two dense vectors."""

    item_columns = query_columns = ("vec",)

    def width(self):
        return F.size("vec") * 8

    def load_queries(self, table):
        column = _plain(table.column("vec"))
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)

    def load_items(self, table, queries):
        return self.load_queries(table)

    def scores(self, queries, lo, hi, items, floor, k):
        return queries[lo:hi] @ items.T


class TokenSort:
    """Token-sort ratio (0..1) of token-sorted strings.

    A common subsequence has at most as many characters as the strings have in common, whatever their
    order. Texts are measured in order of that bound, and only as long as it reaches a query's floor.
    """

    item_columns = query_columns = ("sorted_text",)
    #: Bins that characters are counted in; characters that share one only raise a bound.
    BINS = 64

    def __init__(self):
        self.bounded = self.measured = 0

    def width(self):
        return F.octet_length("sorted_text")

    def load_queries(self, table):
        return _plain(table.column("sorted_text")).to_pylist()

    def counts(self, texts) -> np.ndarray:
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) % self.BINS
        row = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        return np.bincount(row * self.BINS + points, minlength=len(texts) * self.BINS).reshape(len(texts), self.BINS).astype(np.int32)

    def load_items(self, table, queries):
        # repeated texts are scored once
        codes, texts = pd.factorize(np.asarray(_plain(table.column("sorted_text")).to_pylist(), dtype=object))
        return codes, TextBlock(texts), self.counts(texts)

    def bounds(self, query: str, block: TextBlock, counts: np.ndarray) -> np.ndarray:
        total = block.lengths + len(query)
        shared = np.minimum(counts, self.counts([query])).sum(axis=1)
        return np.where(total == 0, 1.0, 2.0 * shared / np.maximum(total, 1))

    def scores(self, queries, lo, hi, items, floor, k):
        codes, block, counts = items
        return np.stack([self._above(q, block, counts, f, k)[codes] for q, f in zip(queries[lo:hi], floor)])

    def _above(self, query, block, counts, floor, k):
        """Scores of the texts that may be among the k best and reach the floor; -inf for all others."""
        upper = self.bounds(query, block, counts)
        order = np.argsort(-upper, kind="stable")
        falling = -upper[order]
        out = np.full(block.size, -np.inf)
        at, step = 0, max(2 * k, 16)
        while at < block.size:
            reach = int(np.searchsorted(falling, SLACK - floor, "right")) if floor > -np.inf else block.size
            stop = min(at + step, reach)
            if stop <= at:
                break
            some = np.zeros(block.size, bool)
            some[order[at:stop]] = True
            out[some] = block.ratio(query, some)[some] / 100.0
            at, step = stop, 2 * step
            if at >= k:
                floor = max(floor, np.partition(out, block.size - k)[block.size - k])
        self.bounded += block.size
        self.measured += at
        return out


class _Best:
    """Running top-k of every query inside one task."""

    def __init__(self, kernel, queries: pa.Table, k: int, positive: bool, schema: pa.Schema):
        self.kernel, self.k, self.positive, self.schema = kernel, k, positive, schema
        self.carry = [n for n in schema.names if n not in ("qid", "id", "score")]
        self.qid = queries.column("qid")
        self.n = queries.num_rows
        self.queries = kernel.load_queries(queries)
        self.exclude = _values(queries.column("exclude_id")) if "exclude_id" in queries.column_names else None
        self.floor = np.full(self.n, -np.inf)
        self.rows, self.scores, self.ids, self.carried = np.empty(0, np.int64), np.empty(0), None, None

    def add(self, table):
        if not table.num_rows or not self.n:
            return
        ids = _values(table.column("id"))
        items = self.kernel.load_items(table, self.queries)
        index = pd.Index(ids) if self.exclude is not None else None
        n = len(ids)
        step = max(SCORE_CELLS // n, 1)
        found = []
        for lo in range(0, self.n, step):
            hi = min(lo + step, self.n)
            # one more than k, as a query may leave one row out
            s = self.kernel.scores(self.queries, lo, hi, items, self.floor[lo:hi], self.k + (index is not None))
            s[np.isnan(s)] = -np.inf
            if index is not None:
                at = index.get_indexer(self.exclude[lo:hi])
                own = np.flatnonzero(at >= 0)
                s[own, at[own]] = -np.inf
            bound = self.floor[lo:hi].copy()
            if n > self.k:
                fresh = np.flatnonzero(np.isinf(bound))
                if len(fresh):
                    bound[fresh] = np.partition(s[fresh], n - self.k, axis=1)[:, n - self.k]
            keep = s >= (bound - SLACK)[:, None]
            keep &= (s > 0) if self.positive else ~np.isinf(s)
            r, c = np.nonzero(keep)
            found.append((r + lo, s[r, c], ids[c], c))
        self._merge(found, pa.table([_plain(table.column(c)) for c in self.carry], names=self.carry))

    def _merge(self, found, extra):
        rows = np.concatenate([self.rows] + [f[0] for f in found])
        scores = np.concatenate([self.scores] + [f[1] for f in found])
        ids = np.concatenate(([] if self.ids is None else [self.ids]) + [f[2] for f in found])
        compared = np.round(scores, DECIMALS) + 0.0
        order = np.lexsort((ids, -compared, rows))
        rows, scores, ids = rows[order], scores[order], ids[order]
        starts = np.searchsorted(rows, np.arange(self.n))
        place = np.arange(len(rows)) - starts[rows]
        top = place < self.k
        last = place == self.k - 1
        self.floor[rows[last]] = scores[last]
        self.rows, self.scores, self.ids = rows[top], scores[top], ids[top]
        if self.carry:
            new = extra.take(pa.array(np.concatenate([f[3] for f in found])))
            pool = new if self.carried is None else pa.concat_tables([self.carried, new])
            self.carried = pool.take(pa.array(order[top])).combine_chunks()

    def table(self) -> pa.Table:
        if self.ids is None:
            return self.schema.empty_table()
        field = self.schema.field
        out = {"qid": _plain(self.qid).take(pa.array(self.rows)),
               "id": pa.array(self.ids.tolist(), type=field("id").type),
               "score": pa.array(self.scores)}
        out.update({c: _plain(self.carried.column(c)) for c in self.carry})
        return pa.table([out[n].cast(field(n).type) for n in self.schema.names], schema=self.schema)
