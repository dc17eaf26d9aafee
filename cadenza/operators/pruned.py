"""Exact top-k by inner product that skips what a bound excludes.

The catalog is clustered once: a row goes to the nearest of the centroids of a bounded sample, and a
centroid with many rows is split by a hash of the id, so that blocks stay bounded whatever vector is
repeated. A block's bound for a query q is the least of three: q.c + |q| * radius, |q| times its largest norm, and half
of |q|^2 + norm^2 - d^2, where d is the distance from q to the ball around the block. Every
query meets its best bounded blocks first, which gives it a floor; after that, a block is met only by the
queries whose bound for it reaches their floor. Floors rise within a task as well.

Queries of a measured size travel to the blocks' tasks. Beyond that, whole blocks are dealt over parts, queries over
groups, and every group meets every part in one bounded task, which finds the floors itself: what is shuffled are copies
of both sides and the best rows of each cell, however many pairs of a query and a block the bound lets through.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadenza.operators.kernels import DECIMALS, SLACK, Dot, _Best, _plain, _values
from cadenza.operators.ordering import top_per_group
from cadenza.session import write_and_read

#: Centroids that are fitted, sampled rows for each of them, and blocks a catalog is cut into, at most.
MAX_CENTROIDS, SAMPLE_PER_CENTROID, MAX_BLOCKS = 4096, 16, 32_768
LLOYD_ROUNDS = 4
#: Bytes of bounds that travel with a task; with wide vectors there are fewer, larger blocks.
MAX_BOUND_BYTES = 64 << 20
#: Queries of a task that meet its blocks together.
QUERIES_PER_MEETING = 50_000
#: Cells of queries x blocks or queries x rows in one array.
CELLS = 4_000_000
#: Scores of some queries and one block in a cell of the grid, however large the block is.
SCORES = 1_000_000
#: Winners kept aside before they are merged.
PENDING_ROWS = 400_000
#: Rows and bytes of vectors of either side in one task, and winners it holds.
SIDE_ROWS, SIDE_BYTES, WINNERS = 800_000, 64 << 20, 4_000_000
#: Bytes that a winner takes in a shuffle, and a row beside its vector, roughly.
ROW_BYTES = 40
#: Best bounded blocks looked at for a query's first ones before all of them are.
FIRST_LOOK = 32
#: Blocks of a usual size that a query of a group meets for its floor.
FIRST_BLOCKS = 4


def matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(column), -1)


def _chunks(x):
    """(first row, rows as a matrix) of each part of a matrix or a column of vectors, whose parts are not put together."""
    at = 0
    for part in x.chunks if isinstance(x, pa.ChunkedArray) else [x]:
        if len(part):
            yield at, part if isinstance(part, np.ndarray) else matrix(part)
            at += len(part)


def _rows(x, wanted: np.ndarray) -> np.ndarray:
    """Some rows of a matrix or a column of vectors, in that order: the only copy of them."""
    if isinstance(x, np.ndarray):
        return x[wanted]
    out = None
    for at, part in _chunks(x):
        out = np.empty((len(wanted), part.shape[1])) if out is None else out
        mine = np.flatnonzero((wanted >= at) & (wanted < at + len(part)))
        out[mine] = part[wanted[mine] - at]
    return out


class Bounds:
    """What is known of each block: centroid, radius around it, largest norm, rows."""

    def __init__(self, centres, radius, norm, rows):
        self.centres, self.radius, self.norm, self.rows = centres, radius, norm, rows

    def of(self, blocks: np.ndarray) -> "Bounds":
        """The same of some blocks only, numbered anew."""
        return Bounds(self.centres[blocks], self.radius[blocks], self.norm[blocks], self.rows[blocks])

    def upper(self, queries: np.ndarray, norms: np.ndarray, blocks=slice(None)) -> np.ndarray:
        """No inner product of a query with a row of a block is larger, rounding included."""
        centres, radius, norm, given = self.centres[blocks], self.radius[blocks], self.norm[blocks], norms[:, None]
        with np.errstate(invalid="ignore", over="ignore"):
            own, square = (centres ** 2).sum(axis=1), given ** 2
            upper = queries @ centres.T
            # from the distance to the centroid, less the radius
            far = upper * -2
            far += square + own
            np.sqrt(np.maximum(far, 0, out=far), out=far)
            far -= radius
            np.maximum(far, 0, out=far)
            far *= far
            np.subtract(square + norm ** 2, far, out=far)
            far *= 0.5
            upper += given * radius
            np.minimum(upper, far, out=upper)
            np.minimum(upper, given * norm, out=upper)
            upper += 1e-12 * (1.0 + square) + 1e-12 * (norm ** 2 + own)
        upper[np.isnan(upper)] = np.inf
        return upper

    def home(self, upper: np.ndarray, wanted: int) -> np.ndarray:
        """Flags of the blocks each query meets first: the best bounded ones that hold ``wanted`` rows together."""
        if upper.shape[1] == 0:
            return np.zeros(upper.shape, bool)
        out = np.zeros(upper.shape, bool)
        look = min(FIRST_LOOK, upper.shape[1])
        best = np.argpartition(-upper, look - 1, axis=1)[:, :look]
        best = np.take_along_axis(best, np.argsort(-np.take_along_axis(upper, best, axis=1), axis=1, kind="stable"), axis=1)
        held = np.cumsum(self.rows[best], axis=1)
        np.put_along_axis(out, best, held - self.rows[best] < wanted, axis=1)
        short = np.flatnonzero(held[:, -1] < wanted)
        if len(short) and look < upper.shape[1]:
            order = np.argsort(-upper[short], axis=1, kind="stable")
            before = np.cumsum(self.rows[order], axis=1) - self.rows[order]
            flags = np.zeros((len(short), upper.shape[1]), bool)
            np.put_along_axis(flags, order, before < wanted, axis=1)
            out[short] = flags
        return out


def _centroids(sample: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of distinct sampled vectors by a few rounds of Lloyd's method, and the rows of the sample at each."""
    distinct = np.unique(sample, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(n, len(distinct))).astype(int)]
    for _ in range(LLOYD_ROUNDS):
        near = _nearest(sample, centres)[0]
        sums = np.zeros_like(centres)
        np.add.at(sums, near, sample)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres, np.bincount(_nearest(sample, centres)[0], minlength=len(centres))


def _nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each row and its distance, which is worked out for that pair alone."""
    near = np.empty(len(x), np.int64)
    half = (centres ** 2).sum(axis=1) / 2
    step = max(1, CELLS // max(len(centres), 1))
    for at in range(0, len(x), step):
        near[at:at + step] = np.argmax(x[at:at + step] @ centres.T - half, axis=1)
    return near, np.sqrt(((x - centres[near]) ** 2).sum(axis=1))


def cluster(items: DataFrame, n_items: int, n_blocks: int | None = None, tasks: int | None = 8, carry=()) -> tuple[DataFrame, Bounds]:
    """(block, id, vec, carry...) written, and the blocks' bounds, from items (id, vec, carry...) without null vectors.

    Rows lie block by block in ``tasks`` files; without ``tasks`` they stay where they are.
    """
    spark, key = items.sparkSession, F.xxhash64("id")
    wanted = n_blocks or min(MAX_BLOCKS, 4 * math.isqrt(n_items) + 1)
    size = SAMPLE_PER_CENTROID * min(wanted, MAX_CENTROIDS)
    sample = matrix(items.select("vec", key.alias("key"), "id").orderBy("key", "id").limit(size).select("vec").toArrow().column("vec"))
    sample = np.where(np.isfinite(sample), sample, 0.0)
    wanted = max(1, min(wanted, MAX_BOUND_BYTES // (8 * (sample.shape[1] + 3))))
    centres, seen = _centroids(sample, min(wanted, MAX_CENTROIDS))
    rows_per_block = max(1.0, n_items / wanted)
    parts = np.maximum(1, np.round(seen / max(seen.sum(), 1) * n_items / rows_per_block)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(parts)])
    shared = spark.sparkContext.broadcast((centres, parts, first))
    out = T.StructType([T.StructField("block", T.LongType()), items.schema["id"], items.schema["vec"],
                        T.StructField("far", T.DoubleType()), T.StructField("norm", T.DoubleType()), *[items.schema[c] for c in carry]])

    def assign(batches):
        centres, parts, first = shared.value
        for batch in batches:
            x = matrix(batch.column("vec"))
            near, far = _nearest(x, centres)
            block = first[near] + batch.column("key").to_numpy() % parts[near]
            yield pa.RecordBatch.from_arrays([pa.array(block), batch.column("id"), batch.column("vec"), pa.array(far),
                                              pa.array(np.sqrt((x ** 2).sum(axis=1))), *[batch.column(c) for c in carry]], schema=to_arrow_schema(out))

    clustered = items.select("id", "vec", F.abs(key % (1 << 40)).alias("key"), *carry).mapInArrow(assign, out)
    if tasks:
        clustered = clustered.repartition(tasks, "block").sortWithinPartitions("block")
    clustered = write_and_read(clustered, "blocks")
    known = clustered.groupBy("block").agg(F.max("far").alias("far"), F.max("norm").alias("norm"), F.count("*").alias("n")).toPandas()
    radius, norm, rows = (np.zeros(first[-1]) for _ in range(3))
    radius[known["block"]], norm[known["block"]], rows[known["block"]] = known["far"], known["norm"], known["n"]
    # vectors that are not numbers bound nothing: their blocks are always met
    radius[np.isnan(radius)], norm[np.isnan(norm)] = np.inf, np.inf
    return clustered.select("block", "id", "vec", *carry), Bounds(np.repeat(centres, parts, axis=0), radius, norm, rows)


def _largest(x: np.ndarray) -> float:
    """The largest absolute value, without a copy of all of them."""
    return max(float(x.max()), -float(x.min())) if x.size else 0.0


def _slices(n: int, width: int, cells: int = CELLS):
    step = max(1, cells // max(width, 1))
    return ((at, min(at + step, n)) for at in range(0, n, step))


def _upper_slices(bounds: Bounds, vectors: np.ndarray):
    """(lo, hi, bounds of these queries for all blocks), a bounded number of cells at a time."""
    step = max(1, CELLS // max(len(bounds.rows), 1))
    for lo in range(0, len(vectors), step):
        part = vectors[lo:lo + step]
        yield lo, lo + len(part), bounds.upper(part, np.linalg.norm(part, axis=1))


def with_home(queries: DataFrame, bounds, wanted: int) -> DataFrame:
    """Queries (qid, vec, ...) with ``home``, the blocks each meets first."""
    out = T.StructType([*queries.schema.fields, T.StructField("home", T.ArrayType(T.LongType()))])

    def find(batches):
        known = bounds.value
        for batch in batches:
            for lo, hi, upper in _upper_slices(known, matrix(batch.column("vec"))):
                flags = known.home(upper, wanted)
                ends = np.concatenate([[0], np.cumsum(flags.sum(axis=1))]).astype(np.int32)
                home = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.nonzero(flags)[1].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, hi - lo).columns, home], schema=to_arrow_schema(out))

    return queries.mapInArrow(find, out)


def _reached(upper: np.ndarray, floor: np.ndarray, home: pa.Array) -> np.ndarray:
    """Flags of the blocks whose bound reaches the query's floor, without those met already."""
    flags = upper >= floor[:, None] - SLACK
    flags[np.repeat(np.arange(len(floor)), home.value_lengths().to_numpy(zero_copy_only=False)), home.flatten().to_numpy()] = False
    return flags


def block_visits(queries: DataFrame, bounds) -> DataFrame:
    """(qid, n_blocks, n_visited) from queries with home and floor: blocks with rows, and those a query has to meet."""
    out = T.StructType([queries.schema["qid"], T.StructField("n_blocks", T.LongType()), T.StructField("n_visited", T.LongType())])

    def find(batches):
        known = bounds.value
        for batch in batches:
            floor = batch.column("floor").to_numpy(zero_copy_only=False)
            for lo, hi, upper in _upper_slices(known, matrix(batch.column("vec"))):
                home = batch.column("home").slice(lo, hi - lo)
                more = (_reached(upper, floor[lo:hi], home) & (known.rows > 0)).sum(axis=1)
                met = more + home.value_lengths().to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([batch.column("qid").slice(lo, hi - lo), pa.array(np.full(hi - lo, np.count_nonzero(known.rows))),
                                                  pa.array(met.astype(np.int64))], schema=to_arrow_schema(out))

    return queries.mapInArrow(find, out)


class _Meeting(_Best):
    """Running top-k over blocks, each met by some of the queries only, above floors known from before."""

    def __init__(self, queries: pa.Table, k: int, floor: np.ndarray, schema: pa.Schema):
        super().__init__(Dot(), queries, k, False, schema)
        self.floor, self.norms = floor.astype(float), np.linalg.norm(self.queries, axis=1)
        self.found, self.pending = [], 0
        self.finite = bool(np.isfinite(self.queries).all())

    def meet(self, ids: np.ndarray, x: np.ndarray, rows: np.ndarray):
        n, order = len(ids), None if self.exclude is None else np.argsort(ids, kind="stable")
        held = ids[order] if order is not None else None
        clean = self.finite and np.isfinite(x).all()
        step = max(CELLS // max(n, 1), 1)
        for lo in range(0, len(rows), step):
            some = rows[lo:lo + step]
            s = self.queries[some] @ x.T
            if not clean:
                s[np.isnan(s)] = -np.inf
            if order is not None:
                at, end = (np.searchsorted(held, self.exclude[some], side) for side in ("left", "right"))
                own = np.flatnonzero(at < end)
                while len(own):
                    s[own, order[at[own]]] = -np.inf
                    at[own] += 1
                    own = own[at[own] < end[own]]
            bound = self.floor[some]
            fresh = np.flatnonzero(np.isinf(bound))
            if n > self.k and len(fresh):
                bound[fresh] = np.partition(s[fresh], n - self.k, axis=1)[:, n - self.k]
            r, c = np.nonzero(s >= (bound - SLACK)[:, None])
            score = s[r, c]
            real = ~np.isinf(score)
            self.found.append((some[r[real]], score[real], ids[c[real]], c[real]))
            self.pending += len(self.found[-1][0])
            if self.pending > max(PENDING_ROWS, self.n * self.k // 2):
                self.settle()

    def settle(self):
        if self.found:
            known = self.floor.copy()
            self._merge(self.found, None)
            self.floor = np.maximum(self.floor, known)
            self.found, self.pending = [], 0

    def table(self):
        self.settle()
        return super().table()


def _of_blocks(batch):
    """(block, rows) of each stretch of one block in a batch."""
    block = batch.column("block").to_numpy()
    heads = np.flatnonzero(np.diff(block, prepend=block[:1] - 1)) if len(block) else []
    for start, stop in zip(heads, np.append(heads[1:], len(block))):
        yield int(block[start]), batch.slice(start, stop - start)


def _scan(clustered: DataFrame, queries: pa.Table, floor: np.ndarray | None, bounds, k: int, out: T.StructType) -> DataFrame:
    """One wave with the queries in every task: first blocks without ``floor``, else all others it does not exclude."""
    sent = clustered.sparkSession.sparkContext.broadcast((queries, floor))

    def scan(batches):
        table, floor = sent.value
        known, schema = bounds.value, to_arrow_schema(out)
        home = _plain(table.column("home"))
        block_of = home.flatten().to_numpy()
        order = np.argsort(block_of, kind="stable")
        block_of, query_of = block_of[order], np.repeat(np.arange(len(home)), home.value_lengths().to_numpy(zero_copy_only=False))[order]
        best = _Meeting(table, k, np.full(len(home), -np.inf) if floor is None else floor, schema)
        for batch in batches:
            for block, rows in _of_blocks(batch):
                met = query_of[slice(*np.searchsorted(block_of, [block, block + 1]))]
                if floor is not None:
                    reach = known.upper(best.queries, best.norms, [block])[:, 0] >= best.floor - SLACK
                    reach[met] = False
                    met = np.flatnonzero(reach)
                if len(met):
                    best.meet(_values(rows.column("id")), matrix(rows.column("vec")), met)
        yield from best.table().to_batches()

    return clustered.mapInArrow(scan, out)


def grid_shape(n_items: int, n_queries: int, width: int, k: int, tasks: int) -> tuple[int, int]:
    """Parts of the items and groups of the queries, each bounded; more of those that cost less until there is work for ``tasks``."""
    side = max(1, min(SIDE_ROWS, SIDE_BYTES // (8 * max(width, 1))))
    parts = max(1, -(-n_items // side))
    groups = max(1, -(-n_queries // max(1, min(side, WINNERS // k))))
    row = 8 * width + ROW_BYTES
    while parts * groups < tasks and (parts < n_items or groups < n_queries):
        of_groups, of_parts = groups * n_items * row, parts * n_queries * (row + k * ROW_BYTES)
        if parts >= n_items or (groups < n_queries and of_groups <= of_parts):
            groups += 1
        else:
            parts += 1
    return parts, groups


class _Part:
    """The blocks of one part, which a group of queries meets: exact top-k, a bounded number of queries at a time."""

    def __init__(self, ids: np.ndarray, x, block: np.ndarray, bounds: Bounds, k: int):
        self.k, self.order = k, np.argsort(block, kind="stable")
        block = block[self.order]
        heads = np.flatnonzero(np.diff(block, prepend=block[0] - 1))
        self.ends = np.append(heads, len(block))
        self.x, self.bounds = _rows(x, self.order), bounds.of(block[heads])
        self.bounds.rows = np.diff(self.ends)
        # ids are numbered in their order, so that ties are told apart by numbers
        self.ids, number = np.unique(ids, return_inverse=True)
        self.number = number[self.order]
        self.by_number = np.argsort(self.number, kind="stable")
        self.copies = np.bincount(self.number, minlength=len(self.ids))
        self.first = np.cumsum(self.copies) - self.copies
        with np.errstate(invalid="ignore", over="ignore"):
            self.largest = _largest(self.x) ** 2 * self.x.shape[1]
        self.first_rows = max(k + 1, FIRST_BLOCKS * -(-len(block) // len(heads)))

    def own_rows(self, exclude: pa.ChunkedArray) -> list[np.ndarray]:
        """The rows with the id that each query leaves out, -1 for none: an array for each time an id is repeated."""
        exclude = _plain(exclude)
        given = exclude.is_valid().to_numpy(zero_copy_only=False)
        wanted = _values(exclude.filter(pa.array(given)))
        at = np.minimum(np.searchsorted(self.ids, wanted), len(self.ids) - 1)
        known = self.ids[at] == wanted
        place, at = np.flatnonzero(given)[known], at[known]
        out = []
        for turn in range(int(self.copies[at].max()) if len(at) else 0):
            more = self.copies[at] > turn
            rows = np.full(len(given), -1, np.int64)
            rows[place[more]] = self.by_number[self.first[at[more]] + turn]
            out.append(rows)
        return out

    def _scores(self, queries, own, block: int) -> np.ndarray:
        lo, hi = self.ends[block], self.ends[block + 1]
        s = queries @ self.x[lo:hi].T
        if not self.clean:
            s[~np.isfinite(s)] = -np.inf
        for rows in own:
            hit = np.flatnonzero((rows >= lo) & (rows < hi))
            s[hit, rows[hit] - lo] = -np.inf
        return s

    def best(self, queries, own: list[np.ndarray]):
        """(query, row, score) of the k best rows of each query, as arrays for some queries at a time.

        Queries, like the rows of the part, are a matrix or a column of vectors as it came, of which no whole copy is made.
        """
        with np.errstate(invalid="ignore", over="ignore"):
            self.clean = max((_largest(q) for _, q in _chunks(queries)), default=0.0) ** 2 * max(self.x.shape[1], 1) * self.largest < 1e300
        step = max(1, min(QUERIES_PER_MEETING, CELLS // max(len(self.bounds.rows), self.k)))
        # queries that lie together reach the same blocks
        few = self.bounds.centres[::max(1, math.isqrt(len(self.bounds.rows)))]
        together = np.argsort(np.concatenate([np.empty(0, np.int64), *[_nearest(q, few)[0] for _, q in _chunks(queries)]]), kind="stable")
        for lo in range(0, len(queries), step):
            some = together[lo:lo + step]
            q, s, r = self._best(_rows(queries, some), [rows[some] for rows in own])
            yield some[q], self.order[r], s

    def _best(self, queries, own):
        upper = self.bounds.upper(queries, np.linalg.norm(queries, axis=1))
        floor = self._floors(queries, own, upper)
        found, kept, pending = [], (np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)), 0
        reached = np.flatnonzero(np.ascontiguousarray((upper >= (floor - SLACK)[:, None]).T))
        block, asked = np.divmod(reached, len(queries))
        heads = np.searchsorted(block, np.arange(len(self.bounds.rows) + 1))
        raised = False
        for b in np.argsort(-upper.max(axis=0), kind="stable"):
            some = asked[heads[b]:heads[b + 1]]
            if raised:
                some = some[upper[some, b] >= floor[some] - SLACK]
            if not len(some):
                continue
            for lo, hi in _slices(len(some), self.ends[b + 1] - self.ends[b], SCORES):
                few = some[lo:hi]
                s = self._scores(queries[few], [rows[few] for rows in own], b)
                at = np.flatnonzero(s >= (floor[few] - SLACK)[:, None])
                score, (r, c) = s.ravel()[at], np.divmod(at, s.shape[1])
                if not np.isfinite(floor[few]).all():
                    real = np.isfinite(score)
                    r, c, score = r[real], c[real], score[real]
                found.append((few[r], score, c + self.ends[b]))
                pending += len(r)
                if pending > max(PENDING_ROWS, len(queries) * self.k // 2):
                    kept, raised = self._settle(found, kept, floor), True
                    found, pending = [], 0
        return self._settle(found, kept, floor)

    def _floors(self, queries, own, upper) -> np.ndarray:
        """The k-th best score of each query in its best bounded blocks."""
        block, asked = np.nonzero(self.bounds.home(upper, self.first_rows).T)
        heads = np.flatnonzero(np.diff(block, prepend=-1))
        top = np.full((len(queries), self.k), -np.inf)
        for head, end in zip(heads, np.append(heads[1:], len(block))):
            b = block[head]
            for lo, hi in _slices(end - head, self.ends[b + 1] - self.ends[b], SCORES):
                some = asked[head + lo:head + hi]
                s = np.concatenate([top[some], self._scores(queries[some], [rows[some] for rows in own], b)], axis=1)
                top[some] = np.partition(s, s.shape[1] - self.k, axis=1)[:, -self.k:]
        return top.min(axis=1)

    def _settle(self, found, kept, floor):
        q, score, row = (np.concatenate([kept[i], *[f[i] for f in found]]) for i in range(3))
        order = np.lexsort((self.number[row], -(np.round(score, DECIMALS) + 0.0), q))
        q, score, row = q[order], score[order], row[order]
        place = np.arange(len(q)) - np.searchsorted(q, np.arange(len(floor)))[q]
        last = place == self.k - 1
        floor[q[last]] = np.maximum(floor[q[last]], score[last])
        top = place < self.k
        return q[top], score[top], row[top]


def _cell_keys(spark, n: int) -> list[int]:
    """An integer for each of n hash partitions, which it falls into alone."""
    wanted = spark.range(16 * n * max(1, n.bit_length())).select(F.col("id").cast("int").alias("key"))
    found = wanted.groupBy(F.pmod(F.hash("key"), F.lit(n)).alias("at")).agg(F.min("key").alias("key")).collect()
    keys = [r["key"] for r in found]
    return keys if len(keys) == n else list(range(n))


def _grid(clustered: DataFrame, queries: DataFrame, bounds, k: int, shape: tuple[int, int], out: T.StructType) -> DataFrame:
    """Every group of queries (qid, vec[, exclude_id]) meets every part of the blocks; a query meets those its floor does not exclude."""
    parts, groups = shape
    keys = F.array(*[F.lit(key) for key in _cell_keys(clustered.sparkSession, parts * groups)])

    def numbers(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def cell(part, group):
        return F.get(keys, (part * groups + group).cast("int")).alias("_cell")

    carry = [f.name for f in out.fields[3:]]
    items = clustered.select("*", F.pmod(F.xxhash64("block"), F.lit(parts)).alias("_part"), numbers(groups).alias("_group"))
    items = items.select(cell(F.col("_part"), F.col("_group")), "block", "id", "vec", *carry)
    kept = [F.col(c).alias(c) for c in queries.columns]
    asked = queries.select(*kept, F.pmod(F.xxhash64("qid"), F.lit(groups)).alias("_group"), numbers(parts).alias("_part"))
    asked = asked.select(cell(F.col("_part"), F.col("_group")), *kept)

    def meet(key, left, right):
        schema = to_arrow_schema(out)
        if not (left.num_rows and right.num_rows):
            return schema.empty_table()
        part = _Part(_values(left.column("id")), left.column("vec"), left.column("block").to_numpy(), bounds.value, k)
        own = part.own_rows(right.column("exclude_id")) if "exclude_id" in right.column_names else []
        found = list(part.best(right.column("vec"), own))
        q, row, score = (np.concatenate(side) for side in zip(*found))
        row = pa.array(row)
        return pa.table([_plain(right.column("qid")).take(pa.array(q)), _plain(left.column("id")).take(row), pa.array(score),
                         *[_plain(left.column(c)).take(row) for c in carry]], schema=schema)

    left, right = (side.repartition(parts * groups, "_cell").groupBy("_cell") for side in (items, asked))
    return left.cogroup(right).applyInArrow(meet, out)


def _floors(found: DataFrame, k: int) -> DataFrame:
    """(qid, floor): the score of each query's k-th best row so far."""
    order = [F.round("score", DECIMALS).desc(), F.col("id")]
    return top_per_group(found, ["qid"], order, k, rank="rank").filter(F.col("rank") == k).select("qid", F.col("score").alias("floor"))


class PrunedSearch:
    """One search of many queries; ``best`` has the rows, ``visits`` what was met for them.

    ``items`` is (id, vec, carry...), ``queries`` is (qid, vec[, exclude_id]), both written and without null vectors.
    ``travelling`` says that the queries are few enough to go to every task; nothing is carried then.
    """

    def __init__(self, items: DataFrame, queries: DataFrame, k: int, n_items: int, n_queries: int, travelling: bool, tasks: int,
                 n_blocks: int | None = None, carry=()):
        self.k, self.travelling, self.queries = k, travelling, queries
        if not travelling:
            # every further cell is paid with copies, so there are as many as can run at once, blocks small enough to fill the parts evenly
            width = items.agg(F.max(F.size("vec"))).first()[0] or 1
            self.shape = grid_shape(n_items, n_queries, width, k, min(tasks, items.sparkSession.sparkContext.defaultParallelism))
            n_blocks = n_blocks and min(MAX_BLOCKS, max(n_blocks, 16 * self.shape[0]))
            tasks = None
        self.clustered, known = cluster(items, n_items, n_blocks, tasks, carry)
        self.bounds = items.sparkSession.sparkContext.broadcast(known)
        self.out = T.StructType([queries.schema["qid"], items.schema["id"], T.StructField("score", T.DoubleType()),
                                 *[items.schema[c] for c in carry]])
        if travelling:
            # one row more than asked for, as a query may leave one out
            self.queries = write_and_read(with_home(queries, self.bounds, k + 1), "homes")
            self.local = self.queries.toArrow()
            self.first = write_and_read(_scan(self.clustered, self.local, None, self.bounds, k, self.out), "first")
            self.floors = write_and_read(_floors(self.first, k), "floors")

    def with_floors(self) -> DataFrame:
        """Queries with home and floor: that of the first blocks, or of all where queries do not travel."""
        queries = self.queries if self.travelling else with_home(self.queries, self.bounds, self.k + 1)
        floors = self.floors if self.travelling else _floors(self.best(), self.k)
        return queries.join(floors, "qid", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))

    def best(self) -> DataFrame:
        """(qid, id, score[, carry...]) candidates that hold every query's k best rows."""
        if not self.travelling:
            return _grid(self.clustered, self.queries, self.bounds, self.k, self.shape, self.out)
        known = self.floors.toPandas().set_index("floor")["qid"]
        at = pd.Index(self.local.column("qid").to_pandas()).get_indexer(known.to_numpy())
        floor = np.full(self.local.num_rows, -np.inf)
        floor[at] = known.index.to_numpy()
        return self.first.unionByName(_scan(self.clustered, self.local, floor, self.bounds, self.k, self.out))

    def visits(self) -> DataFrame:
        """(qid, n_blocks, n_visited) by the floors of ``with_floors``; floors that rise within a task exclude more."""
        return block_visits(self.with_floors(), self.bounds)
