"""Helpers shared by the training-data operators: text blocks, word tables, hashing, word caches."""

from __future__ import annotations

import pickle
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

#: Text bytes that one numpy block works on; bounds the memory of a task, whatever the batch size.
BLOCK_BYTES = 2 << 20
#: Bytes between words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share(df: DataFrame, value):
    """A function that gives ``value`` in any task: broadcast with its classes, so nothing need be installed there.

    For values of bounded size only: models, vocabularies, search tables.
    """
    sent = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns operators read; all others, whatever their names, are left out."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_blocks(batches, column: str = "text", limit: int = BLOCK_BYTES):
    """Slices of Arrow batches with about ``limit`` bytes of text each, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes.astype(np.int64)), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def raw_texts(column) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit words (splitmix64's finalizer)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ROOT = np.uint64(0x9E3779B97F4A7C15 | 1)
_BYTE_KEYS = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_POWERS = {}


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def powers(root: int, n: int) -> np.ndarray:
    """root ** 0, 1, ... n - 1 modulo 2 ** 64."""
    known = _POWERS.get(root)
    if known is None or len(known) < n:
        steps = np.full(max(n, 1 << 16), np.uint64(root))
        steps[0] = 1
        known = _POWERS[root] = np.multiply.accumulate(steps)
    return known[:n]


class Words:
    """Words of a block of texts as byte ranges, with a 64-bit hash each.

    ``first[d]`` .. ``first[d + 1]`` are the words of row ``d``. Words are maximal runs of bytes
    that ``separator`` (256 flags) leaves out; ``change`` maps bytes before hashing.
    """

    def __init__(self, texts: list[bytes], separator: np.ndarray, change: np.ndarray | None = None):
        joined = b" ".join(texts)
        raw = np.frombuffer(joined, np.uint8)
        self.bytes = raw if change is None else change[raw]
        inside = np.empty(len(raw) + 2, bool)
        inside[0] = inside[-1] = False
        np.logical_not(separator[self.bytes], out=inside[1:-1])
        ends = np.cumsum([len(t) + 1 for t in texts])
        starts_at = ends - [len(t) + 1 for t in texts]
        # texts are joined by a space, which always separates
        self.starts = np.flatnonzero(inside[1:-1] & ~inside[:-2])
        self.ends = np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        self.first = np.append(np.searchsorted(self.starts, starts_at), len(self.starts))

    def hashes(self) -> np.ndarray:
        size = len(self.bytes)
        terms = _BYTE_KEYS[self.bytes]
        terms *= powers(int(_ROOT), size)
        sums = np.empty(size + 1, np.uint64)
        sums[0] = 0
        np.cumsum(terms, out=sums[1:])
        back = powers(_inverse(int(_ROOT)), size)
        return mix64((sums[self.ends] - sums[self.starts]) * (back[self.starts] if size else np.empty(0, np.uint64)))


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes; empty if there are fewer."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    root = 0xA0761D6478BD642F
    terms = words * powers(root, len(words))
    sums = np.empty(len(words) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(terms, out=sums[1:])
    back = powers(_inverse(root), len(words))[: len(words) - n + 1]
    return mix64((sums[n:] - sums[:-n]) * back + np.uint64(n))


def white_separator() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[list(WHITE_BYTES)] = True
    return flags


def lower_ascii() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


class WordCache:
    """Rows computed once per distinct word of a task; forgotten when ``limit`` words are known.

    ``compute`` maps a list of new words to a list or array of values, one per word.
    """

    def __init__(self, compute, limit: int = 700_000):
        self.compute, self.limit = compute, limit
        self.ids, self.values = {}, None

    def index(self, words: list) -> np.ndarray:
        if len(self.ids) > self.limit:
            self.ids, self.values = {}, None
        known, ids = len(self.ids), self.ids
        place = ids.setdefault
        index = np.fromiter((place(w, len(ids)) for w in words), np.int64, len(words))
        if len(ids) > known or self.values is None:
            fresh = self.compute(list(islice(ids, known, None)))
            if self.values is None:
                self.values = fresh
            elif isinstance(fresh, np.ndarray):
                self.values = np.concatenate([self.values, fresh])
            else:
                self.values.extend(fresh)
        return index
