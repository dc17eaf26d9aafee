"""Benchmark decontamination by Wu-Manber search.

Test strings are the benchmark's word windows written as " w1 w2 .. wn ", so that an occurrence
starts and ends at word borders. They are split into classes by length; every class has a shift
table over hashed blocks of bytes: a text position whose block is in no test string is skipped as
far as the shortest test string of the class allows. Where the shift is 0, the block's hash selects
a bucket of test strings, which are compared directly, byte by byte.

Texts of a block of documents lie in one buffer; many cursors, each on its own stretch of it, move
together, each by its own shift.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import id_and_text, lower_ascii, raw_texts, share, text_blocks
from cadenza.session import write_and_read

WINDOW = 10
#: Windows whose text is held by one broadcast search table; more are searched in several rounds.
TABLE_BYTES = 32 << 20
STRETCH = 512
#: Sizes of a shift table, as powers of two; it gets SLOTS places for each block it holds, up to the larger.
TABLE_BITS, SLOTS = (14, 22), 16
#: Test strings of at least so many bytes share a shift table.
CLASSES = (3, 8, 16, 32, 64)

SCHEMA = ("doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, "
          "contaminated boolean")


def _word_bytes() -> np.ndarray:
    flags = np.zeros(256, bool)
    flags[0x30:0x3A] = flags[0x41:0x5B] = flags[0x61:0x7B] = flags[0x80:] = True
    return flags


_MAP = bytes(np.where(_word_bytes(), lower_ascii(), 0x20).astype(np.uint8))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_MAP).split()


def windows(items, size: int = WINDOW) -> dict[bytes, list]:
    """Test string -> item ids, of every window of every (item_id, text)."""
    found: dict[bytes, list] = {}
    for item, text in items:
        words = words_of((text or "").encode())
        for i in range(max(1, len(words) - size + 1) if words else 0):
            owners = found.setdefault(b" " + b" ".join(words[i:i + size]) + b" ", [])
            if not owners or owners[-1] != item:
                owners.append(item)
    return found


def _block_hash(values: np.ndarray, bits: int) -> np.ndarray:
    return ((values * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)


def _eights(buffer: np.ndarray) -> np.ndarray:
    """The 8 bytes from every position, as one integer; the buffer ends with 8 spare bytes."""
    return np.ndarray(max(0, len(buffer) - 7), np.uint64, buffer, strides=(1,))


class LengthClass:
    """Shift table and suffix buckets of test strings that have ``shortest`` bytes or more."""

    def __init__(self, strings: list[bytes], numbers: list[int]):
        self.strings, self.numbers = strings, np.array(numbers, np.int64)
        self.shortest = min(map(len, strings))
        self.block = min(8, self.shortest)
        self.mask = np.uint64((1 << (8 * self.block)) - 1)
        last = self.shortest - self.block
        self.bits = min(max(TABLE_BITS[0], (SLOTS * (last + 1) * len(strings)).bit_length()), TABLE_BITS[1])
        heads = np.frombuffer(b"".join(s[:self.shortest] for s in strings) + bytes(8), np.uint8)
        at = np.arange(len(strings), dtype=np.int64) * self.shortest
        self.shift = np.full(1 << self.bits, last + 1, np.int32)
        eights = _eights(heads)
        for i in range(last + 1):
            hashed = _block_hash(eights[at + i] & self.mask, self.bits)
            np.minimum.at(self.shift, hashed, last - i)
        ends = _block_hash(eights[at + last] & self.mask, self.bits)
        order = np.argsort(ends, kind="stable")
        self.bucket_strings = order
        self.bucket_ends = np.cumsum(np.bincount(ends, minlength=1 << self.bits)).astype(np.int32)
        padded = np.frombuffer(b"".join(s[:8].ljust(8, b"\1") for s in strings) + bytes(8), np.uint8)
        self.heads = _eights(padded)[np.arange(len(strings)) * 8]
        self.head_masks = np.array([(1 << (8 * min(8, len(s)))) - 1 for s in strings], np.uint64)
        self.heads &= self.head_masks

    def search(self, buffer: np.ndarray, data: bytes, size: int):
        """(start, test string number) of all occurrences in the first ``size`` bytes."""
        eights, last = _eights(buffer), self.shortest - self.block
        stop_at = size - self.shortest
        if stop_at < 0:
            return []
        at = np.arange(0, stop_at + 1, STRETCH, dtype=np.int64)
        end = np.minimum(at + STRETCH, stop_at + 1)
        spots, hashes = [], []
        while len(at):
            hashed = _block_hash(eights[at + last] & self.mask, self.bits)
            shift = self.shift[hashed]
            hit = shift == 0
            if hit.any():
                spots.append(at[hit])
                hashes.append(hashed[hit])
            at = at + np.maximum(shift, 1)
            alive = at < end
            if not alive.all():
                at, end = at[alive], end[alive]
        if not spots:
            return []
        spots, hashes = np.concatenate(spots), np.concatenate(hashes)
        low = np.where(hashes > 0, self.bucket_ends[hashes - 1], 0)
        count = self.bucket_ends[hashes] - low
        which = np.repeat(np.arange(len(spots)), count)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        string = self.bucket_strings[low[which] + offset]
        start = spots[which]
        near = (eights[start] & self.head_masks[string]) == self.heads[string]
        out = []
        for p, s in zip(start[near].tolist(), string[near].tolist()):
            text = self.strings[s]
            if data.startswith(text, p, size):
                out.append((p, int(self.numbers[s])))
        return out


class Searcher:
    def __init__(self, strings: list[bytes]):
        self.lengths = [s.count(b" ") - 1 for s in strings]
        self.classes = []
        for low, high in zip(CLASSES, (*CLASSES[1:], 1 << 62)):
            picked = [i for i, s in enumerate(strings) if low <= len(s) < high]
            if picked:
                self.classes.append(LengthClass([strings[i] for i in picked], picked))

    def search(self, texts: list[bytes]):
        """Per text: (number of words, [(first word, number of words, test string number)])."""
        norm = [b" " + b" ".join(words_of(t)) + b" " for t in texts]
        data = b"\0".join(norm)
        buffer = np.frombuffer(data + bytes(8), np.uint8)
        starts = np.cumsum([0] + [len(t) + 1 for t in norm])
        counts = [t.count(b" ") - 1 if len(t) > 2 else 0 for t in norm]
        out = [(n, []) for n in counts]
        hits = [h for c in self.classes for h in c.search(buffer, data, len(data))]
        if hits:
            at = np.array([p for p, _ in hits])
            rows = np.searchsorted(starts, at, "right") - 1
            order = np.argsort(rows, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(rows[order])) + 1):
                row = int(rows[some[0]])
                spaces = np.flatnonzero(np.frombuffer(norm[row], np.uint8) == 0x20)
                firsts = np.searchsorted(spaces, at[some] - starts[row])
                out[row][1].extend((int(f), self.lengths[hits[i][1]], hits[i][1]) for f, i in zip(firsts, some))
        return out


def _find(docs: DataFrame, id_column: str, found: dict[bytes, list]) -> DataFrame:
    """(id, n_words, first words, word counts, items) per row for one table of test strings."""
    strings = sorted(found)
    table = share(docs, (strings, [found[s] for s in strings]))
    # item ids travel as text; their order and digest are those of strings
    kind = "id bigint, n_words bigint, at array<bigint>, len array<bigint>, items array<string>"

    def run(batches):
        strings, owners = table()
        searcher = Searcher(strings)
        for part in text_blocks(batches):
            rows = searcher.search(raw_texts(part.column("text")))
            yield pa.RecordBatch.from_arrays([
                part.column(id_column).cast(pa.int64()),
                pa.array([n for n, _ in rows], pa.int64()),
                pa.array([[h[0] for h in hits] for _, hits in rows], pa.list_(pa.int64())),
                pa.array([[h[1] for h in hits] for _, hits in rows], pa.list_(pa.int64())),
                pa.array([sorted({str(i) for h in hits for i in owners[h[2]]}) for _, hits in rows],
                         pa.list_(pa.string())),
            ], ["id", "n_words", "at", "len", "items"])

    return docs.select(id_column, "text").mapInArrow(run, kind)


def _digest(rows: DataFrame) -> DataFrame:
    """Turns occurrences into the result columns."""
    def run(batches):
        for batch in batches:
            n_hit = []
            for at, length in zip(batch.column("at").to_pylist(), batch.column("len").to_pylist()):
                covered, reach = 0, 0
                for start, n in sorted(zip(at, length)):
                    covered += max(0, start + n - max(start, reach))
                    reach = max(reach, start + n)
                n_hit.append(covered)
            items = [sorted(set(x)) for x in batch.column("items").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), batch.column("n_words"), pa.array(n_hit, pa.int64()),
                pa.array([len(x) for x in items], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                pa.array([n > 0 for n in n_hit]),
            ], ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])

    return rows.select("doc_id", "n_words", "at", "len", "items").mapInArrow(run, SCHEMA)


def _tables(benchmark: DataFrame, size: int, table_bytes: int):
    """Test strings in tables of bounded size; each is read, used and forgotten in turn.

    One item lies in one table. Windows overlap, so an item's windows hold its text ``size`` times.
    """
    items = benchmark.select(F.col("item_id"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0] * size
    parts = max(1, -(-total // table_bytes))
    for part in range(parts):
        of_part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part)
        yield parts, windows(((str(r[0]), r[1]) for r in of_part.toLocalIterator()), size)


def occurrences(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(doc_id, n_words, at, len, items): the word ranges of every occurrence, and the items found.

    While the test strings fit one table, documents are read once and nothing is shuffled. Beyond
    that, rows get a written number, every table is searched in turn, and hits meet by that number.
    """
    docs, tables = id_and_text(docs), _tables(benchmark, size, table_bytes)
    parts, found = next(tables)
    if parts == 1:
        return _find(docs, "doc_id", found).withColumnRenamed("id", "doc_id")
    rows = write_and_read(docs.withColumn("rid", F.monotonically_increasing_id()), "op7-rows")
    hits = _find(rows, "rid", found)
    for _, found in tables:
        hits = hits.unionByName(_find(rows, "rid", found))
    merged = hits.groupBy("id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("at")).alias("at"),
        F.flatten(F.collect_list("len")).alias("len"), F.flatten(F.collect_list("items")).alias("items"))
    return rows.select(F.col("rid").alias("id"), "doc_id").join(merged, "id").drop("id")


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW,
                  table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Null or word-free texts have no words and no hits; null or word-free items have no windows, so
    an empty benchmark leaves every document clean. Equal windows of several items count for each.
    Repeated documents give a row each; an empty table gives an empty table; other columns are ignored.
    """
    return _digest(occurrences(docs, benchmark, size, table_bytes))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """Rows of ``docs`` in which no window of the benchmark occurs, with all their columns."""
    rows = write_and_read(docs.select(F.monotonically_increasing_id().alias("rid"),
                                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), "op7-docs")
    hits = occurrences(rows.select(F.col("rid").alias("doc_id"), F.col("row.text").alias("text")), benchmark, size)
    dirty = hits.filter(F.size("at") > 0).select(F.col("doc_id").alias("rid"))
    return rows.join(dirty, "rid", "left_anti").select("row.*")
