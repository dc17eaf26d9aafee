"""SentencePiece encoding and decoding by batched Viterbi.

Distinct units of equal length advance together: prefix hashes give the hash of every substring,
which is looked up in the sorted hashes of the pieces of that length; maxima over the start
positions are taken for all units at once and store the backpointers.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from cadenza.llm.common import WordCache, id_and_text, mix64, powers, share, text_blocks
from cadenza.llm.pieces import Vocabulary

ROOT = 0x2545F4914F6CDD1D
#: Units that advance in one array, and characters they have together.
ROWS, CELLS = 8192, 1 << 19


def _points(texts: list[str], length: int) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).reshape(len(texts), length)


def _prefixes(points: np.ndarray) -> np.ndarray:
    terms = mix64(points.astype(np.uint64) + np.uint64(1)) * powers(ROOT, points.shape[1])
    sums = np.zeros((points.shape[1] + 1, points.shape[0]), np.uint64)
    np.cumsum(terms.T, axis=0, out=sums[1:])
    return sums


class Encoder:
    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.tables: dict[int, tuple] = {}
        by_length: dict[int, list] = {}
        for piece, i in vocabulary.usable.items():
            by_length.setdefault(len(piece), []).append((piece, i))
        for length, entries in by_length.items():
            keys = _prefixes(_points([p for p, _ in entries], length))[length]
            order = np.argsort(keys)
            if len(np.unique(keys)) < len(keys):
                raise ValueError("two pieces share a hash")
            ids = np.array([i for _, i in entries], np.int32)[order]
            self.tables[length] = (keys[order], ids, np.array([vocabulary.best[i] for i in ids.tolist()], float))
        self.lengths = sorted(self.tables)
        self.back_root = pow(ROOT, -1, 1 << 64)

    def encode_units(self, units: list[str]) -> list[list[int]]:
        out: list = [None] * len(units)
        by_length: dict[int, list[int]] = {}
        for n, unit in enumerate(units):
            by_length.setdefault(len(unit), []).append(n)
        for length, numbers in by_length.items():
            step = max(1, min(ROWS, CELLS // length))
            for at in range(0, len(numbers), step):
                some = numbers[at:at + step]
                for n, ids in zip(some, self._batch([units[n] for n in some], length)):
                    out[n] = ids
        return out

    def _matches(self, sums: np.ndarray, length: int) -> dict[int, tuple]:
        """By piece length: (ids or -1, scores or -inf) of the substrings from every position, for all units."""
        inverse = powers(self.back_root, length + 1)[:, None]
        found = {}
        for size in self.lengths:
            if size > length:
                break
            keys, ids, scores = self.tables[size]
            wanted = (sums[size:] - sums[:-size]) * inverse[:length - size + 1]
            spot = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            match = keys[spot] == wanted
            if size == 1:
                # a character that is no piece is unknown
                found[1] = np.where(match, ids[spot], -1), np.where(match, scores[spot], self.vocabulary.unknown_score)
            elif match.any():
                found[size] = np.where(match, ids[spot], -1), np.where(match, scores[spot], -np.inf)
        if 1 not in found:
            found[1] = np.full((length, sums.shape[1]), -1), np.full((length, sums.shape[1]), self.vocabulary.unknown_score)
        return found

    def _batch(self, units: list[str], length: int) -> list[list[int]]:
        rows = len(units)
        found = self._matches(_prefixes(_points(units, length)), length)
        # longest pieces first: of equal scores the earliest start stays
        found = sorted(((size, *f, (f[1] > -np.inf).any(axis=1)) for size, f in found.items()), reverse=True,
                       key=lambda f: f[0])
        best = np.full((length + 1, rows), -np.inf, np.float32)
        best[0] = 0
        start = np.full((length + 1, rows), -1, np.int32)
        piece = np.full((length + 1, rows), -1, np.int32)
        for end in range(1, length + 1):
            for size, ids, scores, some in found:
                begin = end - size
                if begin < 0 or not some[begin]:
                    continue
                # sums are compared and kept in single precision, as the library does
                value = (best[begin] + scores[begin]).astype(np.float32)
                better = value > best[end]
                np.copyto(best[end], value, where=better)
                np.copyto(start[end], begin, where=better)
                np.copyto(piece[end], ids[begin], where=better, casting="unsafe")
        return self._trace(units, start, piece, length)

    def _trace(self, units, start, piece, length) -> list[list[int]]:
        rows = np.arange(len(units))
        at = np.full(len(units), length)
        steps, begins = [], []
        while (at > 0).any():
            live = at > 0
            steps.append(np.where(live, piece[at, rows], -2))
            at = np.where(live, start[at, rows], 0)
            begins.append(at)
        found = np.array(steps[::-1]).T.tolist()
        where = np.array(begins[::-1]).T.tolist()
        out = []
        for unit, ids, starts in zip(units, found, where):
            if -1 not in ids:
                out.append([i for i in ids if i >= 0])
                continue
            whole, after_unknown = [], False
            for i, s in zip(ids, starts):
                if i >= 0:
                    whole.append(i)
                elif i == -1 and (self.vocabulary.byte_ids or not after_unknown):
                    whole.extend(self.vocabulary.unknown_ids(unit[s]))
                after_unknown = i == -1
            out.append(whole)
        return out


def _of_texts(texts: list, vocabulary: Vocabulary, cache: WordCache) -> list[list[int]]:
    """Places in the cache of each text's units; new units of all texts are computed together."""
    units = [vocabulary.units(t or "") for t in texts]
    index = cache.index([u for of_text in units for u in of_text]).tolist()
    ends = np.cumsum([len(u) for u in units]).tolist()
    return [index[end - len(u):end] for u, end in zip(units, ends)]


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids): the piece ids of every text; null for a null text, none for an empty one."""
    shared = share(docs, vocabulary)

    def run(batches):
        vocabulary = shared()
        encoder = Encoder(vocabulary)
        cache = WordCache(encoder.encode_units)
        for part in text_blocks(batches):
            texts = part.column("text").to_pylist()
            ids = [None if text is None else [i for u in index for i in cache.values[u]]
                   for text, index in zip(texts, _of_texts(texts, vocabulary, cache))]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))],
                                             ["doc_id", "ids"])

    kind = StructType([*id_and_text(docs).schema.fields[:1], StructField("ids", ArrayType(IntegerType()))])
    return id_and_text(docs).mapInArrow(run, kind)


def decode(tokens: DataFrame, vocabulary: Vocabulary, ids: str | Column = "ids") -> DataFrame:
    """(doc_id, text) of (doc_id, ids); null for null ids."""
    shared = share(tokens, vocabulary)

    def run(batches):
        vocabulary = shared()
        for batch in batches:
            texts = [None if x is None else vocabulary.restore(vocabulary.decode_unit(x))
                     for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             ["doc_id", "text"])

    picked = tokens.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                           (F.col(ids) if isinstance(ids, str) else ids).alias("ids"))
    kind = StructType([picked.schema.fields[0], StructField("text", StringType())])
    return picked.mapInArrow(run, kind)


def round_trip(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per document: doc_id, n_tokens, n_byte_tokens, ids_sha256, decoded_sha256, exact.

    ``ids_sha256`` is over the ids as 32-bit little-endian integers, ``decoded_sha256`` over the text
    that decoding them gives; ``exact`` says whether that is the text itself (a literal U+2581 comes
    back as a space). Null and empty texts have no tokens and decode to nothing. Ids and
    decoded texts of a unit are made once per task; a document's are those of its units in turn.
    """
    shared = share(docs, vocabulary)
    kind = ("doc_id bigint, n_tokens bigint, n_byte_tokens bigint, ids_sha256 string, "
            "decoded_sha256 string, exact boolean")

    def run(batches):
        vocabulary = shared()
        encoder = Encoder(vocabulary)

        def both(units):
            out = []
            for ids in encoder.encode_units(units):
                out.append((np.array(ids, "<i4").tobytes(), sum(i in vocabulary.byte_of for i in ids),
                            vocabulary.decode_unit(ids)))
            return out

        cache = WordCache(both)
        for part in text_blocks(batches):
            rows, texts = [], [t or "" for t in part.column("text").to_pylist()]
            for text, index in zip(texts, _of_texts(texts, vocabulary, cache)):
                parts = [cache.values[u] for u in index]
                ids = b"".join([p[0] for p in parts])
                back = vocabulary.restore("".join([p[2] for p in parts]))
                rows.append((len(ids) // 4, sum([p[1] for p in parts]), hashlib.sha256(ids).hexdigest(),
                             hashlib.sha256(back.encode()).hexdigest(), back == text))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                pa.array(columns[2]), pa.array(columns[3]), pa.array(columns[4])],
                ["doc_id", "n_tokens", "n_byte_tokens", "ids_sha256", "decoded_sha256", "exact"])

    return id_and_text(docs).mapInArrow(run, kind)
