"""Character n-grams of long texts in numpy: blocks of words are cut once per distinct word, and counted per text by a sort.

A gram of a block is a 64-bit number of four characters, which are numbered by the block's or the vocabulary's alphabet;
nothing is hashed, so that no two grams are taken for one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from cadenza.functions.text import GRAM_SIZES, words
from cadenza.operators.kernels import DECIMALS, SLACK, _plain

#: Words of a block, and grams of its texts that are sorted together, at least those of one text.
BLOCK_WORDS, CHUNK_GRAMS = 400_000, 1_500_000
#: Numbers of characters: 0 stands for none, the last for all that an alphabet lacks.
LACKING = 0xFFFF
#: Bits of a count beside its text and gram; larger counts are several.
COUNT_BITS = 20
#: Cells of a table that finds the different values of an array, per value of it at most.
TABLE_CELLS = 8
#: Cells of one array of texts x grams of queries, and of texts x queries.
CELLS = 4_000_000


class Alphabet:
    """Numbers 1, 2, ... of the code points of some text."""

    def __init__(self, points: np.ndarray):
        seen = np.zeros(0x110000, bool)
        seen[points] = True
        self.points = np.flatnonzero(seen).astype(np.uint32)
        self.fits = len(self.points) < LACKING
        self.number = np.full(0x110000, LACKING, np.uint64)
        if self.fits:
            self.number[self.points] = np.arange(1, len(self.points) + 1)

    def keys(self, points: np.ndarray) -> list[np.ndarray]:
        """The number of the gram of each size that begins at each place; the last places are of no use."""
        codes = np.concatenate([self.number[points], np.zeros(GRAM_SIZES[1], np.uint64)])
        out, key = [], codes[:len(points)].copy()
        for n in range(2, GRAM_SIZES[1] + 1):
            key |= codes[n - 1:len(points) + n - 1] << np.uint64(16 * (n - 1))
            if n >= GRAM_SIZES[0]:
                out.append(key.copy())
        return out

    def strings(self, keys: np.ndarray) -> pa.Array:
        """The grams of some keys."""
        codes = np.stack([(keys >> np.uint64(16 * i)) & np.uint64(0xFFFF) for i in range(GRAM_SIZES[1])], axis=1).ravel()
        points = self.points[codes[codes > 0].astype(np.int64) - 1]
        sizes = 1 + (points > 0x7F).astype(np.int64) + (points > 0x7FF) + (points > 0xFFFF)
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum((codes > 0).reshape(len(keys), -1).sum(axis=1))])]
        raw = points.astype("<u4").tobytes().decode("utf-32-le").encode()
        return pa.Array.from_buffers(pa.string(), len(keys), [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])


def _different(values: np.ndarray, size: int, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the different ones among some of the values, which are below ``size``, and for each value its place there, -1 if it has none."""
    if size > TABLE_CELLS * len(values) + 65_536:
        _, place, number = np.unique(values[some], return_index=True, return_inverse=True)
        out = np.full(len(values), -1)
        out[some] = number
        return some[place], out
    place = np.full(size, -1)
    place[values[some]] = some
    met = np.flatnonzero(place >= 0)
    number = np.full(size, -1)
    number[met] = np.arange(len(met))
    out = number[values]
    return place[met], out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def joined_points(grams: pa.Array) -> np.ndarray:
    ends = np.frombuffer(grams.buffers()[1], np.int32)[grams.offset:grams.offset + len(grams) + 1] if len(grams) else [0, 0]
    return code_points(bytes(memoryview(grams.buffers()[2] or b"")[ends[0]:ends[-1]]).decode())


def keys_of(grams: pa.Array, alphabet: Alphabet) -> np.ndarray:
    """The key of each gram, none of which is null."""
    size = pc.utf8_length(grams).to_numpy().astype(np.int64)
    keys = alphabet.keys(joined_points(grams))
    out = np.empty(len(size), np.uint64)
    for n in range(GRAM_SIZES[0], GRAM_SIZES[1] + 1):
        some = np.flatnonzero(size == n)
        out[some] = keys[n - GRAM_SIZES[0]][(np.cumsum(size) - size)[some]]
    return out


def blocks(batches):
    """Slices of batches with about BLOCK_WORDS words in their column ``words``, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.list_value_length(batch.column("words")), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes.astype(np.int64)), 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + BLOCK_WORDS, "right")))
            yield batch.slice(start, stop - start)
            start = stop


class Block:
    """The words of some texts, each distinct one once."""

    def __init__(self, lists: pa.Array):
        lists = _plain(lists)
        sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        self.words = coded.dictionary
        n_words = max(len(self.words), 1)
        pair = np.sort(np.repeat(np.arange(len(sizes)), sizes) * n_words + coded.indices.to_numpy().astype(np.int64))
        heads = np.flatnonzero(np.diff(pair, prepend=-1))
        self.text, self.word = np.divmod(pair[heads], n_words)
        self.times = np.diff(np.append(heads, len(pair)))
        self.points = code_points(f" {pc.binary_join(pa.array([self.words], pa.list_(pa.string())), ' ')[0].as_py()} ")

    def cut(self, alphabet: Alphabet):
        """The keys of the block's grams, and a function that gives (text, place of the gram, count) for some texts at a time."""
        codes, keys = alphabet.number[self.points].astype(np.int64), alphabet.keys(self.points)
        low, high = GRAM_SIZES
        # a gram is told by the one before it that is shorter and its last character; a blank is at its ends only
        count, blank, some = len(alphabet.points) + 2, self.points == 32, np.arange(len(codes))
        codes[codes == LACKING] = count - 1
        shorter, different, found, known = codes, count, [], []
        for n in range(2, high + 1):
            some = some[some < len(codes) - n + 1]
            if n > 2:
                some = some[~blank[some + n - 2]]
            values = np.zeros(len(codes), np.int64)
            values[some] = shorter[some] * count + codes[some + n - 1]
            place, shorter = _different(values, different * count, some)
            different = len(place)
            if n >= low:
                found.append(keys[n - low][place])
                known.append(shorter + sum(map(len, found[:-1])))
        # a word has one blank on either side, which its neighbours share
        size = pc.utf8_length(self.words).to_numpy().astype(np.int64) + 2
        begin = np.cumsum(size - 1) - (size - 1)
        each = np.stack([np.maximum(size - n + 1, 0) for n in range(low, high + 1)], axis=1)
        starts = np.concatenate([[0], np.cumsum(each.sum(axis=1))])
        flat = each.ravel()
        # the places of a size of gram lie behind those of the size before
        shift = (begin[:, None] + np.arange(high + 1 - low) * len(codes)).ravel()
        place = np.arange(starts[-1]) + np.repeat(shift - (np.cumsum(flat) - flat), flat)
        grams, number = np.concatenate(found), np.concatenate(known)[place]
        return grams, lambda: self._counted(grams, number, starts)

    def _counted(self, grams, number, starts):
        mask = (1 << COUNT_BITS) - 1
        text, word, times = self.text, self.word, self.times
        if len(times) and times.max() > mask:
            more = -(-times // mask)
            last = times - (more - 1) * mask
            text, word = np.repeat(text, more), np.repeat(word, more)
            times = np.full(len(text), mask)
            times[np.cumsum(more) - 1] = last
        width = starts[word + 1] - starts[word]
        upto = np.cumsum(width)
        heads = np.flatnonzero(np.diff(text, prepend=-1))
        ends = np.append(heads[1:], len(text))
        at = 0
        while at < len(heads):
            lo = heads[at]
            base = upto[lo - 1] if lo else 0
            stop = max(at + 1, int(np.searchsorted(upto[ends - 1], base + CHUNK_GRAMS, "right")))
            some = slice(lo, ends[stop - 1])
            w = width[some]
            key = np.repeat((text[some] * len(grams) << COUNT_BITS) + times[some], w)
            key += number[np.arange(w.sum()) + np.repeat(starts[word[some]] - (upto[some] - w - base), w)] << COUNT_BITS
            key.sort()
            pair = key >> COUNT_BITS
            first = np.flatnonzero(np.diff(pair, prepend=-1))
            tf = np.add.reduceat(key & mask, first) if len(first) else key
            yield *np.divmod(pair[first], len(grams)), tf
            at = stop


def _one_by_one(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(gram, text) of a block with more characters than can be numbered."""
    words, found = block.words.to_pylist(), set()
    for text, word in zip(block.text.tolist(), block.word.tolist()):
        w = f" {words[word]} "
        found.update((w[i:i + n], text) for n in range(GRAM_SIZES[0], GRAM_SIZES[1] + 1) for i in range(len(w) - n + 1))
    grams, texts = zip(*found)
    return pa.array(grams, pa.string()), np.array(texts)


def document_frequencies(texts: DataFrame, text: str, weight=None) -> DataFrame:
    """(gram, df): how many rows, or how much of their ``weight``, have a gram. A row is a text of its own."""
    def run(batches):
        for part in blocks(batches):
            block = Block(part.column("words"))
            if not len(block.words):
                continue
            n, alphabet = part.column("n").to_numpy(), Alphabet(block.points)
            if alphabet.fits:
                keys, counted = block.cut(alphabet)
                df = np.zeros(len(keys))
                for rows, gram, _ in counted():
                    df += np.bincount(gram, n[rows], len(keys))
                grams = alphabet.strings(keys)
            else:
                grams, rows = _one_by_one(block)
                df = n[rows]
            yield pa.RecordBatch.from_arrays([grams, pa.array(df.astype(np.int64))], ["gram", "df"])

    n = F.lit(1) if weight is None else weight
    cut = texts.select(words(F.lower(text)).alias("words"), n.cast("bigint").alias("n")).mapInArrow(run, "gram string, df bigint")
    return cut.groupBy("gram").agg(F.sum("df").alias("df"))


class Vocabulary:
    """Fitted grams in the order of their keys, with their weights."""

    def __init__(self, fitted: pa.Table):
        grams = _plain(fitted.column("gram"))
        self.alphabet = Alphabet(joined_points(grams))
        if not self.alphabet.fits:
            return
        keys = keys_of(grams, self.alphabet)
        order = np.argsort(keys)
        self.keys, self.idf = keys[order], fitted.column("idf").to_numpy()[order]

    def sent(self):
        """What tasks need, without the table of all code points."""
        return self.keys, self.idf, self.alphabet.points

    def places(self, keys: np.ndarray) -> np.ndarray:
        """Places of some keys, -1 for those that are not fitted."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1) if len(self.keys) else np.full(len(keys), -1)

    @staticmethod
    def received(sent) -> "Vocabulary":
        out = Vocabulary.__new__(Vocabulary)
        out.keys, out.idf, points = sent
        out.alphabet = Alphabet(points)
        return out

    def weighed(self, block: Block):
        """(texts, ends, places, weights): weights of the fitted grams of some texts that have any, each text up to its end, not of length 1 yet; lengths last."""
        keys, counted = block.cut(self.alphabet)
        known = self.places(keys)
        for rows, gram, tf in counted():
            place = known[gram]
            given = place >= 0
            rows, place, tf = rows[given], place[given], tf[given]
            heads = np.flatnonzero(np.diff(rows, prepend=-1))
            if not len(heads):
                continue
            w = (1.0 + np.log(tf)) * self.idf[place]
            yield rows[heads], np.append(heads[1:], len(rows)), place, w, np.sqrt(np.add.reduceat(w * w, heads))


def unit_vectors(texts: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> DataFrame:
    """(key, grams, weights): one unit-length sparse row per row of ``texts`` that has a fitted gram."""
    shared = texts.sparkSession.sparkContext.broadcast(vocabulary.sent())
    out = T.StructType([texts.schema[key], T.StructField("grams", T.ArrayType(T.StringType())), T.StructField("weights", T.ArrayType(T.DoubleType()))])

    def run(batches):
        fitted = Vocabulary.received(shared.value)
        schema = to_arrow_schema(out)
        for part in blocks(batches):
            block = Block(part.column("words"))
            if not len(block.words):
                continue
            for rows, ends, place, w, norm in fitted.weighed(block):
                sizes = np.diff(ends, prepend=0)
                used, at = np.unique(place, return_inverse=True)
                grams = fitted.alphabet.strings(fitted.keys[used]).take(pa.array(at))
                ends = pa.array(np.concatenate([[0], ends]).astype(np.int32))
                yield pa.RecordBatch.from_arrays([_plain(part.column(key)).take(pa.array(rows)), pa.ListArray.from_arrays(ends, grams),
                                                  pa.ListArray.from_arrays(ends, pa.array(w / np.repeat(norm, sizes)))], schema=schema)

    return texts.select(key, words(F.lower(text)).alias("words")).mapInArrow(run, out)


class _Asked:
    """Weights of the queries' grams: a matrix of fitted grams that some query has x queries."""

    def __init__(self, places: np.ndarray, queries: np.ndarray, weights: np.ndarray, n_queries: int, n_fitted: int):
        self.used, row = np.unique(places, return_inverse=True)
        self.row_of = np.full(n_fitted, -1, np.int64)
        self.row_of[self.used] = np.arange(len(self.used))
        order = np.argsort(row, kind="stable")
        self.query, self.weight = queries[order], weights[order]
        self.first = np.searchsorted(row[order], np.arange(len(self.used) + 1))
        self.n = n_queries

    def scores(self, ends: np.ndarray, place: np.ndarray, w: np.ndarray):
        """(lo, hi, texts x queries) of inner products, for some texts at a time."""
        row = self.row_of[place]
        given = np.flatnonzero(row >= 0)
        sizes = np.diff(ends, prepend=0)
        text, row, w = np.repeat(np.arange(len(ends)), sizes)[given], row[given], w[given]
        step = max(1, CELLS // max(self.n, 1))
        for lo in range(0, len(ends), step):
            hi = min(lo + step, len(ends))
            out = np.zeros((hi - lo) * self.n)
            a, b = np.searchsorted(text, [lo, hi])
            width = self.first[row[a:b] + 1] - self.first[row[a:b]]
            upto, at = np.cumsum(width), a
            while at < b:
                base = upto[at - a - 1] if at > a else 0
                stop = a + max(at - a + 1, int(np.searchsorted(upto, base + CELLS // 2, "right")))
                some, n = slice(at, stop), width[at - a:stop - a]
                met = np.arange(n.sum()) + np.repeat(self.first[row[some]] - (upto[at - a:stop - a] - n - base), n)
                cell = np.repeat((text[some] - lo) * self.n, n) + self.query[met]
                out += np.bincount(cell, np.repeat(w[some], n) * self.weight[met], len(out))
                at = stop
            yield lo, hi, out.reshape(hi - lo, self.n)


def best_texts(texts: DataFrame, asked: pa.Table, vocabulary: Vocabulary, n_queries: int, k: int, columns, text: str) -> DataFrame:
    """(q, columns..., score): a task's k best rows of ``texts`` for each query with a score above 0, ties by the last column.

    ``asked`` is (q, gram, a) with numbers q from 0 and unit-length weights a.
    """
    places = vocabulary.places(keys_of(_plain(asked.column("gram")), vocabulary.alphabet))
    shared = texts.sparkSession.sparkContext.broadcast((vocabulary.sent(), places, asked.column("q").to_numpy(), asked.column("a").to_numpy()))
    out = T.StructType([T.StructField("q", T.LongType()), *[texts.schema[c] for c in columns], T.StructField("score", T.DoubleType())])

    def run(batches):
        sent, places, query, weight = shared.value
        fitted, schema = Vocabulary.received(sent), to_arrow_schema(out)
        matrix = _Asked(places, query, weight, n_queries, len(fitted.keys))
        floor, kept, pending = np.zeros(n_queries), schema.empty_table(), 0
        found = [kept]

        def settled():
            held = pa.concat_tables(found).combine_chunks()
            held = held.append_column("_score", pa.array(np.round(held.column("score").to_numpy(), DECIMALS)))
            order = pc.sort_indices(held, sort_keys=[("q", "ascending"), ("_score", "descending"), (columns[-1], "ascending")], null_placement="at_start")
            q = held.column("q").to_numpy()[order.to_numpy()]
            place = np.arange(len(q)) - np.searchsorted(q, q)
            held = held.take(order.filter(pa.array(place < k)))
            last = place[place < k] == k - 1
            floor[held.column("q").to_numpy()[last]] = held.column("score").to_numpy()[last]
            return held.drop_columns(["_score"])

        for part in blocks(batches):
            block = Block(part.column("words"))
            if not len(block.words):
                continue
            for rows, ends, place, w, norm in fitted.weighed(block):
                for lo, hi, score in matrix.scores(ends, place, w):
                    score /= norm[lo:hi, None]
                    bound = floor - SLACK
                    if hi - lo > k:
                        # texts that fewer than k of these surpass
                        bound = np.maximum(bound, np.partition(score, hi - lo - k, axis=0)[hi - lo - k] - SLACK)
                    t, q = np.nonzero((score >= bound) & (score > 0))
                    at = pa.array(rows[lo + t])
                    found.append(pa.table([pa.array(q), *[_plain(part.column(c)).take(at) for c in columns], pa.array(score[t, q])], schema=schema))
                    pending += len(t)
                    if pending > max(CELLS // 8, 2 * n_queries * k):
                        found, pending = [settled()], 0
        yield from settled().to_batches()

    return texts.select(*columns, words(F.lower(text)).alias("words")).mapInArrow(run, out)
