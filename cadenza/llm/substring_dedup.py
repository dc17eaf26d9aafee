"""Substring deduplication with one compressed FM-index per shard.

1. Rows of equal word sequences form a class; only a class's smallest doc_id enters the rest, since all
   windows of the others start in it.
2. Anchors choose what can repeat at all: of the word runs of ``ANCHOR`` words in each window, the one with
   the smallest hash. Equal windows have equal anchors. Passages around anchors that several
   documents have go to the anchor's shard; equal passages meet as one, with their smallest doc_id.
   An anchor with many distinct passages gives way to longer ones: of the words around it, a window holds
   enough on one side or the other, so a passage goes on with at most two longer runs, and again.
3. A shard's passages are indexed: backward search over a wavelet matrix gives matching statistics of
   every streamed passage against those of smaller documents, and stretches of ``WINDOW`` or more
   words are reported.
4. Reported stretches of a document are removed from it.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import Words, gram_hashes, id_and_text, raw_texts, text_blocks, white_separator
from cadenza.llm.fm_index import FMIndex, intervals
from cadenza.operators.joins import fits_broadcast
from cadenza.session import write_and_read

WINDOW, ANCHOR = 50, 25
#: Words that one index holds.
SHARD_WORDS = 1_000_000
#: Distinct passages of one anchor beyond which longer anchors take its place.
CROWDED = 5_000
NO_ID = (1 << 63) - 1
NOTHING = hashlib.sha256(b"").hexdigest()


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = pick(out[:-step], out[step:])
        done += step
    return out


def anchors(words: Words, window: int = WINDOW, size: int = ANCHOR) -> tuple[np.ndarray, np.ndarray]:
    """(hash, word position in the block) of the runs with the smallest hash in some window."""
    grams, width = gram_hashes(words.hashes(), size), window - size + 1
    total = int(words.first[-1])
    if total < window:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    # a window is valid if it ends before the next text
    text_end = np.repeat(words.first[1:], np.diff(words.first))[:total - window + 1]
    valid = np.arange(total - window + 1) + window <= text_end
    least = np.where(valid, _slide(grams, width, np.minimum), np.uint64(0))
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    most = _slide(padded, width, np.maximum)
    at = np.flatnonzero((most == grams) & (most > 0))
    return grams[at], at


def _rows(docs: DataFrame, window: int, size: int) -> DataFrame:
    """(doc_id, did, n_words, digest, anchors, places) per row; the digest is of the words, space-joined."""
    def run(batches):
        for part in text_blocks(batches):
            texts = raw_texts(part.column("text"))
            words = Words(texts, white_separator())
            found, at = anchors(words, window, size)
            owner = np.searchsorted(words.first, at, "right") - 1
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=len(texts)))).astype(np.int32))
            places = (at - words.first[owner]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(np.diff(words.first).astype(np.int64)),
                pa.array([hashlib.sha256(b" ".join(t.split())).digest() for t in texts], pa.binary()),
                pa.ListArray.from_arrays(offsets, pa.array(found.view(np.int64))),
                pa.ListArray.from_arrays(offsets, pa.array(places))],
                ["doc_id", "n_words", "digest", "anchors", "places"])

    rows = docs.mapInArrow(
        run, "doc_id bigint, n_words bigint, digest binary, anchors array<bigint>, places array<int>")
    return write_and_read(rows.withColumn("did", F.coalesce("doc_id", F.lit(NO_ID))), "op8-rows")


def _touched(docs: DataFrame, rows: DataFrame, classes: DataFrame) -> DataFrame:
    """(cid, did, text, marks) of the documents with shared anchors; marks: (place, anchor)."""
    members = rows.filter(F.size("anchors") > 0).join(classes, ["digest", "did"]).select("cid", "did", "anchors", "places")
    postings = members.select("cid", "did", F.inline(F.arrays_zip("anchors", "places"))).toDF(
        "cid", "did", "anchor", "place")
    shared = postings.groupBy("anchor").agg(F.min("cid").alias("low"), F.max("cid").alias("high")).filter("low < high")
    marks = postings.join(shared.select("anchor"), "anchor").groupBy("cid").agg(
        F.array_distinct(F.collect_list(F.struct("place", "anchor"))).alias("marks"))
    marks = write_and_read(marks.join(classes, "cid"), "op8-marks")
    keyed = docs.withColumn("did", F.coalesce("doc_id", F.lit(NO_ID)))
    wanted = marks.select("did").distinct()
    if fits_broadcast(wanted):
        keyed = keyed.join(F.broadcast(wanted), "did", "left_semi")
    return write_and_read(keyed.join(marks, "did").filter(
        _words_digest(F.col("text")) == F.col("digest")).select("cid", "did", "text", "marks")
        .dropDuplicates(["cid"]), "op8-touched")


def _words_digest(text):
    """The digest of ``_rows`` in Spark's functions: words joined by one space."""
    joined = F.btrim(F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " "), F.lit(" "))
    return F.unhex(F.sha2(joined.cast("binary"), 256))


def _passages(touched: DataFrame, window: int, size: int) -> DataFrame:
    """The ``n`` words around each mark that windows with it reach.

    Rows are (anchor, cid, did, start, n, at, low, high, words, print): windows have ``low`` to ``high`` words before
    the anchor, which is at word ``at`` of the passage. A passage shorter than a window is left out.
    """
    around = window - size

    def run(batches):
        for part in text_blocks(batches):
            rows = []
            for cid, did, text, marks in zip(*(part.column(c).to_pylist() for c in ("cid", "did", "text", "marks"))):
                words = text.encode().split()
                for mark in marks:
                    start = max(0, mark["place"] - around)
                    stop = min(len(words), mark["place"] + window)
                    if stop - start >= window:
                        rows.append((mark["anchor"], cid, did, start, stop - start, mark["place"] - start,
                                     0, around, b" ".join(words[start:stop])))
            yield _batch(rows, _PASSAGE)

    return touched.mapInArrow(run, _schema(_PASSAGE)).withColumn("print", F.xxhash64("at", "words"))


_PASSAGE = ("anchor", "cid", "did", "start", "n", "at", "low", "high", "words")
_LONGER = ("anchor", "did", "parent", "parent_print", "start", "n", "at", "low", "high", "words")


def _schema(names) -> str:
    return ", ".join(f"{name} {'binary' if name == 'words' else 'bigint'}" for name in names)


def _batch(rows: list[tuple], names) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.binary() if name == "words" else pa.int64())
                                       for c, name in zip(columns, names)], list(names))


def _distinct(passages: DataFrame) -> DataFrame:
    """Equal passages of an anchor as one, with their smallest document."""
    return write_and_read(passages.groupBy("anchor", "at", "words", "print").agg(
        F.min("did").alias("did"), *[F.first(c).alias(c) for c in ("n", "low", "high")]), "op8-passages")


def halves(anchor: int, words: list[bytes], at: int, low: int, high: int, window: int, size: int):
    """(anchor, begin, end, at, low, high): the passage below the two longer runs that take its anchor's place.

    Its windows have ``low`` to ``high`` words before the anchor's run. Those with ``middle`` or more have the
    ``middle`` words before it in common, the others the words behind it that a window with one word less has. The
    longer run is named by a digest, together with the anchor and the bounds; a side without any window is left out.
    """
    around, middle = window - size, (low + high + 1) // 2
    for least, most in ((middle, high), (low, middle - 1)):
        fewest, farthest = max(least, at + window - len(words)), min(most, at)
        if fewest <= farthest:
            run = b" ".join(words[at - least:at + size + around - most])
            name = hashlib.blake2b(b"%d %d %d " % (anchor, least, most) + run, digest_size=8).digest()
            begin, end = at - farthest, at + size + around - fewest
            yield int.from_bytes(name, "little", signed=True), begin, end, at - begin, least, most


def _longer(hot: DataFrame, window: int, size: int) -> DataFrame:
    """Distinct passages below longer anchors: two rows at most for each, ``start`` words into their parent."""
    def run(batches):
        for part in text_blocks(batches, "words"):
            rows = []
            for anchor, print_, did, at, low, high, text in zip(*(part.column(c).to_pylist() for c in (
                    "anchor", "print", "did", "at", "low", "high", "words"))):
                words = text.split(b" ")
                for name, begin, end, place, least, most in halves(anchor, words, at, low, high, window, size):
                    rows.append((name, did, anchor, print_, begin, end - begin, place, least, most,
                                 b" ".join(words[begin:end])))
            yield _batch(rows, _LONGER)

    longer = hot.mapInArrow(run, _schema(_LONGER)).withColumn("print", F.xxhash64("at", "words"))
    return write_and_read(longer, "op8-longer")


def _spread(found: DataFrame, passages: DataFrame, distinct: DataFrame) -> DataFrame:
    """``passages`` with the stretches (from, to) that go, counted from where a passage's ``start`` counts from.

    A distinct passage's smallest document has the stretches found; in its other documents all of it goes.
    """
    least = distinct.select("anchor", "print", F.col("did").alias("least"))
    copies = passages.join(least, ["anchor", "print"]).filter("did > least").withColumns(
        {"from": F.col("start"), "to": F.col("start") + F.col("n")})
    own = passages.join(found, ["anchor", "print"]).filter("did = least").withColumns(
        {"from": F.col("start") + F.col("from"), "to": F.col("start") + F.col("to")})
    return own.unionByName(copies)


def _search(window: int):
    """Matching stretches of every passage of one shard in passages of smaller documents."""
    def run(table: pa.Table) -> pa.Table:
        anchor = table.column("anchor").to_numpy()
        # an anchor with one passage has nothing to be compared with
        names, number, several = np.unique(anchor, return_inverse=True, return_counts=True)
        table = table.filter(pa.array(several[number] > 1))
        anchor, did = table.column("anchor").to_numpy(), table.column("did").to_numpy()
        prints = table.column("print").to_numpy()
        words = [w.split(b" ") for w in raw_texts(table.column("words"))]
        if not words:
            return pa.Table.from_pylist([], schema=_HITS)
        ids: dict[bytes, int] = {}
        length = np.array([len(w) for w in words], np.int64)
        flat = np.fromiter((ids.setdefault(w, len(ids) + 1) for of_text in words for w in of_text), np.int64,
                           int(length.sum()))
        begin = np.cumsum(length + 1) - length - 1
        tokens = np.zeros(int(length.sum()) + len(words), np.int64)
        tokens[np.arange(len(flat)) + np.repeat(np.arange(len(words)), length)] = flat
        rank = np.unique(did, return_inverse=True)[1].astype(np.int64)
        index = FMIndex(tokens, np.repeat(rank, length + 1), len(ids) + 1, int(length.max()))
        names, number = np.unique(anchor, return_inverse=True)
        smallest = np.full(len(names), NO_ID)
        np.minimum.at(smallest, number, did)
        asked = np.flatnonzero(did > smallest[number])
        hits = intervals(index, begin[asked], length[asked], rank[asked], window)
        which = asked[hits[:, 0]]
        return pa.Table.from_arrays([pa.array(anchor[which]), pa.array(prints[which]), pa.array(did[which]),
                                     pa.array(hits[:, 1]), pa.array(hits[:, 2])], schema=_HITS)
    return run


_HITS = pa.schema([("anchor", pa.int64()), ("print", pa.int64()), ("least", pa.int64()), ("from", pa.int64()),
                   ("to", pa.int64())])


def _hits(passages: DataFrame, window: int, size: int, shard_words: int, crowded: int) -> DataFrame:
    """(cid, from, to): stretches of documents to remove, in words.

    Of a crowded anchor only distinct passages go on, below longer anchors. After as many rounds as a window's
    spare words can be halved the anchor is a whole window, and all its passages are one.
    """
    distinct = [_distinct(passages)]
    settled, longer = [], []
    while True:
        many = distinct[-1].groupBy("anchor").agg(F.count("*").alias("_n"), F.max(F.col("high") - F.col("low")).alias("_open"))
        many = write_and_read(many.filter((F.col("_n") > crowded) & (F.col("_open") > 0)).select("anchor"), "op8-many")
        if many.isEmpty():
            break
        few = F.broadcast(many) if fits_broadcast(many) else many
        settled.append(distinct[-1].join(few, "anchor", "left_anti"))
        longer.append(_longer(distinct[-1].join(few, "anchor", "left_semi"), window, size))
        distinct.append(_distinct(longer[-1]))
    everything = reduce(DataFrame.unionByName, settled, distinct[-1])
    total = everything.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = max(1, -(-total // shard_words))
    sharded = everything.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)).cast("int"))
    found = sharded.groupBy("shard").applyInArrow(
        _search(window), "anchor bigint, print bigint, least bigint, from bigint, to bigint")
    found = write_and_read(found, "op8-found")
    for below, known in zip(reversed(longer), reversed(distinct)):
        above = _spread(found, below.select("anchor", "print", "did", "start", "n", "parent", "parent_print"), known).select(
            F.col("parent").alias("anchor"), F.col("parent_print").alias("print"), F.col("did").alias("least"), "from", "to")
        found = write_and_read(found.unionByName(above.distinct()), "op8-found")
    return _spread(found, passages.select("anchor", "print", "cid", "did", "start", "n"), distinct[0]).select("cid", "from", "to")


def _removed(touched: DataFrame, hits: DataFrame) -> DataFrame:
    """(cid, n_removed, kept) of the documents with hits."""
    ranges = hits.groupBy("cid").agg(F.collect_set(F.struct("from", "to")).alias("ranges"))

    def run(batches):
        for part in text_blocks(batches):
            columns = [[], [], []]
            for cid, text, ranges in zip(*(part.column(c).to_pylist() for c in ("cid", "text", "ranges"))):
                words = text.encode().split()
                keep = np.ones(len(words), bool)
                for r in ranges:
                    keep[r["from"]:r["to"]] = False
                kept = [w for w, k in zip(words, keep.tolist()) if k]
                for column, value in zip(columns, (cid, len(words) - len(kept), b" ".join(kept).decode())):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))],
                ["cid", "n_removed", "kept"])

    return touched.select("cid", "text").join(ranges, "cid").mapInArrow(
        run, "cid bigint, n_removed bigint, kept string")


def _state(docs: DataFrame, window: int, size: int, shard_words: int, crowded: int):
    """Rows with their class, and the words that stay of classes that lose some."""
    rows = _rows(docs, window, size)
    classes = rows.groupBy("digest").agg(F.min("did").alias("did"))
    classes = write_and_read(classes.withColumn("cid", F.monotonically_increasing_id()), "op8-classes")
    touched = _touched(docs, rows, classes)
    removed = _removed(touched, _hits(_passages(touched, window, size), window, size, shard_words, crowded))
    placed = rows.select("doc_id", "did", "n_words", "digest").join(
        classes.withColumnRenamed("did", "rep"), "digest")
    return placed, removed


def repeated_passages(docs: DataFrame, window: int = WINDOW, size: int = ANCHOR, shard_words: int = SHARD_WORDS,
                      crowded: int = CROWDED) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A word is removed if a window of ``window`` words around it also starts in a document with a smaller
    doc_id; windows are those of the input. Null, empty and blank texts have no words, and their digest
    is that of nothing. Null ids come after all others. Rows with the same id do not count against each
    other. An empty table gives an empty table; other columns are ignored.
    """
    placed, removed = _state(id_and_text(docs), window, size, shard_words, crowded)
    digests = removed.select("cid", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    found = placed.join(digests, "cid", "left")
    copied = (F.col("did") > F.col("rep")) & (F.col("n_words") >= window)
    gone = F.when(copied, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0)))
    kept = (F.when(copied, F.lit(NOTHING)).when(F.col("kept_sha256").isNotNull(), F.col("kept_sha256"))
            .otherwise(F.lower(F.hex("digest"))))
    return found.select("doc_id", "n_words", gone.alias("n_removed"), kept.alias("kept_sha256"))
