"""Similarity join on word shingles by vertical partitioning of the global shingle order.

Shingles are 64-bit hashes of five words. The range of hashes is cut into fragments; every set is cut
along, and a fragment's task sees that part of all sets. Three counts are made per fragment and summed:

1. How many sets hold each shingle, and how many shingles of each set some other set holds too. A
   partner at 80 % shares at least 80 % of a set's own shingles, so sets with fewer shared ones have no
   partner and go no further: hardly any unrelated text does.
2. Sets that remain are ordered by rarity. Two linked sets share a shingle among the first
   ``shared - needed + 1`` of each, which gives the pairs to look at.
3. Partial overlaps of each pair, fragment by fragment, summed per pair and held against the threshold.

Sets with the same shingles are one class and enter once. Within one shingle's list pairs are not
made all against all: in the first rounds some lists compare their members with one leader, and sets found
to be connected already are not compared again; the last round compares what is left.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import (Words, gram_hashes, id_and_text, lower_ascii, raw_texts, text_blocks,
                                white_separator)
from cadenza.llm.graph import components
from cadenza.session import write_and_read

SHINGLE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 80
#: Shingles in one fragment, and fragments that one pair's overlap is counted in.
FRAGMENT_SIZE, PARTS = 6_000_000, 4
#: Rounds in which members of a list are compared with a leader, and lists of a class that take part.
LEADER_ROUNDS, LEADER_LISTS = 3, 8
#: 64-bit words of a set's sketch.
SKETCH = 8
NO_ID = (1 << 63) - 1


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text; a text of fewer words has its whole sequence as one."""
    words = Words(texts, white_separator(), lower_ascii())
    hashes = words.hashes()
    grams, first, out = gram_hashes(hashes, size), words.first.tolist(), []
    for start, stop in zip(first, first[1:]):
        if stop - start >= size:
            out.append(np.unique(grams[start:stop - size + 1]))
        elif stop > start:
            out.append(gram_hashes(hashes[start:stop], stop - start))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def set_keys(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """(doc_id, n, key) per row: the size of its set and a digest of it."""
    def run(batches):
        for part in text_blocks(batches):
            sets = shingle_sets(raw_texts(part.column("text")), size)
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([len(s) for s in sets], pa.int32()),
                pa.array([_key(s) for s in sets], pa.binary())], ["doc_id", "n", "key"])

    return docs.mapInArrow(run, "doc_id bigint, n int, key binary")


def _fragments(docs: DataFrame, bits: int, size: int) -> DataFrame:
    """Each block of documents cut along the fragments: one packed row per block and fragment.

    A row holds the keys and sizes of its sets, how many shingles each has here, and the shingles.
    Equal sets of a block are sent once.
    """
    def run(batches):
        for part in text_blocks(batches):
            sets = {}
            for shingles in shingle_sets(raw_texts(part.column("text")), size):
                if len(shingles):
                    sets.setdefault(_key(shingles), shingles)
            if not sets:
                continue
            sizes = np.array([len(s) for s in sets.values()], np.int32)
            keys = np.frombuffer(b"".join(sets), "V16")
            whole = np.concatenate(list(sets.values()))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            fragment = (whole >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(whole), np.int32)
            order = np.argsort(fragment, kind="stable")
            cuts = np.flatnonzero(np.diff(fragment[order])) + 1
            rows = []
            for some in np.split(order, cuts):
                counts = np.bincount(owner[some], minlength=len(sizes)).astype(np.int32)
                here = np.flatnonzero(counts)
                rows.append((int(fragment[some[0]]), keys[here].tobytes(), sizes[here].tobytes(),
                             counts[here].tobytes(), whole[some].tobytes()))
            columns = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
                ["fragment", "keys", "sizes", "counts", "shingles"])

    return docs.select("text").mapInArrow(
        run, "fragment int, keys binary, sizes binary, counts binary, shingles binary")


def _unpacked(table: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(table.column(name).to_pylist()), kind)


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first equal key, and a number, for each 16-byte key."""
    halves = keys.view(np.uint64).reshape(-1, 2)
    order = np.lexsort((halves[:, 1], halves[:, 0]))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (halves[order][1:] != halves[order][:-1]).any(axis=1)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(fresh) - 1
    first = np.full(int(fresh.sum()), len(order), np.int64)
    np.minimum.at(first, number, np.arange(len(order)))
    return first, number


def _shared_here(bits: int):
    """Count 1 in one fragment: shingles that several sets hold, with their number of sets."""
    def run(table: pa.Table) -> pa.Table:
        keys, sizes = _unpacked(table, "keys", "V16"), _unpacked(table, "sizes", np.int32)
        counts, shingles = _unpacked(table, "counts", np.int32), _unpacked(table, "shingles", np.uint64)
        first, number = _numbered(keys)
        once = np.zeros(len(keys), bool)
        once[first] = True
        kept = np.repeat(once, counts)
        shingles, owner = shingles[kept], np.repeat(number[once].astype(np.int32), counts[once])
        order = np.argsort(shingles)
        ordered = shingles[order]
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.empty(0, int)
        runs = np.diff(np.append(starts, len(ordered)))
        holders = np.repeat(runs, runs)
        common = holders > 1
        order, holders = order[common], holders[common].astype(np.int32)
        shingles, owner = shingles[order], owner[order]
        bucket = (keys[first].view(np.uint64).reshape(-1, 2)[:, 0] >> np.uint64(64 - bits)).astype(np.int32) \
            if bits else np.zeros(len(first), np.int32)
        order = np.lexsort((owner, bucket[owner]))
        rows = []
        for some in np.split(order, np.flatnonzero(np.diff(bucket[owner[order]])) + 1) if len(order) else []:
            here, per_set = np.unique(owner[some], return_counts=True)
            rows.append((int(bucket[owner[some[0]]]), keys[first[here]].tobytes(), sizes[first[here]].tobytes(),
                         per_set.astype(np.int32).tobytes(), shingles[some].tobytes(), holders[some].tobytes()))
        columns = list(zip(*rows)) or [()] * 6
        return pa.Table.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            ["bucket", "keys", "sizes", "counts", "shingles", "holders"])
    return run


def _survivors_here(percent: int):
    """Sums count 1 per set of one bucket of sets; sets with enough shared shingles stay."""
    def run(table: pa.Table) -> pa.Table:
        keys, sizes = _unpacked(table, "keys", "V16"), _unpacked(table, "sizes", np.int32)
        counts, shingles = _unpacked(table, "counts", np.int32), _unpacked(table, "shingles", np.uint64)
        holders = _unpacked(table, "holders", np.int32)
        first, number = _numbered(keys)
        owner = np.repeat(number, counts)
        sizes, shared = sizes[first], np.bincount(owner, minlength=len(first))
        needed = -(-percent * sizes.astype(np.int64) // 100)
        stays = shared >= needed
        kept = stays[owner]
        owner, shingles, holders = owner[kept], shingles[kept], holders[kept]
        order = np.lexsort((shingles, holders, owner))
        owner, shingles = owner[order], shingles[order]
        weight = np.bincount(owner, holders, len(first)) / np.maximum(sizes, 1)
        prefixes, parts, sketches, chosen = [], [], [], np.unique(owner)
        bounds = np.append(np.searchsorted(owner, chosen), len(owner))
        for n, start, stop in zip(chosen.tolist(), bounds, bounds[1:]):
            own = shingles[start:stop]
            prefixes.append(own[:stop - start - needed[n] + 1].view(np.int64))
            odd = np.bincount((own % np.uint64(64 * SKETCH)).astype(np.int64), minlength=64 * SKETCH) & 1
            sketches.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
            ordered = np.sort(own)
            cuts = np.searchsorted(ordered, np.arange(1, PARTS, dtype=np.uint64) * np.uint64((1 << 64) // PARTS))
            parts.append([p.tobytes() for p in np.split(ordered, cuts)])
        return pa.Table.from_arrays([
            pa.array([keys[first[n]].tobytes() for n in chosen], pa.binary()),
            pa.array(sizes[chosen], pa.int32()), pa.array(shared[chosen], pa.int32()), pa.array(weight[chosen]),
            pa.array(prefixes, pa.list_(pa.int64())), pa.array(parts, pa.list_(pa.binary())),
            pa.array(sketches, pa.list_(pa.int64())),
        ], ["key", "n", "shared", "weight", "prefix", "parts", "sketch"])
    return run


def _survivors(docs: DataFrame, classes: DataFrame, size: int, percent: int, fragment_size: int) -> DataFrame:
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")).first()[0]
    bits = max(0, int(-(-total // fragment_size) - 1).bit_length())
    shared = _fragments(docs, bits, size).groupBy("fragment").applyInArrow(
        _shared_here(bits), "bucket int, keys binary, sizes binary, counts binary, shingles binary, holders binary")
    found = shared.groupBy("bucket").applyInArrow(
        _survivors_here(percent), "key binary, n int, shared int, weight double, prefix array<bigint>, parts array<binary>, "
        "sketch array<bigint>")
    return write_and_read(found.join(classes.select("key", "cid"), "key").drop("key"), "op4-survivors")


def _alike(percent: int):
    """Whether two sets' sizes allow a link."""
    nx, ny = F.col("a.n").cast("bigint"), F.col("b.n").cast("bigint")
    return 100 * F.least(nx, ny) >= percent * F.greatest(nx, ny)


def _first_common(percent: int):
    """Whether a shared shingle can be the first that two linked sets share.

    A link needs ``percent * (nx + ny) / (100 + percent)`` common shingles, and all of them come at or after
    the first one in both sets; every link passes by its first common shingle.
    """
    nx, ny, sx, sy, px, py = (F.col(f"{s}.{c}").cast("bigint") for c in ("n", "shared", "pos") for s in ("a", "b"))
    return _alike(percent) & ((100 + percent) * F.least(sx - px, sy - py) >= percent * (nx + ny))


def _few_differences(percent: int):
    """Whether the sketches leave room for a link; never wrong about one.

    A bit of a sketch is the parity of a set's shingles in one bucket, so two sketches differ in no more
    bits than the sets in shingles.
    """
    nx, ny, sx, sy = (F.col(f"{s}.{c}").cast("bigint") for c in ("n", "shared") for s in ("a", "b"))
    differ = sum(F.bit_count(F.get("a.sketch", F.lit(i)).bitwiseXOR(F.get("b.sketch", F.lit(i)))) for i in range(SKETCH))
    return (100 + percent) * (sx + sy - differ) >= 2 * percent * (nx + ny)


def _pairs(joined: DataFrame) -> DataFrame:
    return joined.select(F.least("a.cid", "b.cid").alias("x"), F.greatest("a.cid", "b.cid").alias("y")).distinct()


def links(pairs: DataFrame, survivors: DataFrame, percent: int) -> DataFrame:
    """Pairs (x, y) over the threshold: partial overlaps are counted per fragment and summed per pair."""
    parts = survivors.select("cid", "n", F.posexplode("parts").alias("part", "shingles"))
    left = parts.select(F.col("cid").alias("x"), F.col("n").alias("nx"), "part", F.col("shingles").alias("a"))
    right = parts.select(F.col("cid").alias("y"), F.col("n").alias("ny"), "part", F.col("shingles").alias("b"))
    both = pairs.join(left, "x").join(right, ["y", "part"]).select("x", "y", "nx", "ny", "a", "b")

    def run(batches):
        for batch in batches:
            overlap = []
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()):
                merged = np.sort(np.frombuffer(a + b, np.uint64))
                overlap.append(int((merged[1:] == merged[:-1]).sum()))
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("x", "y", "nx", "ny")], pa.array(overlap, pa.int64())],
                ["x", "y", "nx", "ny", "partial"])

    partial = both.mapInArrow(run, "x bigint, y bigint, nx int, ny int, partial bigint")
    summed = partial.groupBy("x", "y").agg(F.sum("partial").alias("o"), (F.min("nx") + F.min("ny")).alias("n"))
    return summed.filter(F.expr(f"100 * o >= {percent} * (n - o)")).select("x", "y")


def class_links(survivors: DataFrame, percent: int, rounds: int = LEADER_ROUNDS) -> DataFrame | None:
    """Links that connect all classes that are connected: (node, label), None if nothing is linked.

    In the first rounds some lists of a class, those with most holders in its prefix, have a leader that their
    members are compared with: first the set whose shingles have most holders, as the original of many
    near copies has, then some member of the list's largest component, another one in each list. The last
    round takes all lists that still hold several components, and all their pairs across components.
    """
    postings = survivors.select("cid", "n", "shared", "weight", F.size("prefix").alias("length"),
                                F.posexplode("prefix").alias("pos", "shingle"))
    sketches = survivors.select("cid", "sketch")
    found, labels = None, None
    for turn in range(rounds + 1):
        last = turn == rounds
        placed = postings if last else postings.filter(F.col("pos") >= F.col("length") - LEADER_LISTS)
        if labels is None:
            placed = placed.withColumns({"comp": F.col("cid"), "members": F.lit(1)})
        else:
            placed = placed.join(labels, "cid", "left").withColumns(
                {"comp": F.coalesce("label", "cid"), "members": F.coalesce("members", F.lit(1))}).drop("label")
        second = F.xxhash64("cid", "shingle", F.lit(turn)).cast("double") if turn else -F.col("weight")
        member = F.struct((-F.col("members")).alias("first"), second.alias("second"), "cid", "n", "comp")
        lists = placed.groupBy("shingle").agg(
            F.min(member).alias("lead"), F.min("comp").alias("low"), F.max("comp").alias("high")).filter("low < high")
        if last:
            left = placed.join(lists.select("shingle"), "shingle", "left_semi").join(sketches, "cid")
            close = left.alias("a").join(left.alias("b"), (F.col("a.shingle") == F.col("b.shingle"))
                                         & (F.col("a.cid") < F.col("b.cid")) & (F.col("a.comp") != F.col("b.comp"))
                                         & _first_common(percent) & _few_differences(percent))
        else:
            leaders = lists.select("shingle", "lead.*")
            close = placed.alias("a").join(leaders.alias("b"), (F.col("a.shingle") == F.col("b.shingle"))
                                           & (F.col("a.comp") != F.col("b.comp")) & _alike(percent))
        fresh = write_and_read(links(_pairs(close), survivors, percent), "op4-links")
        if not fresh.isEmpty():
            found = fresh if found is None else found.unionByName(fresh)
            named = components(found)
            sizes = named.groupBy("label").agg(F.count("*").alias("members"))
            labels = write_and_read(named.withColumnRenamed("node", "cid").join(sizes, "label"), "op4-labels")
    return None if labels is None else labels.select(F.col("cid").alias("node"), "label")


def near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT,
                    fragment_size: int = FRAGMENT_SIZE) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, class_id, class_size.

    ``component_id`` is the smallest doc_id reachable by links, ``class_id`` the smallest one with the same
    set. Null, empty and blank texts have the empty set and are linked with nothing, not even each
    other. Null ids come after all others. Repeated rows are documents of their own, equal
    to each other. An empty table gives an empty table; other columns are ignored.
    """
    docs = id_and_text(docs)
    rows = write_and_read(set_keys(docs, size).withColumn("did", F.coalesce("doc_id", F.lit(NO_ID))), "op4-sets")
    classes = rows.filter("n > 0").groupBy("key").agg(
        F.min("n").alias("n"), F.min("did").alias("rep"), F.count("*").alias("class_size"))
    classes = write_and_read(classes.withColumn("cid", F.monotonically_increasing_id()), "op4-classes")
    labels = class_links(_survivors(docs, classes, size, percent, fragment_size), percent)
    if labels is None:
        grouped = classes.withColumn("component", F.col("rep"))
    else:
        named = classes.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
            "label", F.coalesce("label", "cid"))
        named = write_and_read(named, "op4-named")
        smallest = named.groupBy("label").agg(F.min("rep").alias("component"))
        grouped = named.join(smallest, "label")
    found = rows.join(grouped.select("key", "rep", "component", "class_size"), "key", "left")
    own = [F.coalesce(F.col(c), F.col("did")) for c in ("component", "rep")]
    component, rep = [F.when(c != NO_ID, c) for c in own]
    return found.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), component.alias("component_id"),
                        rep.alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"))


def drop_near_duplicates(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, scratch: str = "similar_rows") -> DataFrame:
    """Rows of ``docs``, with all their columns: of each group of linked rows the one with the smallest doc_id.

    A caller that names ``scratch`` may remove the written copy of the rows by it once the result is written.
    """
    rows = write_and_read(docs.select(F.monotonically_increasing_id().alias("rid"),
                                      F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")), scratch)
    groups = near_duplicates(rows.select(F.col("rid").alias("doc_id"), F.col("row.text").alias("text")), size, percent)
    placed = groups.select(F.col("doc_id").alias("rid"), "component_id").join(
        rows.select("rid", F.col("row.doc_id").alias("doc_id")), "rid")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "rid"))
    kept = placed.groupBy("component_id").agg(first.alias("keep")).select("keep.rid")
    return rows.join(kept, "rid", "left_semi").select("row.*")
