"""Exact deduplication by deterministic block naming; DataFrame operations only.

A normalised text is cut into blocks of ``block_bytes`` bytes. Distinct blocks are sorted and
numbered; then adjacent pairs of names are sorted and numbered, level by level, until one name
is left. Two texts are equal exactly when they have the same number of blocks and the same last
name: names stand for sorted distinct contents, never for hashes of them.

A hash only finds the name of a block again without moving its text a second time; where one hash
stands for several distinct blocks, those are named and found by their whole content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.session import write_and_read

WHITE = r"[\x20\x09-\x0D]+"
BLOCK_BYTES = 4096
#: Stands for the missing right half of a last, unpaired name; real names lie above it.
NO_RIGHT = -(1 << 62)


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), WHITE, " ")


def prepare(docs: DataFrame, block_bytes: int = BLOCK_BYTES, carry: bool = False, scratch: str = "op5-blocks") -> DataFrame:
    """Each row under an own number ``rid`` with its blocks, written as ``scratch``; ``carry`` keeps the whole row."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]) if carry else F.lit(True)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), row.alias("row"),
                        normalised(F.col("text")).alias("norm"))
    last = (F.greatest(F.octet_length("norm") - 1, F.lit(0)) / block_bytes).cast("int")
    raw = F.col("norm").cast("binary")
    cut = texts.select("doc_id", "row", F.sha2(raw, 256).alias("text_sha256"),
                       F.sequence(F.lit(0), last).alias("at"), raw.alias("raw"))
    blocks = F.transform("at", lambda i: F.substring(F.col("raw"), i * block_bytes + 1, F.lit(block_bytes)))
    return write_and_read(cut.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "row",
                                     "text_sha256", blocks.alias("blocks")), scratch)


def sorted_names(keys: DataFrame) -> DataFrame:
    """Distinct rows with an integer name each, ascending with the rows' order in every partition."""
    distinct = keys.distinct()
    return distinct.sortWithinPartitions(*keys.columns).withColumn("name", F.monotonically_increasing_id())


def _gathered(named: DataFrame, name: str) -> DataFrame:
    """Names of a document back in their order; a document's own list, so bounded by its length."""
    ordered = F.sort_array(F.collect_list(F.struct("pos", "name")))
    return write_and_read(named.groupBy("rid", "k").agg(F.transform(ordered, lambda x: x["name"]).alias("names")), name)


def first_names(prepared: DataFrame, fingerprint=F.xxhash64) -> DataFrame:
    """(rid, k, names) with a name per block; ``fingerprint`` may collide, names never do."""
    blocks = prepared.select("rid", F.size("blocks").alias("k"), F.posexplode("blocks").alias("pos", "block"))
    blocks = blocks.withColumn("fp", fingerprint(F.col("block")).cast("bigint"))
    names = sorted_names(blocks.select("block")).withColumn("fp", fingerprint(F.col("block")).cast("bigint"))
    names = write_and_read(names.groupBy("fp").agg(F.min("name").alias("name"), F.count("*").alias("n")), "op5-names")
    single = names.filter("n = 1").select("fp", "name")
    named = blocks.select("rid", "k", "pos", "fp").join(single, "fp").select("rid", "k", "pos", "name")
    shared = names.filter("n > 1").select("fp")
    if not shared.isEmpty():
        doubtful = blocks.join(shared, "fp", "left_semi").select("rid", "k", "pos", "block")
        exact = sorted_names(doubtful.select("block")).select("block", (-1 - F.col("name")).alias("name"))
        exact = write_and_read(exact, "op5-names")
        named = named.unionByName(doubtful.join(exact, "block").select("rid", "k", "pos", "name"))
    return _gathered(named, "op5-level")


def next_names(current: DataFrame) -> DataFrame:
    """One level up: a name for each adjacent pair of names."""
    at = F.sequence(F.lit(0), ((F.size("names") - 1) / 2).cast("int"))
    halves = F.transform(at, lambda i: F.struct(
        i.alias("pos"), F.get("names", 2 * i).alias("a"),
        F.coalesce(F.get("names", 2 * i + 1), F.lit(NO_RIGHT).cast("bigint")).alias("b")))
    pairs = current.select("rid", "k", F.inline(halves))
    names = write_and_read(sorted_names(pairs.select("a", "b")), "op5-names")
    return _gathered(pairs.join(names, ["a", "b"]).select("rid", "k", "pos", "name"), "op5-level")


def identities(prepared: DataFrame, fingerprint=F.xxhash64) -> DataFrame:
    """(rid, k, name): equal (k, name) exactly for equal texts."""
    current = first_names(prepared, fingerprint)
    longest = current.agg(F.max("k")).first()[0] or 1
    done = None
    while True:
        ready = current.filter(F.size("names") == 1).select("rid", "k", F.col("names")[0].alias("name"))
        done = ready if done is None else done.unionByName(ready)
        if longest <= 1:
            return done
        current = next_names(current.filter(F.size("names") > 1))
        longest = (longest + 1) // 2


def decisions(prepared: DataFrame, fingerprint=F.xxhash64) -> DataFrame:
    """(rid, keep_id, group_size, kept) for every row."""
    ids = identities(prepared, fingerprint).join(prepared.select("rid", "doc_id"), "rid")
    ids = write_and_read(ids, "op5-identities")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("absent"), "doc_id", "rid"))
    groups = ids.groupBy("k", "name").agg(first.alias("keep"), F.count("*").alias("group_size"))
    # written, so that both sides are dealt out for the join and the rows of a large group can be split
    groups = write_and_read(groups, "op5-groups")
    return ids.join(groups, ["k", "name"]).select(
        "rid", F.col("keep.doc_id").alias("keep_id"), "group_size", (F.col("rid") == F.col("keep.rid")).alias("kept"))


def exact_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, fingerprint=F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts are equal to each other. Of equal texts the smallest
    doc_id stays, a null doc_id only if there is no other; of repeated ids one row stays. An empty
    table gives an empty table. Other columns, whatever their names, are ignored.
    """
    prepared = prepare(docs, block_bytes)
    return decisions(prepared, fingerprint).join(prepared.select("rid", "doc_id", "text_sha256"), "rid").select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def drop_duplicates(docs: DataFrame, block_bytes: int = BLOCK_BYTES, scratch: str = "dedup_rows") -> DataFrame:
    """The rows that stay, with the columns of ``docs``; the same rules as ``exact_duplicates``.

    A caller that names ``scratch`` may remove the written copy of the rows by it once the result is written.
    """
    prepared = prepare(docs, block_bytes, carry=True, scratch=scratch)
    kept = decisions(prepared).filter("kept").select("rid")
    return prepared.join(kept, "rid", "left_semi").select("row.*")
