"""The trie of conversation prefixes, grouped by multi-turn blocks first.

Every turn of a conversation gets the identity of the prefix that ends with it: the sum of
digests of all turns up to there, each taken together with its place. Sums run over a conversation
of any length in ranges. Turns are then cut into blocks of a fixed number, and conversations are grouped
by the identity at the end of each block: a *variant* stands for all conversations that share a prefix up to
there. Only below a prefix with several variants are turn boundaries looked at one by one; a prefix with
a single variant has the same conversations at every turn of the block.

Sums over subtrees need no walk through the levels. A conversation owns the nodes whose smallest
member it is, which are the deepest ones of its path. What a subtree would sum up node by node is
the sum over its conversations of their turns that are owned by others, and its leaves are those owned there.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from cadenza.operators.ordering import running
from cadenza.session import write_and_read

#: Turns of a block.
BLOCK_TURNS = 4
#: Turns of one conversation that one task puts in order.
ORDERED_ROWS = 200_000
#: Ids that are joined into one string before the strings of a node pass through its digest.
CHUNK_IDS = 512
LANES = 4
#: Name of the root, which has no text.
ROOT = ""
WHITE = r"[\x20\x09-\x0D]+"
STARTS, FAMILY = 4, 20


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(text, WHITE), lambda w: w != "")).cast("bigint")


def ordered_turns(conversations: DataFrame, max_group: int | None = None) -> DataFrame:
    """(conv_id, pos, content, words), written: turns numbered from 1 by ``turn``, null first, then role and text.

    ``content`` is the digest of role and text, of which null counts as empty. Turns without a conv_id belong to
    no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), text.alias("text"))
    placed = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "text"], rank="pos",
                     max_group=max_group or ORDERED_ROWS)
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    return write_and_read(placed.select("conv_id", F.col("pos").cast("bigint").alias("pos"), content.alias("content"),
                                        word_count(F.col("text")).alias("words")), "op13-turns")


def with_shared_starts(turns: DataFrame, starts: int = STARTS, family: int = FAMILY) -> tuple[DataFrame, DataFrame]:
    """(conversations, turns) rebuilt so that conversations of a family share first turns.

    Conversation c gets the first h turns of conversation c - c % ``family`` (all if it has fewer, none if it
    does not exist), then its own turns after its first h; h is crc32(c) % ``starts``. The remainder of a negative id
    has its sign.
    """
    c = F.col("conv_id")
    h = (F.crc32(c.cast("string").cast("binary")) % starts).cast("bigint")
    base = c - c % family
    ids = write_and_read(turns.select("conv_id").distinct(), "op13-ids")
    first = turns.filter(F.col("pos") < starts).select(
        F.col("conv_id").alias("base"), "pos", "content", "words")
    wanted = ids.select("conv_id", base.alias("base"), h.alias("h"))
    given = wanted.join(first, "base").filter(F.col("pos") <= F.col("h"))
    heads = given.select("conv_id", "pos", "content", "words")
    # an own turn moves up by those of the first h that the family's first conversation lacks
    short = given.groupBy("conv_id").agg(F.max("pos").alias("had"))
    own = turns.filter(F.col("pos") > h).join(short, "conv_id", "left")
    own = own.select("conv_id", (F.col("pos") - h + F.coalesce("had", F.lit(0))).alias("pos"), "content", "words")
    return ids, heads.unionByName(own)


def _lane(value: Column, i: int) -> Column:
    return F.conv(F.substring(value, 8 * i + 1, 8), 16, 10).cast("bigint")


def _name(sums: list[Column]) -> Column:
    return F.concat(*[F.lpad(F.hex(s % (1 << 32)), 8, "0") for s in sums])


def with_prefixes(turns: DataFrame, max_group: int | None = None) -> DataFrame:
    """(conv_id, depth, node, parent, words, upto): every turn with the name of the prefix it ends, written.

    A name is 128 bits of summed digests, each of a turn's content and depth; ``upto`` counts the prefix's words.
    """
    placed = F.sha2(F.concat_ws(":", F.col("pos").cast("string"), "content").cast("binary"), 256)
    names = [f"lane{i}" for i in range(LANES)]
    lanes = turns.select("conv_id", "pos", "words", placed.alias("placed")).select(
        "conv_id", F.col("pos").alias("depth"), "words", *[_lane(F.col("placed"), i).alias(n) for i, n in enumerate(names)])
    summed = running(lanes, ["conv_id"], ["depth"], rank="nth", max_group=max_group or ORDERED_ROWS,
                     sums={"upto": "words", **{f"sum_{n}": n for n in names}})
    parent = F.when(F.col("depth") == 1, ROOT).otherwise(_name([F.col(f"sum_{n}") - F.col(n) for n in names]))
    return write_and_read(summed.select("conv_id", "depth", _name([F.col(f"sum_{n}") for n in names]).alias("node"),
                                        parent.alias("parent"), "words", "upto"), "op13-prefixes")


def blocks_of(prefixes: DataFrame, block_turns: int) -> DataFrame:
    """(conv_id, k, start, end, upto, turns): each conversation's blocks of turns, the last one as long as it is, written."""
    turn = F.struct("depth", "node", "parent", "words", "upto")
    blocks = prefixes.withColumn("k", F.floor((F.col("depth") - 1) / block_turns)).groupBy("conv_id", "k").agg(
        F.sort_array(F.collect_list(turn)).alias("turns"))
    last = F.element_at("turns", -1)
    return write_and_read(blocks.select("conv_id", "k", F.col("turns")[0]["parent"].alias("start"), last["node"].alias("end"),
                                        last["upto"].alias("upto"), "turns"), "op13-blocks")


def _apart(variants: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Variants alone below their prefix, and those with siblings."""
    alone = variants.groupBy("start").agg(F.count("*").alias("n"), F.min("end").alias("end")).filter("n = 1").select("end")
    alone = write_and_read(alone, "op13-alone")
    return variants.join(alone, "end", "left_semi"), variants.join(alone, "end", "left_anti")


def _inner(variants: DataFrame, *columns: str) -> DataFrame:
    """A row per turn of each variant, with the variant's columns."""
    return variants.select(F.explode("turns").alias("t"), *columns).select("t.*", *columns)


def nodes_of(blocks: DataFrame) -> DataFrame:
    """(node, depth, parent, words, upto, n_convs, conv_id) of all nodes below the root, written."""
    variants = write_and_read(blocks.groupBy("start", "end").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("turns").alias("turns")), "op13-variants")
    alone, siblings = _apart(variants)
    refined = _inner(siblings, "n_convs", "conv_id").groupBy("node", "depth", "parent", "words", "upto").agg(
        F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
    return write_and_read(_inner(alone, "n_convs", "conv_id").unionByName(refined), "op13-nodes")


def _chunks(batches):
    """Ids of a node, in order, joined into strings of at most CHUNK_IDS."""
    node, ids = None, []

    def flush():
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]], pa.int64()),
                                           pa.array([",".join(map(str, ids))])], ["node", "first", "ids"])

    for batch in batches:
        for here, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist()):
            if ids and (here != node or len(ids) >= CHUNK_IDS):
                yield flush()
                ids = []
            node = here
            ids.append(conv)
    if ids:
        yield flush()


def _digests(batches):
    """One digest per node over its strings in order; holds the state of one node at a time."""
    node, state = None, None

    def result():
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([state.hexdigest()])], ["node", "ends_sha256"])

    for batch in batches:
        for here, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist()):
            if state is None or here != node:
                if state is not None:
                    yield result()
                node, state = here, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
    if state is not None:
        yield result()


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id): the digest of a node's ids, ascending and joined by commas.

    Ids are sorted in ranges, so that those of one node spread over tasks, and joined into strings
    there. A digest runs through a node's strings in one task, in order and without holding them.
    """
    ranges = int(ends.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = write_and_read(ends, "op13-ends").repartitionByRange(ranges, "node", "conv_id")
    chunks = ranged.sortWithinPartitions("node", "conv_id").mapInArrow(_chunks, "node string, first bigint, ids string")
    return (chunks.repartition("node").sortWithinPartitions("node", "first")
            .mapInArrow(_digests, "node string, ends_sha256 string"))


def prefix_trie(ids: DataFrame, turns: DataFrame, block_turns: int = BLOCK_TURNS, max_group: int | None = None) -> DataFrame:
    """One row per distinct prefix: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, words.

    ``ids`` (conv_id) are distinct conversations, ``turns`` (conv_id, pos, content, words) their turns, numbered from 1
    without gaps; a conversation may have none. The root, of depth 0, has all conversations. ``conv_id`` is a
    node's smallest member and ``parent_conv_id`` its parent's, null for the root; ``n_leaves`` counts childless
    nodes of the subtree, the node itself if it is one; ``saved_tokens`` sums (n_convs - 1) * words of the last turn
    over the subtree; ``ends_sha256`` is the digest of the ids that end at the node, ascending, joined by
    commas. Equal conversations share all nodes. Without conversations there are no rows, not even the root.
    """
    prefixes = with_prefixes(turns, max_group)
    blocks = blocks_of(prefixes, block_turns)
    below = nodes_of(blocks)
    zero = F.lit(0).cast("bigint")
    root = ids.agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("conv_id")).filter("n_convs > 0").select(
        F.lit(ROOT).alias("node"), zero.alias("depth"), F.lit(None).cast("string").alias("parent"),
        zero.alias("words"), zero.alias("upto"), "n_convs", "conv_id")
    children = below.groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    nodes = write_and_read(below.unionByName(root).join(children, "node", "left").withColumn(
        "n_children", F.coalesce("n_children", zero)), "op13-nodes")

    # by conversation: the words and the depth before its own nodes, whether it owns a leaf, and where it ends
    owned = nodes.groupBy("conv_id").agg(F.min("depth").alias("own_from"), F.min(F.col("upto") - F.col("words")).alias("before"),
                                         F.max((F.col("n_children") == 0).cast("bigint")).alias("leaf"))
    last = blocks.groupBy("conv_id").agg(F.max(F.struct("k", "end", "upto")).alias("last"))
    per_conv = write_and_read(ids.join(last, "conv_id", "left").join(owned, "conv_id", "left").select(
        "conv_id", F.coalesce("last.end", F.lit(ROOT)).alias("node"),
        F.coalesce("own_from", F.lit((1 << 62))).alias("own_from"),
        F.coalesce("before", "last.upto", zero).alias("shared"), F.coalesce("leaf", zero).alias("leaf")), "op13-conversations")

    # by variant: leaves, and words that its conversations share beyond the block; by turn inside: the words from it to the block's end
    joined = blocks.join(per_conv.select("conv_id", "own_from", "shared", "leaf"), "conv_id")
    sums = write_and_read(joined.groupBy("start", "end").agg(
        F.count("*").alias("n_convs"), F.min(F.struct("conv_id", "own_from"))["own_from"].alias("own_from"),
        F.sum(F.greatest(F.col("shared") - F.col("upto"), zero)).alias("beyond"), F.sum("leaf").alias("n_leaves"),
        F.first("turns").alias("turns")), "op13-sums")
    shared = lambda t: t["words"] * (F.col("n_convs") - (t["depth"] >= F.col("own_from")).cast("bigint"))
    rest = lambda t: F.aggregate(F.filter("turns", lambda u: u["depth"] >= t["depth"]), F.col("beyond"),
                                 lambda a, u: a + shared(u))
    inside = F.transform("turns", lambda t: F.struct(t["node"].alias("node"), rest(t).alias("saved_tokens")))
    alone, siblings = _apart(sums.select("start", "end", "n_leaves", inside.alias("turns")))
    refined = _inner(siblings, "n_leaves").groupBy("node").agg(
        F.sum("saved_tokens").alias("saved_tokens"), F.sum("n_leaves").alias("n_leaves"))
    whole = per_conv.agg(F.sum("shared").alias("saved_tokens"), F.sum("leaf").alias("n_leaves")).select(
        F.lit(ROOT).alias("node"), "saved_tokens", "n_leaves")
    totals = _inner(alone, "n_leaves").unionByName(refined).unionByName(whole)

    digests = end_digests(per_conv.select("node", "conv_id"))
    full = write_and_read(nodes.join(totals, "node").join(digests, "node", "left"), "op13-full")
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return full.join(parents, "parent", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"), "words")
