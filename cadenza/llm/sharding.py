"""Sharding by minimax contiguous partition.

Rows of equal texts are one atomic group. Groups stand in the order of their smallest id, and shards are
consecutive stretches of that order. The smallest capacity that lets all groups fit into the wanted number
of shards is found by binary search, each candidate checked by filling shard after shard; then the
order is cut so that no shard goes beyond it and every cut lies as near as it can to an even share of what is left.

The order and its running sizes are Spark tables. The driver only looks running sizes up: it knows those
at the ends of a bounded number of blocks, and asks the table for the inside of the blocks that the
search has met, until no lookup falls inside a block any more.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

from pyspark.sql import DataFrame, functions as F

from cadenza.operators.ordering import running
from cadenza.session import write_and_read

SHARDS = 40
#: Bytes that a row has besides its text.
ROW_BYTES = 16
#: Blocks of the first summary, and parts into which each block met is cut, that come to the driver.
BLOCKS, PARTS = 16_384, 64
#: Groups or rows that one task puts in order.
ORDERED_ROWS = 50_000


class Missing(Exception):
    """A lookup fell inside a block whose groups are not known."""


class Ends:
    """Running sizes of the ordered groups as far as known.

    ``ends[i]`` is a known running size and ``inside[i]`` the number of groups that end between
    ``ends[i - 1]`` and it.
    """

    def __init__(self, ends: list[int], inside: list[int]):
        self.ends, self.inside = [0, *ends], [0, *inside]
        self.total = self.ends[-1]
        self.met: set[int] = set()

    def floor(self, target: int) -> int:
        """The largest known running size not above ``target``; notes the block if there may be a larger one."""
        at = bisect_right(self.ends, target)
        if at < len(self.ends) and self.inside[at] and self.ends[at - 1] < target:
            self.met.add(at)
        return self.ends[at - 1]

    def ceiling(self, target: int) -> int:
        """The smallest known running size not below ``target``; notes the block if there may be a smaller one."""
        at = min(bisect_left(self.ends, target), len(self.ends) - 1)
        if self.inside[at] and self.ends[at] > target:
            self.met.add(at)
        return self.ends[at]

    def blocks_met(self) -> list[tuple[int, int]]:
        return [(self.ends[at - 1], self.ends[at]) for at in sorted(self.met)]

    def refine(self, found: dict[int, list[tuple[int, int]]]) -> None:
        """Replace blocks, by their start, with (end, groups inside) of their parts."""
        ends, inside = [0], [0]
        for at in range(1, len(self.ends)):
            for end, n in found.get(self.ends[at - 1], [(self.ends[at], self.inside[at])]) if at in self.met else [
                    (self.ends[at], self.inside[at])]:
                ends.append(end)
                inside.append(n)
        self.ends, self.inside, self.met = ends, inside, set()


def fits(ends: Ends, shards: int, capacity: int) -> bool:
    """Whether shards filled one after the other, none beyond ``capacity``, take all groups."""
    start = 0
    for _ in range(shards):
        if start + capacity >= ends.total:
            return True
        start = ends.floor(start + capacity)
    return start >= ends.total


def smallest_capacity(ends: Ends, shards: int, largest: int) -> int:
    low = max(largest, -(-ends.total // shards))
    high = max(low, -(-ends.total // shards) + largest)
    while low < high:
        middle = (low + high) // 2
        if fits(ends, shards, middle):
            high = middle
        else:
            low = middle + 1
    return low


def cuts_within(ends: Ends, shards: int, capacity: int) -> list[int]:
    """Running sizes at which the order is cut, ``shards`` - 1 of them, no shard beyond ``capacity``."""
    latest = [ends.total]
    for _ in range(shards - 1):
        # the earliest cut from which the shards behind it still take the rest
        latest.append(ends.ceiling(max(0, latest[-1] - capacity)))
    earliest = latest[::-1]
    cuts, start = [], 0
    for i in range(1, shards):
        wanted = start + (ends.total - start) / (shards - i + 1)
        below, above = ends.floor(int(wanted)), ends.ceiling(-int(-wanted // 1))
        near = below if wanted - below <= above - wanted and below > start else above
        start = min(max(near, earliest[i - 1]), ends.floor(start + capacity))
        cuts.append(start)
    return cuts


def _known(groups: DataFrame, keys: list[str]) -> list:
    """(first, end, n) of parts: of each, the first and the last end, and how many groups lie before it unknown."""
    rows = groups.groupBy(*keys).agg(F.min("end").alias("least"), F.max("end").alias("most"), F.count("*").alias("n")).collect()
    known = []
    for r in sorted(rows, key=lambda r: r["most"]):
        first = r["first"] if "first" in keys else 0
        known += [(first, r["least"], 0)] + ([(first, r["most"], r["n"] - 2)] if r["n"] > 1 else [])
    return known


def _inside(groups: DataFrame, blocks: list[tuple[int, int]], bucket, parts: int) -> dict[int, list[tuple[int, int]]]:
    """For each block (first, last]: the ends known of its ``parts`` parts of equal size.

    A block with any unknown end gains one, however uneven its groups are. Blocks are found by the
    bucket of the first summary that they lie in.
    """
    wanted = groups.sparkSession.createDataFrame(blocks, "first bigint, last bigint")
    wanted = wanted.select("first", "last", bucket(F.col("last")).alias("bucket"))
    inside = groups.withColumn("bucket", bucket(F.col("end"))).join(F.broadcast(wanted), "bucket").filter(
        (F.col("end") > F.col("first")) & (F.col("end") <= F.col("last")))
    part = F.floor((F.col("end") - F.col("first") - 1) / (F.col("last") - F.col("first")) * parts)
    found: dict[int, list[tuple[int, int]]] = {}
    for first, end, n in _known(inside.withColumn("part", part), ["first", "part"]):
        found.setdefault(first, []).append((end, n))
    return found


def minimax_cuts(groups: DataFrame, shards: int = SHARDS, blocks: int = BLOCKS, parts: int = PARTS) -> tuple[int, list[int]]:
    """(smallest capacity, cuts) of a written table (size, end): sizes above 0 and their running sums.

    Exact: the driver repeats its search while a lookup falls inside a block, each time with the blocks it
    met cut into ``parts``; the rows it has do not grow with the table, only the rounds do, with its logarithm.
    """
    total, largest = groups.agg(F.max("end"), F.max("size")).first()
    if not total:
        return 0, [0] * (shards - 1)
    bucket = lambda end: F.floor((end - 1) / F.lit(total / blocks))
    first = _known(groups.withColumn("bucket", bucket(F.col("end"))), ["bucket"])
    ends = Ends([end for _, end, _ in first], [n for *_, n in first])
    while True:
        capacity = smallest_capacity(ends, shards, largest)
        cuts = cuts_within(ends, shards, capacity)
        if not ends.met:
            return capacity, cuts
        ends.refine(_inside(groups, ends.blocks_met(), bucket, parts))


def prepare(docs: DataFrame, carry: bool = False) -> DataFrame:
    """Each row under an own number ``rid`` with its size and digests, written; ``carry`` keeps the whole row."""
    raw = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if carry else []
    return write_and_read(docs.select(
        F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(raw) + F.lit(ROW_BYTES)).cast("bigint").alias("size"), F.crc32(raw).alias("text_crc32"),
        F.sha2(raw, 256).alias("digest"), *row), "op12-rows")


def ordered_groups(rows: DataFrame) -> DataFrame:
    """(digest, size, end): groups of equal texts in the order of their smallest id, with running sizes, written.

    A group's rows are summed before they are shuffled. Ids that are null come last.
    """
    groups = write_and_read(rows.groupBy("digest").agg(F.min("doc_id").alias("least"), F.sum("size").alias("size")), "op12-groups")
    order = [F.col("least").asc_nulls_last(), F.col("digest")]
    placed = running(groups.withColumn("all", F.lit(0)), ["all"], order, sums={"end": "size"}, rank="nth",
                     max_group=ORDERED_ROWS)
    return write_and_read(placed.select("digest", "size", "end"), "op12-order")


def assigned(rows: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(rid, doc_id, size, text_crc32, shard, slot) of prepared rows; slots count from 0 in the order of ids."""
    groups = ordered_groups(rows)
    _, cuts = minimax_cuts(groups, shards)
    # a group starts at end - size; its shard is the number of cuts at or before its start
    begin = F.col("end") - F.col("size")
    shard = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c <= begin)) if cuts else F.lit(0)
    shards_of = write_and_read(groups.select("digest", shard.cast("int").alias("shard")), "op12-shards")
    # both sides are dealt out for the join, so that the rows of a large group can be split
    placed = rows.select("rid", "doc_id", "size", "text_crc32", "digest").join(shards_of, "digest").drop("digest")
    numbered = running(write_and_read(placed, "op12-placed"), ["shard"],
                       [F.col("doc_id").asc_nulls_last(), F.col("rid")], rank="slot", max_group=ORDERED_ROWS)
    return numbered.withColumn("slot", (F.col("slot") - 1).cast("bigint"))


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): the shard of each document and its place there.

    ``size`` is the text's length in UTF-8 bytes plus 16. Texts that are equal, by their SHA-256, share a
    shard; null and empty texts are equal, of size 16. No partition of the groups in the order of
    their smallest ids has a smaller largest shard. A group larger than an even share fills a shard alone or
    nearly so, and with fewer groups than shards some shards are empty. Repeated and null ids are rows like
    others; null ids come last. An empty table gives an empty table. Other columns, whatever their names, are ignored.
    """
    return assigned(prepare(docs), shards).select("doc_id", "size", "text_crc32", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> DataFrame:
    """Write the rows of ``docs`` to ``path/shard=N/`` by the rules of ``assign``; returns bytes and rows per shard.

    A shard's rows are written in ranges of slots, so that no task writes a whole shard of a large table.
    """
    rows = prepare(docs, carry=True)
    placed = assigned(rows, shards).select("rid", "size", "shard", "slot")
    placed = write_and_read(rows.select("rid", "row").join(placed, "rid"), "op12-whole")
    (placed.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
     .select("shard", "slot", "row").write.partitionBy("shard").option("compression", "zstd").parquet(path))
    return placed.groupBy("shard").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
