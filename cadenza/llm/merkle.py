"""WARC fixity audit with Merkle trees; DataFrame operations only.

A replica is a table of records: file, offset, length and the digest of the bytes. The leaf of a
record is the digest of that together with its place. The records of a fixed range of offsets form a node
whose digest is over the ordered leaves; ``fanout`` neighbouring ranges form the next node, up to a
root per file. Roots of two replicas are compared first; below a node whose digests are equal
nothing is read, so that leaves are compared only under mismatching branches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadenza.operators.ordering import running
from cadenza.session import write_and_read

#: Bytes of a lowest offset range, and ranges below one node.
RANGE_BYTES = 1 << 16
FANOUT = 16


def warc_records(pages: DataFrame, per_file: int = 1000) -> DataFrame:
    """(file, page_id, length, record): a response record per page, ``per_file`` ids to a file.

    Pages without an id go to files named by a hash of their contents. Null addresses and bodies are empty.
    """
    page, url, body = (F.col("page_id").cast("bigint"), F.coalesce(F.col("url").cast("string"), F.lit("")),
                       F.coalesce(F.col("html").cast("string"), F.lit("")))
    record = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
                      F.coalesce(page.cast("string"), F.lit("none")), F.lit(">\r\nWARC-Target-URI: "), url,
                      F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"),
                      body, F.lit("\r\n\r\n"))
    file = F.coalesce(F.floor(page / F.lit(per_file)).cast("string"),
                      F.concat(F.lit("none-"), F.pmod(F.xxhash64(url, body), F.lit(65536)).cast("string")))
    return pages.select(file.alias("file"), page.alias("page_id"), record.alias("record")).select(
        "file", "page_id", F.octet_length("record").cast("bigint").alias("length"), "record")


def content(record) -> F.Column:
    """Digest of a record's bytes, by which the bytes are known from here on."""
    return F.sha2(record.cast("binary"), 256)


def with_offsets(rows: DataFrame, order: list) -> DataFrame:
    """Adds ``offset``: records lie end to end within their file, in ``order``; for files of any size."""
    placed = running(rows, ["file"], order, sums={"end": "length"}, rank="nth")
    return placed.withColumn("offset", F.col("end") - F.col("length")).drop("end", "nth")


def leaves(replica: DataFrame) -> DataFrame:
    """(file, offset, length, page_id, digest): the digest is over a record's place and contents."""
    place = F.concat_ws(":", "file", "offset", "length")
    return replica.filter("content IS NOT NULL").select(
        "file", "offset", "length", "page_id", F.sha2(F.concat_ws("|", place, "content").cast("binary"), 256).alias("digest"))


def _joined(parts: str, at: str):
    ordered = F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), F.col(parts).alias("digest"))))
    return F.sha2(F.concat_ws(",", F.transform(ordered, lambda x: x["digest"])).cast("binary"), 256)


def tree(leaf_rows: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT,
         height: int | None = None) -> DataFrame:
    """(file, level, node, digest, height) for all levels above the leaves; the root has the highest level.

    The height follows from the largest offset. A node has ``fanout`` children, and a range the records
    that start in it.
    """
    if height is None:
        height = levels_for(leaf_rows.agg(F.max("offset")).first()[0], range_bytes, fanout)
    level = (leaf_rows.withColumn("node", F.floor(F.col("offset") / range_bytes))
             .groupBy("file", "node").agg(_joined("digest", "offset").alias("digest")))
    level = write_and_read(level.withColumn("level", F.lit(0)), "op1-level")
    whole = level
    for n in range(1, height + 1):
        level = (level.select("file", F.col("node").alias("child"), "digest")
                 .withColumn("node", F.floor(F.col("child") / fanout))
                 .groupBy("file", "node").agg(_joined("digest", "child").alias("digest")).withColumn("level", F.lit(n)))
        whole = whole.unionByName(level)
    return whole


def levels_for(largest, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> int:
    ranges, height = (largest or 0) // range_bytes + 1, 0
    while ranges > 1:
        ranges, height = -(-ranges // fanout), height + 1
    return height


def audit(left: DataFrame, right: DataFrame, range_bytes: int = RANGE_BYTES, fanout: int = FANOUT) -> DataFrame:
    """(file, offset, length, page_id, kind, left_digest, right_digest): where two replicas differ.

    ``kind`` is ``changed``, ``missing`` (left only) or ``extra`` (right only). Replicas are tables of
    (file, offset, length, page_id, content), see ``content``; other columns are ignored. Offsets and
    lengths are those of the catalog both replicas were written by, so that a damaged record does not
    move the rest. Null contents are a missing record; several records at one place are compared as
    a sorted list. Equal replicas, or two empty ones, give no rows.
    """
    sides = [write_and_read(leaves(side), "op1-leaves") for side in (left, right)]
    height = max(levels_for(side.agg(F.max("offset")).first()[0], range_bytes, fanout) for side in sides)
    trees = [write_and_read(tree(side, range_bytes, fanout, height), "op1-tree") for side in sides]
    suspects = None
    for level in range(height, -1, -1):
        here = [t.filter(F.col("level") == level).select("file", "node", F.col("digest").alias(name))
                for t, name in zip(trees, ("a", "b"))]
        if suspects is not None:
            below = suspects.select("file", F.col("node").alias("parent"))
            here = [h.withColumn("parent", F.floor(F.col("node") / fanout)).join(below, ["file", "parent"], "left_semi")
                    .drop("parent") for h in here]
        pairs = here[0].join(here[1], ["file", "node"], "full").filter(~F.col("a").eqNullSafe(F.col("b")))
        suspects = write_and_read(pairs.select("file", "node"), "op1-suspects")
    suspects = suspects.withColumnRenamed("node", "range")
    found = []
    for side, name in zip(sides, ("left", "right")):
        ranged = side.withColumn("range", F.floor(F.col("offset") / range_bytes))
        found.append(ranged.join(suspects, ["file", "range"], "left_semi").groupBy("file", "offset").agg(
            F.max("length").alias(f"{name}_length"), F.min("page_id").alias(f"{name}_page"),
            F.concat_ws(",", F.sort_array(F.collect_list("digest"))).alias(f"{name}_digest")))
    both = found[0].join(found[1], ["file", "offset"], "full")
    differ = both.filter(~F.col("left_digest").eqNullSafe(F.col("right_digest")))
    kind = (F.when(F.col("right_digest").isNull(), "missing").when(F.col("left_digest").isNull(), "extra")
            .otherwise("changed"))
    return differ.select("file", "offset", F.coalesce("left_length", "right_length").alias("length"),
                         F.coalesce("left_page", "right_page").alias("page_id"), kind.alias("kind"),
                         "left_digest", "right_digest")
