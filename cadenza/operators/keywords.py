"""The first keyword of a table that a text contains: one pass over each text, whatever the number of keywords.

Keywords are a table (pos, keyword, profile). A task builds one automaton of them all (pyahocorasick, which
workers need) and takes, of all occurrences in a text, the keyword of the smallest position. A table beyond the
size bound is cut into parts, each with an automaton of its own, and the smallest position of all parts counts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.session import write_and_read

#: Bytes of keywords, with 64 for each besides its text, that one automaton holds.
PART_BYTES = 32 << 20


def _parts(keywords: DataFrame, part_bytes: int) -> tuple[DataFrame, int]:
    """Distinct keywords under their smallest position, written, with a part number each."""
    once = keywords.filter((F.col("keyword") != "") & F.col("pos").isNotNull()).groupBy("keyword").agg(F.min("pos").cast("bigint").alias("pos"))
    once = write_and_read(once, "keywords")
    size = once.agg(F.coalesce(F.sum(F.octet_length("keyword") + 64), F.lit(0))).first()[0]
    parts = max(1, -(-int(size) // part_bytes))
    return once.withColumn("part", F.pmod(F.xxhash64("keyword"), F.lit(parts))), parts


def _matcher(keywords):
    """A function from batches (_rid, _text) to (_rid, pos), the smallest position found or null."""
    def match(batches):
        import ahocorasick
        automaton = ahocorasick.Automaton()
        for word, pos in keywords.value:
            automaton.add_word(word, pos)
        automaton.make_automaton()
        for batch in batches:
            found = [min((pos for _, pos in automaton.iter(text)), default=None) if text and len(automaton) else None
                     for text in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("_rid"), pa.array(found, pa.int64())], ["_rid", "pos"])
    return match


def first_keyword(texts: DataFrame, keywords: DataFrame, text: str = "text", part_bytes: int | None = None) -> DataFrame:
    """The columns of ``texts`` but ``text``, with ``pos``, ``keyword`` and ``profile`` of the first keyword contained, else null.

    Case counts. Of repeated keywords the one of the smallest position stands; null and empty ones, and null texts,
    match nothing. Positions are unique. Rows are told apart by a number of their own, so keys may repeat.
    """
    kept = [c for c in texts.columns if c != text]
    rows = write_and_read(texts.select(F.monotonically_increasing_id().alias("_rid"), F.col(text).alias("_text"), *kept), "texts")
    once, parts = _parts(keywords, part_bytes or PART_BYTES)
    spark, found = texts.sparkSession, None
    for part in range(parts):
        words = [(r["keyword"], r["pos"]) for r in once.filter(F.col("part") == part).select("keyword", "pos").collect()]
        here = rows.select("_rid", "_text").mapInArrow(_matcher(spark.sparkContext.broadcast(words)), "_rid bigint, pos bigint")
        here = here.filter(F.col("pos").isNotNull())
        found = here if found is None else found.unionByName(here)
    best = found.groupBy("_rid").agg(F.min("pos").alias("pos")) if parts > 1 else found
    named = best.join(keywords.select(F.col("pos").cast("bigint").alias("pos"), "keyword", "profile"), "pos")
    return rows.join(named, "_rid", "left").select(*kept, "pos", "keyword", "profile")
