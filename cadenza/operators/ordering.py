"""Row positions, top-n, keep-first and seeded samples.

Ranks end in a unique id, so they never depend on row order. Positions over a table, or a group, too
large for one task come from the counts of ranges of rows plus a rank inside each range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from cadenza.session import write_and_read, write_observed

MAX_GROUP = 1_000_000
#: Rows of a range that is worth a task of its own, however small the groups are that must be spread.
RANGE_ROWS = 250_000


def _position(df: DataFrame, order: list, name: str, max_group: int | None = None) -> DataFrame:
    """0-based position over all rows, as the running rank of one group of any size."""
    ranked = running(df.withColumn("_all", F.lit(0)), ["_all"], order, rank=name, max_group=max_group)
    return ranked.withColumn(name, (F.col(name) - 1).cast("bigint")).drop("_all")


def with_position(df: DataFrame, order: str, name: str, rows_per_bucket: int | None = None) -> DataFrame:
    """0-based position by a unique ``order`` column."""
    return _position(df, [F.col(order)], name, rows_per_bucket)


def shuffle_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def with_shuffled_position(df: DataFrame, id_col: str, seed: int, name: str) -> DataFrame:
    """0-based position in a seeded shuffle."""
    return _position(df.withColumn("_h", shuffle_key(id_col, seed)), [F.col("_h"), F.col(id_col)], name).drop("_h")


def sample_rows(df: DataFrame, n: int, id_col: str = "id", seed: int = 42) -> DataFrame:
    """n rows without replacement, the same rows on every run and partitioning."""
    return (df.withColumn("_h", shuffle_key(id_col, seed))
            .orderBy("_h", id_col).limit(n).drop("_h"))


def keep_first(df: DataFrame, key, order: str = "ingest_seq") -> DataFrame:
    """One row per key, the earliest. Each map task keeps one row per key before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    return top_per_group(df, keys, [F.col(order)], 1)


def keep_first_counted(df: DataFrame, key, order: str = "ingest_seq", missing=(), name: str = "deduplicated") -> tuple[DataFrame, dict]:
    """``keep_first`` as a written table, and what the write saw: ``n_before``, ``n_after``, ``n_removed`` and the
    nulls left in each column of ``missing``, as ``missing_<column>``.

    The earliest row and the number of rows of a key come from one aggregate, combined per map task; no second scan.
    """
    keys = [key] if isinstance(key, str) else list(key)
    others = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*others), F.struct(order))
    kept = df.groupBy(*keys).agg(first.alias("_row"), F.count("*").alias("_copies")).select(*keys, "_row.*", "_copies")
    metrics = {"n_before": F.coalesce(F.sum("_copies"), F.lit(0)), "n_after": F.count(F.lit(1))}
    written, seen = write_observed(kept.select(*df.columns, "_copies"), name, metrics | {
        f"missing_{c}": F.count_if(F.col(c).isNull()) for c in missing})
    return written.drop("_copies"), seen | {"n_removed": seen["n_before"] - seen["n_after"]}


def removed_by_dedupe(df: DataFrame, key: str) -> DataFrame:
    per_key = df.groupBy(key).agg(F.count("*").alias("n"))
    return per_key.agg(F.sum("n").alias("n_before"), F.count("*").alias("n_after"),
                       (F.sum("n") - F.count("*")).alias("n_removed"))


def top_per_group(df: DataFrame, keys: list[str], order: list, k: int, rank: str | None = None) -> DataFrame:
    """First k rows per group (``row_number() <= k`` gets a group limit before the shuffle)."""
    name = rank or "_rank"
    ranked = df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)))
    kept = ranked.filter(F.col(name) <= k)
    return kept if rank else kept.drop(name)


def top_rows(df: DataFrame, by: str, n: int, tie: str = "ingest_seq") -> DataFrame:
    return df.orderBy(F.col(by).desc_nulls_last(), F.col(tie)).limit(n)


def running(df: DataFrame, keys: list[str], order: list, sums: dict[str, str] | None = None,
            rank: str = "rank", max_group: int | None = None) -> DataFrame:
    """1-based ``rank`` and running sums within each group, whatever the size of the largest group.

    Groups that measure small are ordered by a plain window. Otherwise the rows are cut into
    ranges of (keys, order), so one group spreads over as many tasks as it needs, and each
    range continues from the totals of the ranges before it.
    """
    sums = sums or {}
    limit = max_group or MAX_GROUP
    largest, whole = df.groupBy(*keys).agg(F.count("*").alias("n")).agg(F.max("n"), F.sum("n")).first()
    so_far = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    if largest is None or largest <= limit:
        return df.withColumns({rank: F.row_number().over(W.partitionBy(*keys).orderBy(*order)),
                               **{new: F.sum(c).over(so_far) for new, c in sums.items()}})
    # written once: the ranges are sampled, so they must not be drawn again
    ranges = max(-(-whole // max(limit, RANGE_ROWS)), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranged = df.repartitionByRange(ranges, *keys, *order).withColumn("_range", F.spark_partition_id())
    ranged = write_and_read(ranged, "ranges")
    before = W.partitionBy(*keys).orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    totals = ranged.groupBy(*keys, "_range").agg(
        F.count("*").alias("_n"), *[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    starts = totals.select(*keys, "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"), *[
        F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_s_{new}") for new in sums])
    inside = W.partitionBy(*keys, "_range").orderBy(*order)
    return (ranged.withColumns({rank: F.row_number().over(inside), **{
                new: F.sum(c).over(inside.rowsBetween(W.unboundedPreceding, 0)) for new, c in sums.items()}})
            .join(starts, [*keys, "_range"])
            .withColumns({rank: F.col(rank) + F.col("_start"),
                          **{new: F.col(new) + F.col(f"_s_{new}") for new in sums}})
            .drop("_range", "_start", *[f"_s_{new}" for new in sums]))


def number_results(df: DataFrame, query: str, order: list, rank: str = "rank") -> DataFrame:
    return running(df, [query], order, rank=rank)


def listing(df: DataFrame, columns, order: str = "ingest_seq") -> DataFrame:
    """Numbered listing (1-based) of some columns in table order."""
    keep = df.select(order, *[c for c in columns if c != order])
    return with_position(keep, order, "row_no").select(
        (F.col("row_no") + 1).alias("row_no"), *columns)
