"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cadenza.session import write_and_read

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
ROWS_PER_SALT = 1_000_000


def fits_broadcast(df: DataFrame, rows: int | None = None, size: int | None = None) -> bool:
    """Measured on at most ``rows + 1`` rows, so the check itself is bounded."""
    rows, size = rows or BROADCAST_ROWS, size or BROADCAST_BYTES
    width = F.octet_length(F.to_json(F.struct(*df.columns)))
    n, total = df.limit(rows + 1).agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    return n <= rows and total <= size


def _hot_keys(df: DataFrame, keys: list[str], rows_per_salt: int) -> DataFrame:
    """Keys with more than ``rows_per_salt`` rows and the number of salts each gets, written."""
    hot = (df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_salt)
           .select(*keys, F.ceil(F.col("_n") / rows_per_salt).cast("int").alias("_salts")))
    return write_and_read(hot, "hot-keys")


def salted_join(left: DataFrame, right: DataFrame, on, how: str = "inner",
                spread: list[str] | None = None, rows_per_salt: int | None = None) -> DataFrame:
    """Equi-join (inner or left) in which hot keys of ``left`` are split over salts and matched by copies of ``right``.

    Rows of ``left`` with a missing key match nothing and never travel.
    """
    keys = [on] if isinstance(on, str) else list(on)
    given = F.lit(True)
    for key in keys:
        given = given & F.col(key).isNotNull()
    keyed = left.filter(given)
    hot = _hot_keys(keyed, keys, rows_per_salt or ROWS_PER_SALT)
    if hot.isEmpty():
        joined = keyed.join(right, keys, how)
    else:
        # however many hot keys there are: sent to the tasks if they are few, else joined like any table
        few = F.broadcast(hot) if fits_broadcast(hot) else hot
        salt = F.pmod(F.xxhash64(*(spread or left.columns)), F.coalesce(F.col("_salts"), F.lit(1)))
        spread_left = keyed.join(few, keys, "left").withColumn("_salt", salt).drop("_salts")
        last = (F.coalesce(F.col("_salts"), F.lit(1)) - 1).cast("bigint")
        copied_right = (right.join(few, keys, "left")
                        .withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), last))).drop("_salts"))
        joined = spread_left.join(copied_right, [*keys, "_salt"], how).drop("_salt")
    if how not in ("left", "left_outer"):
        return joined
    alone = left.filter(~given)
    for field in joined.schema:
        if field.name not in alone.columns:
            alone = alone.withColumn(field.name, F.lit(None).cast(field.dataType))
    return joined.unionByName(alone)


def lookup_join(left: DataFrame, right: DataFrame, on, how: str = "left",
                spread: list[str] | None = None, write: bool = True) -> DataFrame:
    """Join a large table to a keyed one: broadcast if it measures small, salted otherwise.

    The keyed side is written before it is measured, so that it is worked out once; ``write`` is
    False for one that is a written table already.
    """
    right = write_and_read(right, "lookup") if write else right
    if fits_broadcast(right):
        return left.join(F.broadcast(right), on, how)
    return salted_join(left, right, on, how, spread)


def with_group_totals(df: DataFrame, group: str, columns, spread: list[str] | None = None) -> DataFrame:
    """Each row with its group's row count and sums; totals are aggregated first, then joined back."""
    totals = df.filter(F.col(group).isNotNull()).groupBy(group).agg(
        F.count("*").alias("group_n"), *[F.sum(c).alias(f"group_sum_{c}") for c in columns])
    return lookup_join(df, totals, group, "inner", spread)


def rescaled_in_groups(df: DataFrame, group: str, column: str, spread: list[str] | None = None) -> DataFrame:
    """``rescaled``: min-max within each group, 1 where a group has a single value. For groups of any size."""
    ends = df.groupBy(group).agg(F.min(column).alias("_lo"), F.max(column).alias("_hi"))
    joined = lookup_join(df, ends, group, "inner", spread)
    lo, hi = F.col("_lo"), F.col("_hi")
    return joined.withColumn("rescaled", F.when(hi > lo, (F.col(column) - lo) / (hi - lo)).otherwise(F.lit(1.0))
                             ).drop("_lo", "_hi")


def known_rows(seeds: DataFrame, catalog: DataFrame, key: str = "id") -> tuple[DataFrame, DataFrame]:
    """Seeds found in the catalog, and the rest as errors. A seed may be asked for any number of times."""
    asked = seeds.select(key).distinct()
    ids = catalog.select(key).distinct().join(asked, key).withColumn("_known", F.lit(True))
    flagged = lookup_join(seeds, ids, key, "left")
    return (flagged.filter(F.col("_known")).drop("_known"),
            flagged.filter(F.col("_known").isNull()).drop("_known"))


def fan_out(per_query: DataFrame, per_seed: DataFrame, seed: str = "seed_id") -> DataFrame:
    """Give every query the rows of its seed (``per_seed.qid``); many queries may share a seed."""
    return lookup_join(per_query, per_seed.withColumnRenamed("qid", seed), seed, "inner", spread=["qid"] if "qid" in per_query.columns else None)
