"""Missing values, imputation and scaling.

Column statistics are one-row aggregates used as scalar subqueries, so they stay lazy,
are computed once per query and never travel through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.scalars import bounded_release_year
from cadenza.operators.quantiles import exact_quantiles, medians
from cadenza.session import write_and_read
from cadenza.schema import SCALE_EXCLUDED, TEXT_COLUMNS, numeric_columns, present

EPSILON = 1e-8


def attach_row(df: DataFrame, one_row: DataFrame, name: str = "_stats") -> DataFrame:
    """Every row with the fields of a one-row table, as a struct column."""
    return df.withColumn(name, one_row.select(F.struct(*one_row.columns)).scalar())


def column_stats(df: DataFrame, columns, std: str = "population") -> DataFrame:
    spread = {"population": F.stddev_pop, "sample": F.stddev_samp}[std]
    return df.agg(*[F.avg(c).alias(f"mean_{c}") for c in columns],
                  *[spread(c).alias(f"std_{c}") for c in columns])


def stats_by_feature(stats: DataFrame, columns) -> DataFrame:
    """The same one-row statistics, one feature per row."""
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"mean_{c}").alias("mean"),
                              F.col(f"std_{c}").alias("std")) for c in columns])
    return stats.select(F.explode(rows).alias("r")).select("r.*")


def zscore(df: DataFrame, columns, std: str = "population", stats: DataFrame | None = None) -> DataFrame:
    """(x - mean) / (std + 1e-8) in place."""
    stats = column_stats(df, columns, std) if stats is None else stats
    s = F.col("_stats")
    return attach_row(df, stats).withColumns({
        c: (F.col(c) - s[f"mean_{c}"]) / (s[f"std_{c}"] + EPSILON) for c in columns}).drop("_stats")


def _nonzero(x: Column) -> Column:
    return F.when(x == 0, F.lit(1.0)).otherwise(x)


def scale_columns(df: DataFrame, exclude=SCALE_EXCLUDED) -> list[str]:
    return numeric_columns(df, exclude)


def scale_params(df: DataFrame, columns, method: str = "standard") -> DataFrame:
    """One row with ``shift_c`` and ``scale_c`` per column; a constant column is only shifted."""
    if method == "standard":
        shift, scale = F.avg, F.stddev_pop
    elif method == "minmax":
        shift, scale = F.min, lambda c: F.max(c) - F.min(c)
    else:
        raise ValueError("method must be 'standard' or 'minmax'")
    return df.agg(*[shift(c).cast("double").alias(f"shift_{c}") for c in columns],
                  *[_nonzero(scale(c).cast("double")).alias(f"scale_{c}") for c in columns])


def scale(df: DataFrame, method: str = "standard", exclude=SCALE_EXCLUDED) -> tuple[DataFrame, DataFrame | None]:
    """Scaled table and fitted parameters."""
    columns = scale_columns(df, exclude)
    if not columns:
        return df, None
    params = scale_params(df, columns, method)
    s = F.col("_stats")
    scaled = attach_row(df, params).withColumns({
        c: (F.col(c) - s[f"shift_{c}"]) / s[f"scale_{c}"] for c in columns}).drop("_stats")
    return scaled, params


def missing_counts(df: DataFrame, columns) -> DataFrame:
    """Missing count and percent per column, in one pass."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("missing")) for c in columns])
    return one.select("n", F.explode(rows).alias("r")).select(
        "r.*", (100.0 * F.col("r.missing") / F.col("n")).alias("missing_pct"))


def most_frequent(df: DataFrame, columns) -> DataFrame:
    """One row: the most frequent value per column, the smallest on a tie."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    counts = (df.select(F.explode(pairs).alias("p")).select("p.*").filter(F.col("value").isNotNull())
              .groupBy("feature", "value").agg(F.count("*").alias("n")))
    best = counts.groupBy("feature").agg(
        F.max(F.struct("n", (-F.col("value")).alias("neg"))).alias("b"))
    return best.agg(*[F.max(F.when(F.col("feature") == c, -F.col("b.neg"))).alias(c) for c in columns])


def impute_values(df: DataFrame, columns, strategy: str = "median") -> DataFrame:
    if strategy == "mean":
        return df.agg(*[F.avg(c).alias(c) for c in columns])
    if strategy == "median":
        return medians(df, columns)
    if strategy == "most_frequent":
        return most_frequent(df, columns)
    if strategy == "constant":
        return df.sparkSession.range(1).select(*[F.lit(0.0).alias(c) for c in columns])
    raise ValueError(f"unknown strategy {strategy!r}")


def impute(df: DataFrame, strategy: str = "median", exclude=("track_id", "artist_id"),
           settle: bool = False) -> DataFrame:
    """Fill missing numbers with the column's statistic, missing text with 'Unknown'.

    ``settle`` writes the statistics, so that later passes read them instead of fitting again.
    """
    columns = numeric_columns(df, exclude)
    if columns:
        values = impute_values(df, columns, strategy)
        values = write_and_read(values, "impute-values") if settle else values
        df = attach_row(df, values).withColumns({
            c: F.coalesce(F.col(c).cast("double"), F.col("_stats")[c]) for c in columns}).drop("_stats")
    return fill_text(df)


def fill_text(df: DataFrame, columns=TEXT_COLUMNS) -> DataFrame:
    return df.fillna("Unknown", subset=present(df, columns))


def add_release_year(df: DataFrame, column: str = "release_date", settle: bool = False, fill: bool = True) -> DataFrame:
    """``release_year`` in range, the median year where the date gives none.

    Without ``fill`` it stays missing there, for an imputation by medians that fits all columns at once.
    """
    if column not in df.columns:
        return df
    dated = df.withColumn("release_year", bounded_release_year(F.col(column)).cast("double"))
    if not fill:
        return dated
    median = exact_quantiles(dated, ["release_year"], [0.5]).agg(F.max("q0").alias("year"))
    median = write_and_read(median, "median-year") if settle else median
    return dated.withColumn("release_year", F.coalesce("release_year", median.scalar()))


def drop_missing(df: DataFrame, columns) -> DataFrame:
    return df.dropna(subset=list(columns))
