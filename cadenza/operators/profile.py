"""Descriptive tables: counts, moments, quantiles, correlations, histograms, components."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, functions as F

from cadenza.operators.clean import scale
from cadenza.operators.moments import co_moments, correlations_of
from cadenza.operators.quantiles import exact_boxes, exact_quantiles, long_form, quantile_state
from cadenza.schema import MOOD_PLOT_ORDER, feature_vector, numeric_columns
from cadenza.session import write_and_read


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    total = df.agg(F.count("*")).scalar()
    return counts.withColumn("pct", 100.0 * F.col("n") / total)


def top_values(df: DataFrame, column: str, n: int) -> DataFrame:
    return value_counts(df, column).drop("pct").orderBy(F.col("n").desc(), column).limit(n)


def label_counts(df: DataFrame, column: str) -> DataFrame:
    return value_counts(df, column).drop("pct").orderBy(column)


def table_profile(df: DataFrame, order: str) -> DataFrame:
    """Column names, row count and the first row, as one row."""
    first = df.orderBy(order).limit(1).select(F.to_json(F.struct(*df.columns))).scalar()
    return df.agg(F.count("*").alias("n_rows")).select(
        F.lit(", ".join(df.columns)).alias("columns"), "n_rows", first.alias("sample"))


def describe(df: DataFrame, columns, state: DataFrame | None = None) -> DataFrame:
    """Moments and exact quartiles in two scans, or one with the written ``quantile_state`` of ``df``.

    Without a state the columns are written once for both scans.
    """
    if state is None:
        df = write_and_read(df.select(*columns), "described")
        state = write_and_read(quantile_state(df, columns), "quantile-state")
    moments = state.filter(F.col("feature").isin(*columns) & (F.col("n") > 0)).select(
        "feature", F.col("n").alias("count"), "mean",
        F.when(F.col("n") > 1, F.sqrt(F.col("square") / (F.col("n") - 1))).alias("std"), "min", "max")
    quartiles = exact_quantiles(df, columns, [0.25, 0.5, 0.75], state=state)
    # one row per feature on both sides
    return moments.join(F.broadcast(quartiles), "feature").select(
        "feature", "count", "mean", "std", "min", F.col("q0").alias("p25"),
        F.col("q1").alias("p50"), F.col("q2").alias("p75"), "max")


def correlations(df: DataFrame, columns) -> DataFrame:
    """Lower triangle of the Pearson matrix over rows where both features are present, in one pass."""
    if len(columns) < 2:
        raise ValueError("need at least two features")
    return correlations_of(co_moments(df, columns))


def histogram(df: DataFrame, columns, bins: int, state: DataFrame | None = None) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last closed on the right, empty bins included.

    The ends come from the written ``quantile_state`` of ``df`` if there is one, else from a scan of their own.
    """
    long = long_form(df, columns)
    if state is None:
        ends = long.groupBy("feature").agg(F.min("value").alias("lo"), F.max("value").alias("hi"), F.avg("value").alias("mean"))
    else:
        ends = state.filter(F.col("feature").isin(*columns) & (F.col("n") > 0)).select(
            "feature", F.col("min").alias("lo"), F.col("max").alias("hi"), "mean")
    flat = F.col("lo") == F.col("hi")
    ends = ends.select("feature", "mean", F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
                       F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    # one row per feature
    at = F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (long.join(F.broadcast(ends), "feature")
              .groupBy("feature", F.least(at, F.lit(bins - 1)).cast("int").alias("bin"))
              .agg(F.count("*").alias("n")))
    grid = ends.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    step = (F.col("hi") - F.col("lo")) / bins
    return grid.join(F.broadcast(counts), ["feature", "bin"], "left").select(
        "feature", "bin", (F.col("lo") + F.col("bin") * step).alias("bin_start"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"), "mean")


def box_summary(df: DataFrame, columns, by: str = "mood_label", groups=None, state: DataFrame | None = None) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and outlier counts per group.

    Moods are the fixed ones; of any other column every label is a group, unless ``groups`` lists some.
    ``state`` is the written ``quantile_state`` of ``df`` by that column, if there is one.
    """
    groups = groups or (MOOD_PLOT_ORDER if by == "mood_label" else None)
    if state is None:
        df = write_and_read(df.select(by, *columns), "boxed")
    return exact_boxes(df, columns, by, groups, state)


def mood_statistics(df: DataFrame, by: str = "mood_label", genre: str = "primary_genre") -> DataFrame:
    """Per mood: size, average popularity and followers, most frequent genre (smallest on a tie).

    Rows are first counted per (mood, genre), so a mood with most of the rows costs one task no more than others.
    """
    parts = df.groupBy(by, genre).agg(
        F.count("*").alias("n"), F.sum("popularity").alias("sp"), F.count("popularity").alias("np"),
        F.sum("artist_followers").alias("sf"), F.count("artist_followers").alias("nf"))
    rank = F.struct((-F.col("n")).alias("neg"), F.col(genre).alias("g"))
    return parts.groupBy(by).agg(
        F.sum("n").alias("n_tracks"),
        (F.sum("sp") / F.sum("np")).alias("avg_popularity"),
        (F.sum("sf") / F.sum("nf")).alias("avg_followers"),
        F.coalesce(F.min(F.when(F.col(genre).isNotNull(), rank))["g"], F.lit("Unknown")).alias("top_genre"))


def principal_components(df: DataFrame, columns, k: int = 2, label: str | None = "mood_label",
                         id_col: str = "id") -> tuple[DataFrame, list[float]]:
    """Labelled coordinates on the first k components of the standardized features, and variance ratios.

    Each component is signed so that its largest loading is positive.
    """
    keep = [id_col] + ([label] if label and label in df.columns else [])
    clean = df.select(*keep, *columns).dropna(subset=list(columns))
    scaled, _ = scale(clean, "standard", exclude=keep)
    packed = scaled.select(*keep, array_to_vector(feature_vector(columns)).alias("features"))
    model = PCA(k=k, inputCol="features", outputCol="pc").fit(packed)
    loadings = model.pc.toArray()
    signs = [1.0 if col[abs(col).argmax()] > 0 else -1.0 for col in loadings.T]
    arr = vector_to_array(F.col("pc"))
    coords = model.transform(packed).select(
        *keep, *[(arr[i] * signs[i]).alias(f"pc{i + 1}") for i in range(k)])
    return coords, [float(x) for x in model.explainedVariance]


def numeric_correlations(df: DataFrame, exclude=()) -> DataFrame:
    return correlations(df, numeric_columns(df, exclude))
