"""Shaping results for display."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.functions.scalars import explanation, output_similarity


def output_rows(df: DataFrame, mode: Column, engine: Column, keep=("qid",)) -> DataFrame:
    """One display row per result. ``df`` has ``rank`` plus whatever columns and scores it carries."""
    def text(*names):
        given = [F.col(c).cast("string") for c in names if c in df.columns]
        return F.coalesce(*given, F.lit("Unknown"))

    def number(name):
        return F.coalesce(F.col(name).cast("double"), F.lit(0.0)) if name in df.columns else F.lit(0.0)

    ids = [F.col(c).cast("string") for c in ("id", "track_id") if c in df.columns]
    return df.select(
        *[c for c in keep if c in df.columns], "rank",
        F.coalesce(*ids, F.col("rank").cast("string")).alias("id"),
        text("name").alias("name"), text("artists", "artist_names").alias("artist"),
        *[number(c).alias(c) for c in ("popularity", "energy", "danceability", "valence")],
        output_similarity(df.columns).alias("similarity"),
        explanation(df.columns, mode, engine).alias("reasons"))
