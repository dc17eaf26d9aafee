"""Offline ranking quality with a label as proxy for relevance."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from cadenza.operators.blocks import Dot, block_top_k
from cadenza.operators.clean import column_stats
from cadenza.operators.joins import BROADCAST_ROWS, lookup_join
from cadenza.operators.ordering import sample_rows
from cadenza.operators.vectors import feature_table, unit
from cadenza.schema import evaluation_features
from cadenza.session import write_and_read


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A table of at most ``rows`` short rows: broadcast while that is few."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def recommendations(df: DataFrame, k: int = 10, sample_size: int = 200, seed: int = 42,
                    label: str = "mood_label", features: list[str] | None = None) -> DataFrame:
    """Cosine top-k for sampled seeds that have a label: (qid, seed_label, rank, id, label, artists, rel)."""
    id_col = "id" if "id" in df.columns else "track_id"
    artist = next((c for c in ("artists", "artist_names") if c in df.columns), None)
    shown = F.col(artist).cast("string") if artist else F.lit(None).cast("string")
    features = features or evaluation_features(df)
    named = df.select(F.col(id_col).alias("id"), F.col(label).cast("string").alias("label"),
                      shown.alias("artist"), *features)
    filled = named.fillna(0.0, subset=features)
    stats = write_and_read(column_stats(filled, features), "feature-stats")
    items = feature_table(filled, features, stats, keep=("id", "label", "artist"))
    items = items.withColumn("vec", unit(F.col("vec")))
    seeds = sample_rows(named.select("id", "label"), sample_size, "id", seed).filter(F.col("label").isNotNull())
    queries = items.join(_small(seeds.select("id"), sample_size), "id").select(
        F.col("id").alias("qid"), F.col("id").alias("exclude_id"), "vec")
    near = block_top_k(items, queries, k, Dot(), carry=("label", "artist"))
    labels = seeds.select(F.col("id").alias("qid"), F.col("label").alias("seed_label"))
    return near.join(_small(labels, sample_size), "qid").withColumn(
        "rel", F.coalesce(F.col("label") == F.col("seed_label"), F.lit(False)).cast("int"))


def query_metrics(df: DataFrame, recs: DataFrame, k: int, label: str = "mood_label") -> DataFrame:
    """Precision, recall, average precision, NDCG and artist diversity per seed.

    A list of up to k rows per seed is all a window ever holds.
    """
    hits = F.sum("rel").over(W.partitionBy("qid").orderBy("rank").rowsBetween(W.unboundedPreceding, 0))
    gain = F.col("rel") / F.log2(F.col("rank") + 1.0)
    per_query = recs.withColumn("_hits", hits).groupBy("qid", "seed_label").agg(
        F.sum("rel").alias("hits"),
        (F.sum(F.col("rel") * F.col("_hits") / F.col("rank")) / k).alias("average_precision"),
        F.sum(gain).alias("_dcg"),
        (F.count_distinct(F.coalesce("artist", F.lit("None"))) / k).alias("artist_diversity")
        if "artist" in recs.columns else F.lit(1.0).alias("artist_diversity"))
    totals = (df.filter(F.col(label).isNotNull()).groupBy(F.col(label).cast("string").alias("seed_label"))
              .agg(F.count("*").alias("n_label")))
    others = F.col("n_label") - 1
    ideal = F.aggregate(F.sequence(F.lit(1), F.greatest(F.least(others, F.lit(k)), F.lit(1)).cast("int")),
                        F.lit(0.0), lambda s, r: s + 1.0 / F.log2(r + 1.0))
    return lookup_join(per_query, write_and_read(totals, "label-totals"), "seed_label", "inner", ["qid"]).select(
        "qid", "seed_label", "hits", (F.col("hits") / k).alias("precision"),
        (F.col("hits") / F.greatest(others, F.lit(1))).alias("recall"), "average_precision",
        F.when(others > 0, F.col("_dcg") / ideal).otherwise(F.lit(0.0)).alias("ndcg"), "artist_diversity")


def evaluate(df: DataFrame, k: int = 10, sample_size: int = 200, seed: int = 42,
             label: str = "mood_label", features: list[str] | None = None) -> DataFrame:
    """One report row; all metrics 0 when no sampled seed has a label."""
    features = features or evaluation_features(df)
    recs = write_and_read(recommendations(df, k, sample_size, seed, label, features), "recs")
    has_artist = any(c in df.columns for c in ("artists", "artist_names"))
    per_query = query_metrics(df, recs if has_artist else recs.drop("artist"), k, label)
    n_rows = df.agg(F.count("*")).scalar()
    seen = recs.agg(F.count_distinct("id")).scalar()

    def mean(c):
        return F.coalesce(F.avg(c), F.lit(0.0))

    return per_query.agg(
        n_rows.alias("n_rows"), F.lit(label).alias("label_column"), F.lit(len(features)).alias("feature_count"),
        mean("precision").alias("precision_at_k"), mean("recall").alias("recall_at_k"),
        mean("average_precision").alias("map_at_k"), mean("ndcg").alias("ndcg_at_k"),
        (seen / n_rows).alias("catalog_coverage"), mean("artist_diversity").alias("artist_diversity"))
