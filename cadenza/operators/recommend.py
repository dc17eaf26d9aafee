"""Recommenders over tables of seeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from cadenza.functions.scalars import title_case
from cadenza.operators.blocks import Dot, block_top_k, compared
from cadenza.operators.clean import attach_row
from cadenza.operators.joins import fan_out
from cadenza.operators.ordering import keep_first, running, top_per_group, top_rows
from cadenza.operators.vectors import unit
from cadenza.operators.vibe import rescaled
from cadenza.session import write_and_read

# Default score weights.
SIMILAR_WEIGHTS = (0.7, 0.3)
HYBRID_WEIGHTS = {"alpha": 0.70, "beta": 0.20, "gamma": 0.10, "candidate_multiplier": 10}


def seed_vectors(items: DataFrame, seeds: DataFrame | None, exclude: bool = True) -> DataFrame:
    """(qid[, exclude_id], vec) of the seeds found in ``items``; without ``seeds`` every item is one."""
    own = [F.col("id").alias("exclude_id")] if exclude else []
    found = items if seeds is None else items.join(seeds.select("id").distinct(), "id", "left_semi")
    return found.select(F.col("id").alias("qid"), *own, "vec")


def similar_by_features(items: DataFrame, seeds: DataFrame | None, k: int = 10, metric: str = "ip",
                        pop_scale: float = 100.0) -> DataFrame:
    """Nearest k others by inner product, reordered by 0.7 similarity + 0.3 popularity/100.

    ``items`` is (id, name, artists, popularity, vec). Without ``seeds`` every item is one.
    """
    items = items.select("id", "name", "artists", "popularity", "vec")
    if metric == "cosine":
        items = items.withColumn("vec", unit(F.col("vec")))
    items = write_and_read(items, "items")
    near = block_top_k(items, seed_vectors(items, seeds), k, Dot(), carry=("name", "artists", "popularity"), written=True)
    ws, wp = SIMILAR_WEIGHTS
    final = F.col("score") * ws + F.col("popularity") / pop_scale * wp
    scored = near.drop("rank").withColumn("final_score", final).withColumnRenamed("score", "similarity_score")
    return top_per_group(scored, ["qid"], [compared("final_score"), F.col("id")], k, rank="rank")


def with_popularity_prior(df: DataFrame) -> DataFrame:
    """Catalog popularity rescaled to [0, 1]; 0 when the catalog has none."""
    if "popularity" not in df.columns:
        return df.withColumn("pop_norm", F.lit(0.0))
    ends = df.agg(F.min("popularity").alias("lo"), F.max("popularity").alias("hi"))
    s = F.col("_stats")
    return attach_row(df, ends).withColumn(
        "pop_norm", (F.col("popularity") - s["lo"]) / (s["hi"] - s["lo"] + 1e-8)).drop("_stats")


def _hybrid_scores(pool: DataFrame, k: int, alpha: float, beta: float, gamma: float) -> DataFrame:
    """Order by base score; the diversity bonus falls with each earlier row of the same artist."""
    per_query = W.partitionBy("qid")
    base_order = [compared("_base"), F.col("id")]
    sim = rescaled(F.col("score"), per_query)
    scored = pool.withColumn("_sim", sim)
    scored = scored.withColumn("_base", alpha * F.col("_sim") + beta * F.col("pop_norm"))
    artist = F.coalesce(F.col("artists"), F.lit("unknown"))
    earlier = F.row_number().over(W.partitionBy("qid", artist).orderBy(*base_order)) - 1
    scored = scored.withColumn("_bonus", 1.0 / (1.0 + earlier))
    top = top_per_group(scored, ["qid"], base_order, k, rank="rank")
    return top.select(
        *[c for c in top.columns if c not in ("score", "pop_norm", "_sim", "_base", "_bonus")],
        F.bround(F.col("_base") + gamma * F.col("_bonus"), 4).alias("final_score"),
        F.bround("_sim", 4).alias("sim_score"), F.bround("pop_norm", 4).alias("pop_score"),
        F.bround("_bonus", 4).alias("diversity_bonus"))


def hybrid_by_id(items: DataFrame, seeds: DataFrame | None, k: int = 10, alpha: float = 0.70, beta: float = 0.20,
                 gamma: float = 0.10, candidate_multiplier: int = 10, carry=("name",)) -> DataFrame:
    """Similarity + popularity + artist diversity. ``items`` is (id, artists, popularity, vec, carry...)."""
    ready = write_and_read(with_popularity_prior(items), "items")
    n = k * candidate_multiplier + 1
    pool = block_top_k(ready, seed_vectors(ready, seeds, exclude=False), n, Dot(), written=True,
                       carry=tuple(dict.fromkeys(["artists", "pop_norm", *carry])))
    return _hybrid_scores(pool.filter(F.col("id") != F.col("qid")).drop("rank"), k, alpha, beta, gamma)


def hybrid_by_vector(items: DataFrame, queries: DataFrame, k: int = 10, alpha: float = 0.70, beta: float = 0.20,
                     gamma: float = 0.10, candidate_multiplier: int = 10, carry=("name",)) -> DataFrame:
    """The same for arbitrary vectors (qid, vec[, exclude_id]); the excluded item is retrieved, then removed."""
    ready = with_popularity_prior(items)
    excluded = "exclude_id" in queries.columns
    if excluded:
        queries = write_and_read(queries, "asked")
    pool = block_top_k(ready, queries.drop("exclude_id"), k * candidate_multiplier + 1, Dot(),
                       carry=tuple(dict.fromkeys(["artists", "pop_norm", *carry])))
    if excluded:
        unwanted = queries.filter(F.col("exclude_id").isNotNull()).select("qid", F.col("exclude_id").alias("id"))
        pool = pool.join(unwanted, ["qid", "id"], "left_anti")
    return _hybrid_scores(pool.drop("rank"), k, alpha, beta, gamma)


def top_of_each_label(df: DataFrame, label: str = "mood_label", n: int = 5, tie: str = "ingest_seq") -> DataFrame:
    """The n most popular rows of every label."""
    return top_per_group(df.filter(F.col(label).isNotNull()), [label],
                         [F.col("popularity").desc_nulls_last(), F.col(tie)], n, rank="rank")


def top_of_label(df: DataFrame, value: str, label: str = "mood_label", n: int = 5) -> DataFrame:
    return top_rows(df.filter(F.col(label) == value), "popularity", n)


def match_label(df: DataFrame, value: str, label: str = "mood_label") -> DataFrame:
    """Rows whose label equals the value ignoring case; only when there are none, rows that contain it."""
    low, wanted = F.lower(F.col(label)), value.lower()
    any_equal = df.agg(F.coalesce(F.max(low == wanted), F.lit(False))).scalar()
    return df.filter(F.when(any_equal, low == wanted).otherwise(low.contains(wanted)))


def mood_request(df: DataFrame, mood: str, n: int = 10) -> DataFrame:
    """Most popular rows of a mood; of the whole catalog when it has no mood column."""
    label = next((c for c in ("mood_label", "primary_mood") if c in df.columns), None)
    if label is None:
        rows, shown = df, F.lit("Popular Tracks (Mood Column Missing)")
    else:
        rows, shown = match_label(df, mood, label), title_case(F.lit(mood))
    return top_rows(rows, "popularity", n).withColumn("mood", shown)


def seeds_by_name(df: DataFrame, names: DataFrame) -> DataFrame:
    """First row, in table order, for each requested name (ignoring case): (query_name, id)."""
    first = keep_first(df.select("id", "ingest_seq", F.lower("name").alias("_name")), "_name")
    wanted = names.select(F.col("name").alias("query_name"), F.lower("name").alias("_name")).distinct()
    return wanted.join(first, "_name").select("query_name", "id")


def similar_by_name(items: DataFrame, df: DataFrame, names: DataFrame, k: int = 5, carry=("name",)) -> DataFrame:
    """Cosine-nearest rows for requested names. ``items`` is (id, vec, carry...).

    Names that share their first row share one search.
    """
    seeds = seeds_by_name(df, names)
    units = write_and_read(items.withColumn("vec", unit(F.col("vec"))), "items")
    near = block_top_k(units, seed_vectors(units, seeds), k, Dot(), carry=tuple(carry), written=True)
    shared = fan_out(seeds.withColumnRenamed("id", "seed_id"), near)
    return shared.withColumnRenamed("score", "similarity")


def name_contains(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.lower("name").contains(text.lower()))


def name_equals(df: DataFrame, text: str) -> DataFrame:
    return df.filter(F.lower("name") == text.lower())


def with_artist_run(df: DataFrame, query: str, artist: str, order: list) -> DataFrame:
    """``earlier``: how many earlier rows of the same query have the same artist."""
    return running(df, [query, artist], order, rank="earlier").withColumn("earlier", F.col("earlier") - 1)
