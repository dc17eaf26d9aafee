"""Batch search: routing of queries to vibe, n-gram or fuzzy search, and what follows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from cadenza.functions.scalars import is_blank, search_text, track_label, vibe_label
from cadenza.functions.text import strip
from cadenza.operators import recommend, tfidf, vibe
from cadenza.operators.clean import column_stats
from cadenza.operators.explain import output_rows
from cadenza.operators.impact import ImpactIndex
from cadenza.operators.joins import fan_out, lookup_join
from cadenza.operators.ordering import top_per_group
from cadenza.operators.vectors import feature_table
from cadenza.schema import FEATURES9, present
from cadenza.session import write_and_read

# Confidence bound and the engine names shown with results.
CONFIDENCE = 0.10
ENGINE_PLAIN, ENGINE_HYBRID, ENGINE_FALLBACK = "FAISS", "two-tower hybrid", "FAISS fallback"
TRAITS = ("energy", "danceability", "valence")
SHOWN = ("name", "artists", "popularity", "energy", "danceability", "valence")


@dataclass
class SearchIndex:
    """Fitted tables of one catalog: item rows with vectors, n-gram statistics, postings in bands."""

    items: DataFrame
    idf: DataFrame
    stats: DataFrame
    features: list[str]
    impact: ImpactIndex


def build_search_index(catalog: DataFrame) -> SearchIndex:
    """``catalog`` has id, name, artists, popularity and audio features. Fitted tables are written once."""
    features = present(catalog, FEATURES9)
    filled = catalog.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    shown = [c for c in SHOWN if c in catalog.columns]
    if "artists" not in catalog.columns and "artist_names" in catalog.columns:
        filled, shown = filled.withColumnRenamed("artist_names", "artists"), list(dict.fromkeys([*shown, "artists"]))
    artists = F.col("artists") if "artists" in filled.columns else None
    kept = filled.select("id", *dict.fromkeys([*shown, *features]), search_text(F.col("name"), artists).alias("text"))
    base = write_and_read(kept, "catalog")
    stats = write_and_read(column_stats(base, features), "feature-stats")
    items = feature_table(base, features, stats, keep=("id", *shown, "text"))
    impact, idf = tfidf.fit_index(base)
    return SearchIndex(items, idf, stats, features, impact)


def search(index: SearchIndex, queries: DataFrame, k: int = 8) -> DataFrame:
    """Results of (qid, text): qid, rank, id, shown columns, _search_score, mode, label.

    Blank queries give no rows. Vibe queries share one result per profile; the others are
    scored by n-grams, and only those whose best score is too low are scored again by
    fuzzy match.
    """
    shown = [c for c in SHOWN if c in index.items.columns]
    asked = queries.select("qid", strip(F.col("text")).alias("text")).filter(~is_blank(F.col("text")))
    asked = write_and_read(vibe.detect_vibe(asked), "asked")

    profiles = vibe.profile_vectors(asked.sparkSession, index.features, index.stats)
    by_vibe = vibe.vibe_results(index.items, profiles, k, carry=tuple(shown))
    # ten profiles times k rows
    felt = asked.filter(F.col("vibe").isNotNull()).join(F.broadcast(by_vibe), "vibe")
    felt = felt.select("qid", "rank", "id", *shown, "_search_score", F.lit("vibe").alias("mode"),
                       vibe_label(F.col("text")).alias("label"))

    typed = asked.filter(F.col("vibe").isNull()).select("qid", "text")
    scored = tfidf.tfidf_top_k(index.items, typed, index.idf, 2 * k, carry=shown, index=index.impact)
    scored = write_and_read(scored, "scored")
    sure = scored.filter((F.col("rank") == 1) & (F.col("score") >= CONFIDENCE)).select("qid")
    by_gram = scored.filter(F.col("rank") <= k).join(sure, "qid", "left_semi").withColumn("mode", F.lit("tfidf"))
    unsure = typed.join(sure, "qid", "left_anti")
    by_fuzz = tfidf.fuzzy_top_k(index.items, unsure, k, carry=shown).withColumn("mode", F.lit("fuzzy"))
    text = by_gram.unionByName(by_fuzz)
    artists = F.col("artists") if "artists" in shown else None
    best = text.filter(F.col("rank") == 1).select("qid", track_label(F.col("name"), artists).alias("label"))
    text = text.join(best, "qid").select(
        "qid", "rank", "id", *shown, F.col("score").alias("_search_score"), "mode", "label")
    return felt.unionByName(text)


def query_modes(queries: DataFrame, results: DataFrame) -> DataFrame:
    """Mode and label per query, with blank queries as mode 'none'."""
    found = results.filter(F.col("rank") == 1).select("qid", "mode", "label")
    return queries.select("qid").join(found, "qid", "left").select(
        "qid", F.coalesce("mode", F.lit("none")).alias("mode"),
        F.when(F.col("mode").isNull(), F.lit("Empty query")).otherwise(F.col("label")).alias("label"))


def search_and_recommend(index: SearchIndex, queries: DataFrame, k: int = 8,
                         items: DataFrame | None = None, found: DataFrame | None = None) -> DataFrame:
    """Vibe rows pass through; a text query's best row becomes the seed of a similarity search.

    Seeds missing from ``items`` keep the search rows. Recommended rows carry no audio features.
    """
    items = index.items if items is None else items
    found = write_and_read(search(index, queries, k) if found is None else found, "found")
    seeds = found.filter((F.col("rank") == 1) & (F.col("mode") != "vibe")).select(
        "qid", F.col("id").alias("seed_id"), "mode", "label")
    recs = recommend.similar_by_features(items, seeds.select(F.col("seed_id").alias("id")), k)
    recommended = fan_out(seeds, recs).withColumn("recommended", F.lit(True))
    traits = [c for c in TRAITS if c in found.columns]
    columns = ["qid", "seed_id", "rank", "id", "name", "artists", "popularity", *traits, "similarity_score",
               "final_score", "_search_score", "mode", "label", "recommended"]
    for c in (*traits, "_search_score"):
        recommended = recommended.withColumn(c, F.lit(None).cast("double"))
    answered = recommended.select("qid").distinct()
    rest = (found.join(answered, "qid", "left_anti")
            .join(seeds.select("qid", "seed_id"), "qid", "left")
            .withColumn("final_score", F.col("_search_score"))
            .withColumn("similarity_score", F.lit(None).cast("double"))
            .withColumn("recommended", F.lit(False)))
    return recommended.select(*columns).unionByName(rest.select(*columns))


def search_service(index: SearchIndex, queries: DataFrame, k: int = 8, hybrid_items: DataFrame | None = None,
                   **weights) -> DataFrame:
    """Search, recommend, and rerank by learned vectors where a seed has one.

    ``engine_name`` tells which way each query went.
    """
    base = write_and_read(search_and_recommend(index, queries, k), "answers")
    plain = base.withColumn("engine_name", F.lit(ENGINE_PLAIN))
    for c in ("sim_score", "pop_score", "diversity_bonus"):
        plain = plain.withColumn(c, F.lit(None).cast("double"))
    if hybrid_items is None:
        return plain
    per_query = base.filter(F.col("seed_id").isNotNull()).select("qid", "seed_id", "label").distinct()
    kept = [c for c in ("name", "popularity", *TRAITS) if c in hybrid_items.columns]
    ranked = recommend.hybrid_by_id(hybrid_items, per_query.select(F.col("seed_id").alias("id")), k, carry=kept, **weights)
    mixed = fan_out(per_query, ranked).withColumns({
        "mode": F.lit("hybrid"), "engine_name": F.lit(ENGINE_HYBRID), "recommended": F.lit(True)})
    for c in plain.columns:
        if c not in mixed.columns:
            mixed = mixed.withColumn(c, F.lit(None).cast(plain.schema[c].dataType))
    answered = mixed.select("qid").distinct()
    rest = plain.join(answered, "qid", "left_anti").withColumn(
        "engine_name", F.when(F.col("seed_id").isNotNull(), F.lit(ENGINE_FALLBACK)).otherwise(F.col("engine_name")))
    return mixed.select(*plain.columns).unionByName(rest)


def display(answers: DataFrame) -> DataFrame:
    """Rows of the search service as shown, with the reasons given for each."""
    return output_rows(answers, F.col("mode"), F.col("engine_name"), keep=("qid", "mode", "label", "engine_name"))


def answered_seeds(index: SearchIndex, answers: DataFrame) -> DataFrame:
    """(qid, seed_id, seed_name, seed_artist) of the queries that were answered by way of a seed."""
    columns = index.items.columns
    named = index.items.select(F.col("id").alias("seed_id"), *[
        (F.col(c) if c in columns else F.lit(None).cast("string")).alias(new)
        for c, new in (("name", "seed_name"), ("artists", "seed_artist"))])
    seeds = answers.filter(F.col("seed_id").isNotNull()).select("qid", "seed_id").distinct()
    return lookup_join(seeds, named, "seed_id", "inner", spread=["qid"])


def recent_searches(history: DataFrame, n: int = 5) -> DataFrame:
    """(user_id, rank, query, ts): the newest n searches per user, each text once ignoring case.

    ``history`` is (user_id, ts, seq, query). A repeated text shrinks to one row before ranking.
    """
    q = strip(F.col("query"))
    given = history.filter(~is_blank(F.col("query")))
    latest = given.groupBy("user_id", F.lower(q).alias("_key")).agg(
        F.max(F.struct("ts", "seq", q.alias("query"))).alias("last"))
    rows = latest.select("user_id", "last.ts", "last.seq", "last.query")
    return top_per_group(rows, ["user_id"], [F.col("ts").desc(), F.col("seq").desc()], n, rank="rank").drop("seq")
