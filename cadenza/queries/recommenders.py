"""R: recommenders, with the whole catalog as seeds."""

from pyspark.sql import functions as F

from cadenza.operators import genres, recommend as rec
from cadenza.operators.ordering import number_results
from cadenza.operators import explain
from cadenza.queries.base import (
    FILLED, LABELLED, LEARNED, R, TRACKS, feature_items, labelled, learned, query, rounded, tracks,
)
from cadenza.queries.columns import BRAND_POP, TYPES, with_artist_popularity
from cadenza.queries.text import hybrid_sql
from cadenza.queries.vectors import COS, IP
from cadenza.schema import feature_vector, similarity_features


def similar_sql(score, source="items", k=10):
    return f"""near AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(sim, 9) DESC, id) AS r FROM (
  SELECT q.id AS qid, i.id, i.name, i.artists, i.popularity, CAST({score} AS DOUBLE) AS sim FROM {source} q JOIN {source} i ON q.id <> i.id)) WHERE r <= {k}),
final AS (SELECT *, sim * 0.7e0 + popularity / 100e0 * 0.3e0 AS fs FROM near)
SELECT qid, id, name, artists, {R('popularity')} AS popularity, {R('sim')} AS similarity_score, {R('fs')} AS final_score,
  row_number() OVER (PARTITION BY qid ORDER BY round(fs, 9) DESC, id) AS rank FROM final"""


@query("r01_similar_by_features", "WITH " + FILLED + ", " + similar_sql(IP))
def r01(spark, sf):
    items = feature_items(spark, sf)
    return rounded(rec.similar_by_features(items, None, 10))


@query("r01_similar_by_features_cosine", "WITH " + FILLED + ", " + similar_sql(COS, k=5))
def r01_cosine(spark, sf):
    items = feature_items(spark, sf)
    return rounded(rec.similar_by_features(items, None, 5, metric="cosine"))


HYBRID_OUT = f"""SELECT qid, id, rank, {R('final_score')} AS final_score, {R('sim_score')} AS sim_score,
 {R('pop_score')} AS pop_score, {R('diversity_bonus')} AS diversity_bonus FROM hybrid"""
HYBRID_COLUMNS = ["qid", "id", "rank", "final_score", "sim_score", "pop_score", "diversity_bonus"]


@query("r02_hybrid_by_id", "WITH " + LEARNED + ", " + hybrid_sql("learned", "learned", 10) + HYBRID_OUT)
def r02(spark, sf):
    items = learned(spark, sf)
    return rounded(rec.hybrid_by_id(items, None, 10).select(*HYBRID_COLUMNS))


@query("r02_hybrid_weights", "WITH " + LEARNED + ", " + hybrid_sql("learned", "learned", 5, "0.5e0", "0.3e0", "0.2e0") + HYBRID_OUT)
def r02_weights(spark, sf):
    items = learned(spark, sf)
    return rounded(rec.hybrid_by_id(items, None, 5, 0.5, 0.3, 0.2).select(*HYBRID_COLUMNS))


@query("r03_hybrid_by_vector", "WITH " + LEARNED + ", asked AS (SELECT 'q' || id AS id, list_reverse(vec) AS vec FROM learned), "
       + hybrid_sql("learned", "asked", 5, own="'q' || id") + HYBRID_OUT)
def r03(spark, sf):
    items = learned(spark, sf)
    asked = items.select(F.concat(F.lit("q"), "id").alias("qid"), F.col("id").alias("exclude_id"), F.reverse("vec").alias("vec"))
    return rounded(rec.hybrid_by_vector(items, asked, 5).select(*HYBRID_COLUMNS))


@query("r04_top_by_mood", "WITH " + LABELLED + f"""
SELECT mood_label, rank, id, name, artists, primary_genre, {R('popularity')} AS popularity FROM (
  SELECT *, row_number() OVER (PARTITION BY mood_label ORDER BY popularity DESC, ingest_seq) AS rank FROM labelled) WHERE rank <= 5""")
def r04(spark, sf):
    top = rec.top_of_each_label(labelled(spark, sf))
    return rounded(top.select("mood_label", "rank", "id", "name", "artists", "primary_genre", "popularity"))


@query("r04_top_of_one_mood", "WITH " + LABELLED + f"SELECT id, name, {R('popularity')} AS popularity FROM labelled WHERE mood_label = 'party' ORDER BY popularity DESC, ingest_seq LIMIT 5")
def r04_one(spark, sf):
    return rounded(rec.top_of_label(labelled(spark, sf), "party").select("id", "name", "popularity"))


@query("r05_mood_request", "WITH " + LABELLED + f"""
SELECT 'Old_Melody' AS mood, id, artists, {R('popularity')} AS popularity FROM labelled WHERE mood_label = 'old_melody'
ORDER BY labelled.popularity DESC, ingest_seq LIMIT 10""")
def r05(spark, sf):
    got = rec.mood_request(labelled(spark, sf), "OLD_melody")
    return rounded(got.select("mood", "id", "artists", "popularity"))


@query("r05_mood_request_fallback", "WITH " + TRACKS + f"""
SELECT 'Popular Tracks (Mood Column Missing)' AS mood, id, artists, {R('popularity')} AS popularity FROM tracks
ORDER BY tracks.popularity DESC, ingest_seq LIMIT 10""")
def r05_fallback(spark, sf):
    return rounded(rec.mood_request(tracks(spark, sf), "sad").select("mood", "id", "artists", "popularity"))


@query("r05_mood_output_rows", "WITH " + LABELLED + f"""
SELECT row_number() OVER (ORDER BY popularity DESC, ingest_seq) AS rank, id, name, artists AS artist, {R('popularity')} AS popularity,
  {R('coalesce(energy, 0)')} AS energy, {R('danceability')} AS danceability, {R('coalesce(valence, 0)')} AS valence, 0e0 AS similarity
FROM labelled WHERE mood_label = 'chill' ORDER BY labelled.popularity DESC, ingest_seq LIMIT 10""")
def r05_rows(spark, sf):
    got = rec.mood_request(labelled(spark, sf), "Chill")
    ranked = number_results(got, "mood", [F.col("popularity").desc(), F.col("ingest_seq")])
    return rounded(explain.output_rows(ranked, F.lit("vibe"), F.lit("Mood Popularity")).drop("reasons"))


@query("r06_similar_by_name", "WITH " + TRACKS + ", " + BRAND_POP + ", " + TYPES + f""",
hot AS (SELECT id, list(CAST(contains(primary_genre, lower(genre)) AS DOUBLE) ORDER BY place) AS flags FROM tracks, types GROUP BY id),
items AS (SELECT id, ingest_seq, name, list_concat(flags, [artist_popularity, popularity]) AS vec
  FROM tracks JOIN brand_pop USING (artists) JOIN hot USING (id)),
seeds AS (SELECT lower(name) AS query_name, arg_min(id, ingest_seq) AS qid FROM tracks GROUP BY 1),
scored AS (SELECT query_name, q.id AS seed_id, i.id, i.name, {COS} AS sim FROM seeds s JOIN items q ON q.id = s.qid JOIN items i ON i.id <> q.id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_name ORDER BY round(sim, 9) DESC, id) AS rank FROM scored)
SELECT query_name, seed_id, id, name, {R('sim')} AS similarity, rank FROM ranked WHERE rank <= 10""")
def r06(spark, sf):
    df = with_artist_popularity(tracks(spark, sf))
    hot = genres.multi_hot(df, "primary_genre").drop("primary_genre", "all_genres")
    items = hot.select("id", "name", feature_vector(similarity_features(hot)).alias("vec"))
    names = df.select(F.lower("name").alias("name"))
    return rounded(rec.similar_by_name(items, df, names, 10))
