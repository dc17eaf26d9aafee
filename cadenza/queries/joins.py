"""J: joins."""

from pyspark.sql import functions as F

from cadenza.functions.text import strip
from cadenza.operators.keywords import first_keyword
from cadenza.operators import ingest, joins, tfidf, vibe
from cadenza.operators.blocks import Dot, block_top_k
from cadenza.operators.ordering import keep_first
from cadenza.queries.base import (
    ARTISTS, AUDIO, FILLED, LABELLED, NESTED, R, SEARCHES, TRACKS, artists, audio, feature_items, labelled,
    nested_entries, query, rounded, searches, stripped, table, tracks,
)

AUDIO8 = ["danceability", "energy", "valence", "tempo", "speechiness", "acousticness", "instrumentalness", "liveness"]


def _flat(spark, sf):
    rows = nested_entries(spark, sf).select("playlist_id", "item.track")
    return ingest.flatten_tracks(rows, keep=("playlist_id",))


@query("j01_join_audio", "WITH " + NESTED + ", " + AUDIO + f"""
SELECT playlist_id, track_id, flat.name, {', '.join(f'{R("audio." + c)} AS {c}' for c in AUDIO8)}
FROM flat LEFT JOIN audio ON track_id = audio.id AND audio.id <> ''""")
def j01(spark, sf):
    got = ingest.join_audio(_flat(spark, sf), audio(spark, sf))
    return rounded(got.select("playlist_id", "track_id", "name", *AUDIO8))


@query("j02_join_artists", "WITH " + NESTED + ", " + ARTISTS + """,
own AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY playlist_id, page_no, pos) AS rn FROM flat) WHERE rn = 1),
ex AS (SELECT track_id, unnest(artist_ids) AS artist_id, generate_subscripts(artist_ids, 1) AS pos FROM own),
j AS (SELECT ex.*, primary_genre, all_genres, artist_followers, artist_popularity FROM ex LEFT JOIN artist_cols USING (artist_id)),
g AS (SELECT track_id, max(artist_followers) AS artist_followers, max(artist_popularity) AS artist_popularity,
        arg_min(primary_genre, pos) FILTER (primary_genre IS NOT NULL) AS primary_genre,
        list(all_genres ORDER BY pos) FILTER (all_genres IS NOT NULL) AS texts FROM j GROUP BY track_id)
SELECT own.track_id, name, CAST(popularity AS BIGINT) AS popularity, album, coalesce(primary_genre, '') AS primary_genre,
  CASE WHEN texts IS NULL THEN '' WHEN len(texts) = 2 AND texts[1] <> texts[2] THEN texts[1] || '; ' || texts[2] ELSE texts[1] END AS all_genres,
  artist_followers, artist_popularity
FROM own LEFT JOIN g USING (track_id)""")
def j02(spark, sf):
    own = keep_first(_flat(spark, sf), "track_id", "playlist_id").drop("playlist_id")
    got = ingest.join_artists(own, artists(spark, sf))
    return rounded(got.select("track_id", "name", "popularity", "album", "primary_genre", "all_genres",
                              "artist_followers", "artist_popularity"))


@query("j03_known_unknown_seeds", """
SELECT vec_id * 3 AS seed, vec_id * 3 IN (SELECT p_partkey FROM part) AS known FROM embeddings""")
def j03(spark, sf):
    seeds = table(spark, sf, "embeddings").select((F.col("vec_id") * 3).alias("seed"))
    catalog = table(spark, sf, "part").select(F.col("p_partkey").alias("seed"))
    known, unknown = joins.known_rows(seeds, catalog, "seed")
    return known.withColumn("known", F.lit(True)).unionByName(unknown.withColumn("known", F.lit(False)))


KEYWORD_ROWS = "keywords AS (SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{w}', '{v}')" for i, (w, v) in enumerate(vibe.KEYWORDS)) + ") AS k(pos, word, vibe))"


@query("j04_query_contains_keyword", "WITH " + SEARCHES + ", " + KEYWORD_ROWS + """
SELECT qid, arg_min(vibe, pos) AS vibe FROM searches LEFT JOIN keywords ON contains(lower(""" + stripped("text") + """), word) GROUP BY qid""")
def j04(spark, sf):
    return searches(spark, sf).select("qid", vibe.exact_vibe(F.lower(strip(F.col("text")))).alias("vibe"))


@query("j04_documents_contain_keyword", "WITH " + KEYWORD_ROWS + """
SELECT vibe, count(*) AS n FROM (
  SELECT doc_id, arg_min(vibe, pos) AS vibe FROM documents LEFT JOIN keywords ON contains(lower(text), word) GROUP BY doc_id)
GROUP BY vibe""")
def j04_documents(spark, sf):
    texts = table(spark, sf, "documents").select(F.lower("text").alias("text"))
    found = first_keyword(texts, vibe.keyword_table(spark))
    return found.groupBy(F.col("profile").alias("vibe")).agg(F.count("*").alias("n"))


@query("j04_first_of_many_keywords", """WITH words AS (
  SELECT min(p_partkey) AS pos, substr(p_name, CAST(1 + p_partkey % 8 AS BIGINT), CAST(2 + p_partkey % 3 AS BIGINT)) AS keyword FROM part GROUP BY ALL),
once AS (SELECT min(pos) AS pos, keyword FROM words WHERE keyword <> '' GROUP BY keyword),
first AS (SELECT doc_id, min(pos) AS pos FROM documents LEFT JOIN once ON contains(lower(text), keyword) GROUP BY doc_id)
SELECT doc_id, f.pos, keyword, p_brand AS profile FROM first f LEFT JOIN once USING (pos) LEFT JOIN part ON p_partkey = f.pos""")
def j04_many(spark, sf):
    """Keywords cut from all part names, looked up in all documents in one pass."""
    part = table(spark, sf, "part")
    place = F.expr("substring(p_name, cast(1 + p_partkey % 8 as int), cast(2 + p_partkey % 3 as int))")
    keywords = part.select(F.col("p_partkey").alias("pos"), place.alias("keyword"), F.col("p_brand").alias("profile"))
    return first_keyword(table(spark, sf, "documents").select("doc_id", F.lower("text").alias("text")), keywords)


@query("j05_best_of_all_pairs", "WITH " + FILLED + f"""
SELECT q.id AS qid, {R('max(round(list_inner_product(q.vec, i.vec), 9))')} AS best FROM items q, items i GROUP BY q.id""")
def j05(spark, sf):
    """Every row scored against every row; only the best score per query leaves a task."""
    items = feature_items(spark, sf)
    best = block_top_k(items, items.withColumnRenamed("id", "qid"), 1, Dot())
    return rounded(best.select("qid", F.col("score").alias("best")))


@query("j06_gather_by_id", "WITH " + TRACKS + f"""
SELECT event_id, {R('value')} AS score, id, name, artists FROM events JOIN tracks ON CAST(user_id AS VARCHAR) = id""")
def j06(spark, sf):
    """Scored result ids joined back to their rows; the score column stays with the result."""
    results = table(spark, sf, "events").select(
        "event_id", F.col("value").alias("score"), F.col("user_id").cast("string").alias("id"))
    rows = tracks(spark, sf).select("id", "name", "artists")
    return rounded(joins.lookup_join(results, rows, "id", "inner", spread=["event_id"]))


@query("j07_labels_after_null_filter", "WITH " + LABELLED + "SELECT id, mood_label FROM labelled WHERE energy IS NOT NULL AND valence IS NOT NULL")
def j07(spark, sf):
    return labelled(spark, sf).dropna(subset=["energy", "valence"]).select("id", "mood_label")


def _gram_stats_sql():
    from cadenza.queries.text import CORPUS, fit_sql, grams_sql
    return "WITH " + SEARCHES + ", " + CORPUS + ", " + fit_sql() + ", " + grams_sql("qg", "searches", "qid", "text") + f"""
SELECT k AS qid, count(*) AS n_grams, count(idf) AS n_known, CAST(coalesce(sum(df), 0) AS BIGINT) AS postings,
  {R('sum((1 + ln(tf)) * idf)')} AS raw_weight FROM qg LEFT JOIN idf USING (gram) GROUP BY k"""


@query("j08_query_gram_stats", _gram_stats_sql())
def j08(spark, sf):
    from cadenza.functions.scalars import search_text
    texts = tracks(spark, sf).select("id", search_text(F.col("name"), F.col("artists")).alias("text"))
    return rounded(tfidf.query_gram_stats(searches(spark, sf), tfidf.fit_idf(texts)))


@query("j08_salted_lookup", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, p_name, p_brand FROM lineitem LEFT JOIN part ON l_partkey = p_partkey""")
def j08_salted(spark, sf):
    """The salted form of a lookup join, with a threshold low enough that many keys are split."""
    lines = table(spark, sf, "lineitem").select(F.col("l_partkey").alias("p_partkey"), "l_orderkey", "l_linenumber")
    part = table(spark, sf, "part").select("p_partkey", "p_name", "p_brand")
    got = joins.salted_join(lines, part, "p_partkey", "left", ["l_orderkey", "l_linenumber"], rows_per_salt=20)
    return rounded(got.drop("p_partkey"))
