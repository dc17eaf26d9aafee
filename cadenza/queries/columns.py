"""P: projections and choices made from the schema."""

from pyspark.sql import functions as F

from cadenza import schema
from cadenza.operators import explain, genres, ingest
from cadenza.queries.base import (
    ARTISTS, FEATURES, LABELLED, NESTED, R, TRACKS, artists, labelled, nested_entries, query, r6, rounded,
    table, tracks,
)


def _raw_large(spark, sf):
    return tracks(spark, sf).withColumnsRenamed({"id": "track_id", "name": "track_name", "primary_genre": "track_genre"})


@query("p01_keep_listed", "WITH " + TRACKS + f"""SELECT id, name, artists,
 {', '.join(f'{R(c)} AS {c}' for c in FEATURES)} FROM tracks""")
def p01(spark, sf):
    return rounded(schema.keep_listed(tracks(spark, sf)))


@query("p02_rename", "WITH " + TRACKS + f"SELECT id, name, primary_genre AS genres, {R('tempo')} AS tempo FROM tracks")
def p02(spark, sf):
    return rounded(schema.rename_columns(_raw_large(spark, sf)).select("id", "name", "genres", "tempo"))


@query("p03_normalize_schema", """
SELECT CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS VARCHAR) AS id,
       CAST(row_number() OVER (ORDER BY p_partkey) - 1 AS VARCHAR) AS name, p_brand AS artists, p_partkey AS ingest_seq
FROM part""")
def p03(spark, sf):
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("ingest_seq"), F.col("p_brand").alias("artist_names"))
    return schema.normalize_schema(df).select("id", "name", "artists", "ingest_seq")


@query("p04_flatten_tracks", "WITH " + NESTED + """
SELECT playlist_id, track_id, name, array_to_string(artist_ids, '|') AS artist_ids,
  array_to_string(artist_names, '|') AS artist_names, CAST(popularity AS BIGINT) AS popularity, album, release_date FROM flat""")
def p04(spark, sf):
    rows = nested_entries(spark, sf).select("playlist_id", "item.track")
    flat = ingest.flatten_tracks(rows, keep=("playlist_id",))
    return rounded(flat.withColumns({c: F.array_join(c, "|") for c in ("artist_ids", "artist_names")}))


MOOD_OF_PLAYLIST = {"ECONOMY": "sad", "STANDARD": "romantic", "PROMO": "party", "FAVOURITES": "old_melody"}
MOOD_MAP_SQL = "CASE playlist_id " + " ".join(f"WHEN '{p}' THEN '{m}'" for p, m in MOOD_OF_PLAYLIST.items()) + " END"


@query("p05_playlist_mood", "WITH " + NESTED + f"SELECT playlist_id, track_id, {MOOD_MAP_SQL} AS mood_label FROM flat")
def p05(spark, sf):
    rows = nested_entries(spark, sf).select("playlist_id", "item.track")
    flat = ingest.flatten_tracks(rows, keep=("playlist_id",))
    return ingest.label_by_playlist(flat, MOOD_OF_PLAYLIST).select("playlist_id", "track_id", "mood_label")


@query("p06_artist_projection", "WITH " + ARTISTS + "SELECT * FROM artist_cols")
def p06(spark, sf):
    return rounded(ingest.artist_columns(artists(spark, sf)))


@query("p07_fill_text", "WITH " + NESTED + """
SELECT page_no * 100 + pos AS seq, playlist_id, coalesce(name, 'Unknown') AS name, coalesce(album_name, 'Unknown') AS album,
       album_date FROM raw WHERE NOT no_track""")
def p07(spark, sf):
    from cadenza.operators.clean import fill_text
    rows = nested_entries(spark, sf).filter(F.col("item.track").isNotNull()).select(
        (F.col("page_no") * 100 + F.col("pos")).alias("seq"), "playlist_id", "item.track.name",
        F.col("item.track.album.name").alias("album"), F.col("item.track.album.release_date").alias("album_date"))
    return fill_text(rows)


@query("p08_numeric_columns", "SELECT o_custkey, o_totalprice FROM orders")
def p08(spark, sf):
    df = table(spark, sf, "orders")
    return df.select(*schema.numeric_columns(df, exclude=("o_orderkey",)))


@query("p09_evaluation_features", "WITH " + LABELLED + f"""
SELECT id, {', '.join(f'{R(c)} AS {c}' for c in FEATURES)} FROM labelled""")
def p09(spark, sf):
    df = labelled(spark, sf).drop("ingest_seq")
    return rounded(df.select("id", *schema.evaluation_features(df)))


# the catalog's most frequent genres, as the indicator columns are found
TYPES = """entries AS (SELECT trim(unnest(string_split(primary_genre, ';'))) AS genre FROM tracks WHERE primary_genre NOT IN ('', 'Unknown')),
types AS (SELECT genre, 'genre_' || replace(lower(genre), ' ', '_') AS feature, row_number() OVER (ORDER BY n DESC, genre) AS place
  FROM (SELECT genre, count(*) AS n FROM entries GROUP BY genre) QUALIFY place <= 20)"""
HOT = "SELECT id, feature, CAST(contains(primary_genre, lower(genre)) AS DOUBLE) AS value FROM tracks, types"


def one_per_feature(df, columns):
    """(id, feature, value): columns that follow from the data, as rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    return rounded(df.select("id", F.explode(pairs).alias("p")).select("id", "p.*"))


@query("p10_training_features", "WITH " + TRACKS + ", " + TYPES + " " + " UNION ALL ".join(
    f"SELECT id, '{c}' AS feature, {R(c)} AS value FROM tracks" for c in FEATURES) + f"""
UNION ALL {HOT}
UNION ALL SELECT id, 'release_year', CAST(substr(release_date, 1, 4) AS DOUBLE) FROM tracks""")
def p10(spark, sf):
    from cadenza.functions.scalars import release_year
    df = genres.multi_hot(tracks(spark, sf), "primary_genre").withColumn("release_year", release_year(F.col("release_date")))
    return one_per_feature(df, schema.training_features(df))


@query("p11_profile_column", "WITH " + LABELLED + """
SELECT 'mood_label' AS profile_column, mood_label AS profile, count(*) AS n FROM labelled GROUP BY mood_label""")
def p11(spark, sf):
    df = labelled(spark, sf)
    column = schema.choose_profile_column(df)
    return df.groupBy(F.col(column).alias("profile")).agg(F.count("*").alias("n")).withColumn(
        "profile_column", F.lit(column))


BRAND_POP = "brand_pop AS (SELECT artists, CAST(count(*) AS DOUBLE) AS artist_popularity FROM tracks GROUP BY artists)"


def with_artist_popularity(df):
    from cadenza.operators.joins import lookup_join
    return lookup_join(df, df.groupBy("artists").agg(F.count("*").cast("double").alias("artist_popularity")), "artists")


@query("p12_similarity_features", "WITH " + TRACKS + ", " + BRAND_POP + ", " + TYPES + f"""
{HOT}
UNION ALL SELECT id, 'artist_popularity', artist_popularity FROM tracks JOIN brand_pop USING (artists)
UNION ALL SELECT id, 'popularity', {R('popularity')} FROM tracks""")
def p12(spark, sf):
    df = genres.multi_hot(with_artist_popularity(tracks(spark, sf)), "primary_genre").drop("primary_genre", "all_genres")
    return one_per_feature(df, schema.similarity_features(df))


@query("p13_pack_vector", "WITH " + TRACKS + "SELECT id, " + R(" + ".join(
    f"{i + 1} * coalesce({c}, 0e0)" for i, c in enumerate(FEATURES))) + " AS weighted, 9 AS size FROM tracks")
def p13(spark, sf):
    df = tracks(spark, sf).withColumn("vec", schema.feature_vector(FEATURES))
    weighted = F.col("vec")[0] * 1
    for i in range(1, 9):
        weighted = weighted + (i + 1) * F.col("vec")[i]
    return df.select("id", r6(weighted).alias("weighted"), F.size("vec").alias("size"))


@query("p14_output_rows", "WITH " + TRACKS + f"""
SELECT id, row_number() OVER (PARTITION BY artists ORDER BY popularity DESC, id) AS rank, name, artists AS artist,
  {R('popularity')} AS popularity, {R('coalesce(energy, 0)')} AS energy, {R('danceability')} AS danceability,
  {R('coalesce(valence, 0)')} AS valence, {R('coalesce(valence, tempo)')} AS similarity FROM tracks""")
def p14(spark, sf):
    from cadenza.operators.ordering import number_results
    df = number_results(tracks(spark, sf), "artists", [F.col("popularity").desc(), F.col("id")])
    df = df.withColumns({"similarity_score": F.col("valence"), "final_score": F.col("tempo")})
    return rounded(explain.output_rows(df, F.lit("vibe"), F.lit("any")).drop("reasons"))


@query("p15_track_vector", "WITH " + TRACKS + f"""
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, id, {R('tracks.popularity')} AS popularity, {R('tempo')} AS tempo
FROM lineitem LEFT JOIN tracks ON CAST(l_partkey + CASE WHEN l_quantity > 49 THEN 1000000000 ELSE 0 END AS VARCHAR) = id
WHERE id IS NOT NULL""")
def p15(spark, sf):
    """Vectors for a table of requested ids: every order line asks for its part; some ids are unknown."""
    from cadenza.operators.joins import lookup_join
    asked = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        (F.col("l_partkey") + F.when(F.col("l_quantity") > 49, 1000000000).otherwise(0)).cast("string").alias("id"))
    vecs = tracks(spark, sf).select("id", schema.feature_vector(["popularity", "tempo"]).alias("vec"))
    got = lookup_join(asked, vecs, "id", "inner", spread=["l_orderkey", "l_linenumber"])
    return rounded(got.select("l_orderkey", "l_linenumber", "id", F.col("vec")[0].alias("popularity"),
                              F.col("vec")[1].alias("tempo")))
