"""Registered queries: input views over the given tables, and the registry itself.

Each view exists twice, as a DataFrame and as SQL text, so that a query and its check
start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cadenza.schema import FEATURES9 as FEATURES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(x) -> Column:
    """Rounded for output; adding 0 turns -0.0 into 0.0."""
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x.cast("double"), 6) + F.lit(0.0)


def big(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("bigint")


def rounded(df: DataFrame) -> DataFrame:
    """All double columns rounded for output, all integer columns as BIGINT."""
    cols = []
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            cols.append(r6(f.name).alias(f.name))
        elif kind in ("int", "bigint", "smallint", "tinyint"):
            cols.append(big(f.name).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def R(x: str) -> str:
    """SQL counterpart of r6."""
    return f"(round(CAST({x} AS DOUBLE), 6) + 0e0)"


# ---- tracks: one row per part, features from its first line ------------------------------

TRACKS = """
first_lines AS (
  SELECT l_partkey, l_quantity, l_discount, l_tax, l_orderkey,
         count(*) OVER (PARTITION BY l_partkey) AS n_lines,
         row_number() OVER (PARTITION BY l_partkey
             ORDER BY l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
                      l_quantity, l_discount, l_tax) AS rn
  FROM lineitem),
tracks AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id,
         p_partkey AS ingest_seq,
         p_name AS name,
         p_brand AS artists,
         lower(p_type) AS primary_genre,
         lower(p_type) || '; ' || replace(p_name, ' ', '; ') AS all_genres,
         CAST(1960 + p_partkey % 70 AS VARCHAR) || '-06-15' AS release_date,
         CAST(n_lines AS DOUBLE) AS popularity,
         CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE l_quantity / 50e0 END AS energy,
         CASE WHEN p_partkey % 19 = 0 THEN NULL ELSE round(l_discount * 10e0, 6) END AS valence,
         round(l_tax * 12.5e0, 6) AS danceability,
         60e0 + p_size * 2.4e0 AS tempo,
         (l_orderkey % 101) / 100e0 AS acousticness,
         (l_orderkey % 53) / 52e0 AS speechiness,
         (l_orderkey % 37) / 36e0 AS instrumentalness,
         (l_orderkey % 29) / 28e0 AS liveness
  FROM part JOIN first_lines ON p_partkey = l_partkey AND rn = 1)"""


def tracks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smallest line per part is an aggregate, so a part with very many lines is combined map-side."""
    key = ["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_partkey")
             .agg(F.count("*").alias("n_lines"), F.min(F.struct(*key)).alias("f")))
    p, order = F.col("p_partkey"), F.col("f.l_orderkey")
    joined = table(spark, sf_dir, "part").join(lines, p == F.col("l_partkey"))
    return joined.select(
        p.cast("string").alias("id"), p.alias("ingest_seq"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("artists"), F.lower("p_type").alias("primary_genre"),
        F.concat(F.lower("p_type"), F.lit("; "), F.replace("p_name", F.lit(" "), F.lit("; "))).alias("all_genres"),
        F.concat((1960 + p % 70).cast("string"), F.lit("-06-15")).alias("release_date"),
        F.col("n_lines").cast("double").alias("popularity"),
        F.when(p % 17 != 0, F.col("f.l_quantity") / 50.0).alias("energy"),
        F.when(p % 19 != 0, F.round(F.col("f.l_discount") * 10.0, 6)).alias("valence"),
        F.round(F.col("f.l_tax") * 12.5, 6).alias("danceability"),
        (60.0 + F.col("p_size") * 2.4).alias("tempo"),
        ((order % 101) / 100.0).alias("acousticness"), ((order % 53) / 52.0).alias("speechiness"),
        ((order % 37) / 36.0).alias("instrumentalness"), ((order % 29) / 28.0).alias("liveness"))


MOOD_CASE = """CASE
  WHEN energy > 0.7e0 AND danceability > 0.7e0 AND tempo > 110 THEN 'party'
  WHEN valence < 0.35e0 AND acousticness > 0.5e0 THEN 'sad'
  WHEN valence >= 0.4e0 AND valence <= 0.7e0 AND acousticness > 0.4e0 AND tempo < 100 THEN 'romantic'
  WHEN energy < 0.5e0 AND valence > 0.5e0 AND danceability < 0.6e0 AND tempo < 120 THEN 'chill'
  WHEN TRY_CAST(string_split(release_date, '-')[1] AS INTEGER) <> 0
       AND TRY_CAST(string_split(release_date, '-')[1] AS INTEGER) < 1995 THEN 'old_melody'
  WHEN lower(all_genres) LIKE '%oldies%' OR lower(all_genres) LIKE '%classic%'
       OR lower(all_genres) LIKE '%vintage%' OR lower(all_genres) LIKE '%retro%' THEN 'old_melody'
  ELSE 'neutral' END"""

LABELLED = TRACKS + f""",
labelled AS (SELECT *, {MOOD_CASE} AS mood_label FROM tracks)"""


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cadenza.functions.scalars import mood_rule
    df = tracks(spark, sf_dir)
    return df.withColumn("mood_label", mood_rule(df.columns))


# tracks with missing features as 0, and their statistics
FILLED = TRACKS + """,
filled AS (SELECT id, name, artists, """ + ", ".join(f"coalesce({c}, 0e0) AS {c}" for c in FEATURES) + """ FROM tracks),
st AS (SELECT """ + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) + 1e-8 AS s_{c}" for c in FEATURES) + """ FROM filled),
items AS (SELECT id, name, artists, popularity, energy, danceability, valence,
  [""" + ", ".join(f"({c} - m_{c}) / s_{c}" for c in FEATURES) + """] AS vec FROM filled, st)"""


def feature_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, name, artists, popularity, vec): population z-scores of the nine features."""
    from cadenza.operators.vectors import feature_table
    df = tracks(spark, sf_dir)
    return feature_table(df, FEATURES, keep=("id", "name", "artists", "popularity"))


# ---- learned vectors: the embeddings table joined to tracks ----------------------------------

LEARNED = TRACKS + """,
learned AS (
  SELECT id, name, artists, popularity, label, CAST(embedding AS DOUBLE[]) AS vec
  FROM tracks JOIN embeddings ON vec_id = ingest_seq)"""


def learned(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("ingest_seq"), F.col("embedding").cast("array<double>").alias("vec"), "label")
    return tracks(spark, sf_dir).join(e, "ingest_seq").select("id", "name", "artists", "popularity", "label", "vec")


# ---- repeated rows: every track, and the long ones once more at a later position ------------

REPEATED = TRACKS + """,
repeated AS (
  SELECT * FROM tracks
  UNION ALL
  SELECT * REPLACE (ingest_seq + 1000000000 AS ingest_seq, name || ' again' AS name)
  FROM tracks WHERE tempo > 150)"""


def repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = tracks(spark, sf_dir)
    later = df.filter(F.col("tempo") > 150).withColumns({
        "ingest_seq": F.col("ingest_seq") + 1000000000, "name": F.concat("name", F.lit(" again"))})
    return df.unionByName(later)


# ---- nested source records -----------------------------------------------------------------

# playlist entries as nested records with the usual gaps: no track, no id, empty id, no artists,
# an artist without id, no album
NESTED = """
entries AS (
  SELECT p_type AS playlist_id, CAST(p_partkey // 100 AS INTEGER) AS page_no, CAST(p_partkey % 100 AS INTEGER) AS pos, *
  FROM part
  UNION ALL
  SELECT 'FAVOURITES', CAST(p_partkey // 100 AS INTEGER), CAST(p_partkey % 100 AS INTEGER), *
  FROM part WHERE p_size < 20),
raw AS (
  SELECT playlist_id, page_no, pos, p_size = 50 AS no_track,
    CASE WHEN p_size = 49 THEN NULL WHEN p_size = 48 THEN '' ELSE CAST(p_partkey AS VARCHAR) END AS id,
    CASE WHEN p_size = 44 THEN NULL ELSE p_name END AS name,
    CASE WHEN p_size = 43 THEN NULL ELSE p_size END AS popularity,
    p_brand AS brand, p_type AS ptype, p_size,
    CASE WHEN p_size = 45 THEN NULL ELSE p_name || ' LP' END AS album_name,
    CASE WHEN p_size = 45 THEN NULL ELSE CAST(1960 + p_partkey % 70 AS VARCHAR) || '-06-15' END AS album_date
  FROM entries),
flat AS (
  SELECT playlist_id, page_no, pos, id AS track_id, coalesce(name, '') AS name,
    CASE WHEN p_size = 47 THEN [] WHEN p_size = 46 THEN [ptype] ELSE [brand, ptype] END AS artist_ids,
    CASE WHEN p_size = 47 THEN [] ELSE [brand, 'The ' || ptype] END AS artist_names,
    coalesce(popularity, 0) AS popularity, coalesce(album_name, '') AS album,
    coalesce(album_date, '') AS release_date
  FROM raw WHERE NOT no_track AND id IS NOT NULL AND id <> '')"""


def nested_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(playlist_id, page_no, pos, item) with ``item.track`` nested as the source delivers it."""
    part = table(spark, sf_dir, "part")
    p = F.col("p_partkey")
    size = F.col("p_size")
    place = [F.floor(p / 100).cast("int").alias("page_no"), (p % 100).cast("int").alias("pos")]
    artists = F.when(size == 47, F.array().cast("array<struct<id:string,name:string>>")).otherwise(F.array(
        F.struct(F.when(size != 46, F.col("p_brand")).alias("id"), F.col("p_brand").alias("name")),
        F.struct(F.col("p_type").alias("id"), F.concat(F.lit("The "), "p_type").alias("name"))))
    album = F.when(size != 45, F.struct(
        F.concat("p_name", F.lit(" LP")).alias("name"),
        F.concat((1960 + p % 70).cast("string"), F.lit("-06-15")).alias("release_date")))
    track = F.when(size != 50, F.struct(
        F.when(size == 49, F.lit(None)).when(size == 48, F.lit("")).otherwise(p.cast("string")).alias("id"),
        F.when(size != 44, F.col("p_name")).alias("name"),
        F.when(size != 43, size).alias("popularity"), artists.alias("artists"), album.alias("album")))
    item = F.struct(track.alias("track")).alias("item")
    own = part.select(F.col("p_type").alias("playlist_id"), *place, item)
    liked = part.filter(size < 20).select(F.lit("FAVOURITES").alias("playlist_id"), *place, item)
    return own.unionByName(liked)


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as pages: at most 100 entries per page, as the source's page size sets it."""
    entries = nested_entries(spark, sf_dir)
    pages = entries.groupBy("playlist_id", "page_no").agg(
        F.sort_array(F.collect_list(F.struct("pos", "item"))).alias("e"))
    return pages.select("playlist_id", "page_no", F.transform("e", lambda x: x["item"]).alias("items"))


AUDIO = TRACKS + """,
audio AS (
  SELECT CASE WHEN tempo > 175 THEN NULL ELSE id END AS id, danceability, energy, valence, tempo,
         speechiness, acousticness, instrumentalness, liveness FROM tracks)"""


def audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature records; some have lost their id."""
    return tracks(spark, sf_dir).select(
        F.when(~(F.col("tempo") > 175), F.col("id")).alias("id"),
        *[c for c in FEATURES if c != "popularity"])


ARTISTS = """
artists_raw AS (
  SELECT p_brand AS id, list_sort(list(DISTINCT lower(p_type))) AS genres,
         sum(p_size) AS total, count(*) AS popularity FROM part GROUP BY p_brand
  UNION ALL
  SELECT p_type, [], NULL, count(*) FROM part WHERE p_type <> 'PROMO' GROUP BY p_type),
artist_cols AS (
  SELECT id AS artist_id, coalesce(genres[1], '') AS primary_genre, array_to_string(genres, '; ') AS all_genres,
         CAST(coalesce(total, 0) AS BIGINT) AS artist_followers, CAST(coalesce(popularity, 0) AS BIGINT) AS artist_popularity
  FROM artists_raw)"""


def artists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist records: brands with genres, types without; one type has no record."""
    part = table(spark, sf_dir, "part")
    brands = part.groupBy(F.col("p_brand").alias("id")).agg(
        F.sort_array(F.collect_set(F.lower("p_type"))).alias("genres"),
        F.struct(F.sum("p_size").alias("total")).alias("followers"), F.count("*").alias("popularity"))
    types = part.filter(F.col("p_type") != "PROMO").groupBy(F.col("p_type").alias("id")).agg(
        F.array().cast("array<string>").alias("genres"),
        F.lit(None).cast("struct<total:bigint>").alias("followers"), F.count("*").alias("popularity"))
    return brands.unionByName(types)


# ---- query texts -------------------------------------------------------------------------

# The preset phrases and edge cases of the search tests.
PHRASES = [
    "chill night drive", "gym workout", "sad heartbreak", "party banger", "study focus",
    "romantic dinner", "happy feel good", "sleep meditation", "motivation hustle",
    "acoustic unplugged", "slow dance", "good vibes", "relax deep", "chil", "zq jx",
]

# every distinct name of the catalog, alone and with its most popular artist's name, plus the phrases
SEARCHES = TRACKS + """,
searches AS (
  SELECT 'name: ' || name AS qid, name AS text FROM (SELECT DISTINCT name FROM tracks)
  UNION ALL
  SELECT 'by: ' || name, name || ' ' || artists FROM (SELECT name, max(artists) AS artists FROM tracks GROUP BY name)
  UNION ALL
  SELECT 'phrase: ' || column0, column0 FROM (VALUES """ + ", ".join(f"('{p}')" for p in PHRASES) + """) AS t(column0)
  UNION ALL SELECT 'blank', '   ' UNION ALL SELECT 'tab', chr(9) UNION ALL SELECT 'lines', chr(10) || ' ' || chr(13) || chr(10)
  UNION ALL SELECT 'spaced phrase', chr(9) || 'chill night drive' || chr(10))"""

# SQL text without white space at both ends
BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def stripped(text: str) -> str:
    return f"trim({text}, {BLANKS})"


def searches(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = tracks(spark, sf_dir).groupBy("name").agg(F.max("artists").alias("artists"))
    alone = names.select(F.concat(F.lit("name: "), "name").alias("qid"), F.col("name").alias("text"))
    both = names.select(F.concat(F.lit("by: "), "name").alias("qid"),
                        F.concat_ws(" ", "name", "artists").alias("text"))
    odd = [("blank", "   "), ("tab", "\t"), ("lines", "\n \r\n"), ("spaced phrase", "\tchill night drive\n")]
    # literals of the plan, as rows handed over from Python start Python workers on every executor
    fixed = [F.struct(F.lit(qid).alias("qid"), F.lit(text).alias("text")) for qid, text in [(f"phrase: {p}", p) for p in PHRASES] + odd]
    phrases = spark.range(1).select(F.inline(F.array(*fixed)))
    return alone.unionByName(both).unionByName(phrases)
