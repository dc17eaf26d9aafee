"""S: readers and writers, each as a round trip through the shared folder."""

from pyspark.sql import functions as F

from cadenza.operators import evaluate as ev, profile
from cadenza.operators.clean import stats_by_feature
from cadenza.plans.catalog import build_vector_tables
from cadenza.queries.base import (
    FEATURES, FILLED, NESTED, R, TRACKS, labelled, nested_pages, query, rounded, table, tracks,
)
from cadenza.queries.vectors import elements
from cadenza.session import scratch_path
from cadenza.sources import readers, writers

LISTED = ["id", "name", "artists", "primary_genre", "release_date", "popularity", "energy", "valence", "tempo"]
LISTED_SQL = "WITH " + TRACKS + "SELECT id, name, artists, primary_genre, release_date, " + ", ".join(
    f"{R(c)} AS {c}" for c in LISTED[5:]) + " FROM tracks"


def _trip(spark, df, write, read, suffix=""):
    path = scratch_path(spark, "trip") + suffix
    write(df, path)
    return read(path)


@query("s01_csv_scan", LISTED_SQL)
def s01(spark, sf):
    df = tracks(spark, sf).select(*LISTED)
    return rounded(_trip(spark, df, writers.write_csv, lambda p: readers.read_csv(spark, p, df.schema)))


@query("s01_csv_scan_inferred", "WITH " + TRACKS + f"SELECT CAST(id AS BIGINT) AS id, name, {R('tempo')} AS tempo FROM tracks")
def s01_inferred(spark, sf):
    df = tracks(spark, sf).select("id", "name", "tempo")
    return rounded(_trip(spark, df, writers.write_csv, lambda p: readers.read_csv(spark, p)))


@query("s02_parquet_scan", "SELECT p_partkey, p_name, p_retailprice FROM part")
def s02(spark, sf):
    return readers.read_parquet(spark, f"{sf}/part.parquet").select("p_partkey", "p_name", "p_retailprice")


@query("s03_load_by_suffix", LISTED_SQL.replace("SELECT id, name", "SELECT CAST(k AS VARCHAR) AS kind, id, name")
       .replace("FROM tracks", "FROM tracks, (VALUES ('csv'), ('parquet')) AS kinds(k)"))
def s03(spark, sf):
    df = tracks(spark, sf).select(*LISTED)
    flat = _trip(spark, df, writers.write_csv, lambda p: readers.read_table(spark, p, df.schema), ".csv")
    cols = _trip(spark, df, writers.write_parquet, lambda p: readers.read_table(spark, p), ".parquet")
    return rounded(flat.withColumn("kind", F.lit("csv")).unionByName(cols.withColumn("kind", F.lit("parquet"))))


@query("s05_nested_pages", "WITH " + NESTED + """
SELECT playlist_id, CAST(page_no AS BIGINT) AS page_no, CAST(id AS VARCHAR) AS track_id, name,
       CAST(popularity AS BIGINT) AS popularity, album_date
FROM raw WHERE NOT no_track AND id IS NOT NULL AND id <> ''""")
def s05(spark, sf):
    path = scratch_path(spark, "pages")
    nested_pages(spark, sf).write.json(path)
    rows = readers.read_playlist_pages(spark, path)
    return rounded(rows.select("playlist_id", "page_no", F.col("track.id").alias("track_id"), "track.name",
                               "track.popularity", F.col("track.album.release_date").alias("album_date")))


@query("s05_pages_put_aside", "WITH " + NESTED + """,
whole AS (SELECT *, CASE WHEN no_track THEN 'no track' WHEN id IS NULL OR id = '' THEN 'no id' ELSE 'read' END AS kind FROM raw WHERE page_no % 5 > 1)
SELECT kind, playlist_id, count(*) AS n FROM whole GROUP BY kind, playlist_id
UNION ALL SELECT 'damaged page', NULL, count(*) FROM (SELECT DISTINCT playlist_id, page_no FROM raw WHERE page_no % 5 <= 1) HAVING count(*) > 0""")
def s05_checked(spark, sf):
    """Pages of which two in five are damaged, one cut short, one of a wrong type: what is read and what is put aside."""
    path = scratch_path(spark, "pages")
    line, turn = F.to_json(F.struct("playlist_id", "page_no", "items")), F.col("page_no") % 5
    damaged = (F.when(turn == 0, F.substring(line, F.lit(1), F.floor(F.length(line) / 2).cast("int")))
               .when(turn == 1, F.regexp_replace(line, '"page_no":', '"page_no":"x",')).otherwise(line))
    nested_pages(spark, sf).select(damaged.alias("value")).write.text(path)
    rows, aside = readers.read_checked_pages(spark, path)
    kinds = rows.select(F.lit("read").alias("kind"), "playlist_id").unionByName(aside.select(F.col("reason").alias("kind"), "playlist_id"))
    return kinds.groupBy("kind", "playlist_id").agg(F.count("*").alias("n"))


@query("s06_csv_sink_lists", "WITH " + NESTED + """
SELECT track_id, nullif(array_to_string(artist_ids, '; '), '') AS artist_ids,
       nullif(array_to_string(artist_names, '; '), '') AS artist_names FROM flat""")
def s06(spark, sf):
    from cadenza.operators.ingest import flatten_tracks, page_items
    df = flatten_tracks(page_items(nested_pages(spark, sf))).select("track_id", "artist_ids", "artist_names")
    back = _trip(spark, df, writers.write_csv,
                 lambda p: readers.read_csv(spark, p, "track_id string, artist_ids string, artist_names string"))
    # an empty list is empty text, which CSV reads back as missing
    return back.withColumns({c: F.when(F.col(c) != "", F.col(c)) for c in ("artist_ids", "artist_names")})


@query("s07_parquet_sink", LISTED_SQL)
def s07(spark, sf):
    return rounded(_trip(spark, tracks(spark, sf).select(*LISTED), writers.write_parquet,
                         lambda p: readers.read_parquet(spark, p)))


@query("s08_save_vector_tables", "WITH " + FILLED + """
SELECT id, name, """ + R("popularity") + """ AS popularity, place, """ + R("x") + """ AS value
FROM (SELECT id, name, popularity, unnest(range(9)) AS place, unnest(vec) AS x FROM items)""")
def s08(spark, sf):
    path = scratch_path(spark, "index")
    df = tracks(spark, sf).fillna(0.0, subset=FEATURES).select("id", "name", *FEATURES)
    build_vector_tables(df, path)
    got = readers.index_items(readers.load_index(spark, path))
    return elements(got, "vec", ("id", "name", "popularity"))


@query("s08_feature_stats", "WITH " + FILLED + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {R(f'avg({c})')} AS mean, {R(f'stddev_pop({c})')} AS std FROM filled" for c in FEATURES))
def s08_stats(spark, sf):
    path = scratch_path(spark, "index")
    build_vector_tables(tracks(spark, sf).select("id", *FEATURES), path)
    return rounded(stats_by_feature(readers.load_index(spark, path)["feature_stats"], FEATURES))


@query("s09_load_with_fallback", "WITH " + FILLED + "SELECT id, 'raw' AS kind, place, " + R("x") + " AS value FROM (SELECT id, unnest(range(9)) AS place, unnest(vec) AS x FROM items)")
def s09(spark, sf):
    path = scratch_path(spark, "index")
    build_vector_tables(tracks(spark, sf).select("id", *FEATURES), path)
    tables, kind = readers.load_index_or_fallback(spark, scratch_path(spark, "missing"), path)
    return elements(tables["vectors"].withColumn("kind", F.lit(kind)), "vec", ("id", "kind"))


@query("s09_load_learned", "WITH " + FILLED + "SELECT id, 'learned' AS kind, place, " + R("x") + " AS value FROM (SELECT id, unnest(range(9)) AS place, unnest(vec) AS x FROM items)")
def s09_learned(spark, sf):
    path = scratch_path(spark, "index")
    build_vector_tables(tracks(spark, sf).select("id", *FEATURES), path)
    tables, kind = readers.load_index_or_fallback(spark, path, scratch_path(spark, "missing"))
    return elements(tables["vectors"].withColumn("kind", F.lit(kind)), "vec", ("id", "kind"))


def _metrics_sql():
    from cadenza.queries.evaluation import BASE, report_sql
    return BASE + report_sql("mood_label")


@query("s10_metrics_json", _metrics_sql())
def s10(spark, sf):
    path = scratch_path(spark, "metrics")
    df = labelled(spark, sf).drop("ingest_seq")
    writers.write_metrics(ev.evaluate(df, k=10, sample_size=200), 10, path)
    return rounded(spark.read.json(path))


@query("s11_table_profile", """
SELECT 'p_partkey, p_name, p_brand, p_type, p_size, p_retailprice' AS columns,
       (SELECT count(*) FROM part) AS n_rows,
       (SELECT '{"p_partkey":' || p_partkey || ',"p_name":"' || p_name || '","p_brand":"' || p_brand || '","p_type":"'
          || p_type || '","p_size":' || p_size || ',"p_retailprice":' || p_retailprice || '}'
        FROM part ORDER BY p_partkey LIMIT 1) AS sample""")
def s11(spark, sf):
    return profile.table_profile(table(spark, sf, "part"), "p_partkey")
