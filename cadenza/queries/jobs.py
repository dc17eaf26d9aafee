"""K: end-to-end jobs."""

from functools import reduce

from pyspark.sql import functions as F

from cadenza.operators import ingest, learning as ml
from cadenza.plans import catalog
from cadenza.queries.aggregates import DESCRIBE, box_sql, corr_sql, each, hist_sql
from cadenza.queries.base import (
    ARTISTS, AUDIO, FEATURES, FILLED, LABELLED, MOOD_CASE, NESTED, R, REPEATED, TRACKS, artists, audio,
    labelled, nested_pages, query, repeated, rounded, tracks,
)
from cadenza.queries.learning import examples_sql, network_sql
from cadenza.queries.scaling import SCALED
from cadenza.queries.vectors import components_sql, elements
from cadenza.schema import AUDIO9_EDA, CLUSTER_FEATURES, MOOD_FEATURES
from cadenza.session import scratch_path
from cadenza.sources import readers, writers

SOUNDS = [c for c in FEATURES if c != "popularity"]
# two playlists carry a mood label, the others are labelled by rule
PLAYLISTS = {"FAVOURITES": "", "ECONOMY": "sad", "PROMO": "party", "STANDARD": "", "SMALL": "", "MEDIUM": "", "LARGE": ""}

COLLECTED = NESTED + ", " + AUDIO + ", " + ARTISTS + """,
lists AS (SELECT * FROM (VALUES """ + ", ".join(f"('{p}', '{m}', {i})" for i, (p, m) in enumerate(PLAYLISTS.items())) + """) AS l(playlist_id, mood, n)),
firsts AS (SELECT * FROM (SELECT flat.*, mood, row_number() OVER (PARTITION BY track_id ORDER BY n, page_no, pos) AS rn
  FROM flat JOIN lists USING (playlist_id)) WHERE rn = 1),
sounds AS (SELECT f.*, a.danceability, a.energy, a.valence, a.tempo, a.speechiness, a.acousticness, a.instrumentalness, a.liveness
  FROM firsts f LEFT JOIN audio a ON f.track_id = a.id AND a.id <> ''),
ex AS (SELECT track_id, unnest(artist_ids) AS artist_id, generate_subscripts(artist_ids, 1) AS artist_pos FROM sounds),
ja AS (SELECT * FROM ex LEFT JOIN artist_cols USING (artist_id)),
ga AS (SELECT track_id, max(artist_followers) AS artist_followers, max(artist_popularity) AS artist_popularity,
  arg_min(primary_genre, artist_pos) FILTER (primary_genre IS NOT NULL) AS pg,
  list(all_genres ORDER BY artist_pos) FILTER (all_genres IS NOT NULL) AS texts FROM ja GROUP BY track_id),
joined AS (SELECT sounds.*, artist_followers, artist_popularity, coalesce(pg, '') AS primary_genre,
  CASE WHEN texts IS NULL THEN '' WHEN len(texts) = 2 AND texts[1] <> texts[2] THEN texts[1] || '; ' || texts[2] ELSE texts[1] END AS all_genres
  FROM sounds LEFT JOIN ga USING (track_id)),
collected AS (SELECT *, CASE WHEN mood <> '' THEN mood ELSE """ + MOOD_CASE + """ END AS mood_label FROM joined)"""


def _collected(spark, sf):
    path = scratch_path(spark, "landed")
    nested_pages(spark, sf).write.json(path)
    items = readers.read_playlist_pages(spark, path)
    return catalog.collect_catalog(items, audio(spark, sf), artists(spark, sf), PLAYLISTS)


@query("k01_collect", "WITH " + COLLECTED + f"""
SELECT track_id, name, array_to_string(artist_names, '; ') AS artist_names, CAST(popularity AS BIGINT) AS popularity, album, release_date,
  {', '.join(f"{R(c)} AS {c}" for c in SOUNDS)}, primary_genre, all_genres, artist_followers, artist_popularity, mood_label FROM collected""")
def k01(spark, sf):
    got = writers.lists_to_text(_collected(spark, sf))
    return rounded(got.select("track_id", "name", "artist_names", "popularity", "album", "release_date", *SOUNDS, "primary_genre", "all_genres", "artist_followers", "artist_popularity", "mood_label"))


@query("k01_collect_mood_counts", "WITH " + COLLECTED + "SELECT mood_label, count(*) AS n FROM collected GROUP BY 1")
def k01_counts(spark, sf):
    path = scratch_path(spark, "collected")
    writers.write_csv(_collected(spark, sf), path)
    return readers.read_csv(spark, path).groupBy("mood_label").agg(F.count("*").alias("n"))


# preprocessing of repeated tracks with a mood, keyed by track_id
PREPARED = REPEATED + f""",
moody AS (SELECT *, upper({MOOD_CASE}) AS mood_raw FROM repeated),
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq) AS rn FROM moody) WHERE rn = 1),
years AS (SELECT *, CASE WHEN CAST(substr(release_date, 1, 4) AS INTEGER) BETWEEN 1900 AND 2025 THEN CAST(substr(release_date, 1, 4) AS INTEGER) END AS y FROM firsts),
filled AS (SELECT id, name, lower(mood_raw) AS mood_label, all_genres, {', '.join(f'coalesce({c}, (SELECT median({c}) FROM years)) AS {c}' for c in FEATURES)},
  coalesce(y, (SELECT median(y) FROM years)) AS release_year FROM years),
tokens AS (SELECT trim(unnest(string_split(all_genres, ';'))) AS genre FROM filled),
top AS (SELECT genre, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20),
hot AS (SELECT id, genre, CAST(contains(lower(all_genres), lower(genre)) AS DOUBLE) AS h FROM filled, top)"""


def _prepared(spark, sf, method):
    from cadenza.functions.scalars import mood_rule
    df = repeated(spark, sf).withColumn("mood_label", F.upper(mood_rule(["valence", "energy", "danceability", "tempo", "acousticness", "release_date", "all_genres"])))
    return catalog.preprocess(df.withColumnRenamed("id", "track_id"), method)[0]


def _flat_scaled(df):
    hot = [c for c in df.columns if c.startswith("genre_")]
    return rounded(df.select("track_id", "name", "mood_label", "popularity", "release_year", *SCALED,
                             F.lit(len(hot)).alias("n_genres"), reduce(lambda a, b: a + b, [F.col(c) for c in hot]).alias("genre_sum")))


def scaled_sql(shift, spread):
    cols = SCALED + ["release_year"]
    one = lambda c: f"CASE WHEN {spread.format(c=c)} = 0 THEN 1 ELSE {spread.format(c=c)} END"
    return f""", s AS (SELECT {', '.join(f'{shift.format(c=c)} AS m_{c}, {one(c)} AS s_{c}' for c in cols)} FROM filled),
hs AS (SELECT genre, {shift.format(c='h')} AS m, {one('h')} AS sd FROM hot GROUP BY genre),
hz AS (SELECT id, sum((h - m) / sd) AS genre_sum, count(*) AS n_genres FROM hot JOIN hs USING (genre) GROUP BY id)
SELECT id AS track_id, name, mood_label, {R('popularity')} AS popularity, {', '.join(f"{R(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in cols)},
  n_genres, {R('genre_sum')} AS genre_sum FROM filled JOIN hz USING (id), s"""


@query("k02_preprocess_standard", "WITH " + PREPARED + scaled_sql("avg({c})", "stddev_pop({c})"))
def k02(spark, sf):
    return _flat_scaled(_prepared(spark, sf, "standard"))


@query("k02_genre_columns", "WITH " + PREPARED + """,
hs AS (SELECT genre, avg(h) AS m, CASE WHEN stddev_pop(h) = 0 THEN 1 ELSE stddev_pop(h) END AS sd FROM hot GROUP BY genre)
SELECT id AS track_id, 'genre_' || replace(lower(genre), ' ', '_') AS column_name, """ + R("(h - m) / sd") + """ AS value FROM hot JOIN hs USING (genre)""")
def k02_genres(spark, sf):
    """Every scaled genre column by its name."""
    df = _prepared(spark, sf, "standard")
    cells = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("value")) for c in df.columns if c.startswith("genre_")])
    return rounded(df.select("track_id", F.inline(cells)))


@query("k02_preprocess_minmax", "WITH " + PREPARED + scaled_sql("min({c})", "(max({c}) - min({c}))"))
def k02_minmax(spark, sf):
    return _flat_scaled(_prepared(spark, sf, "minmax"))


@query("k03_preprocess_large", "WITH " + REPEATED + f""",
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq) AS rn FROM repeated WHERE tempo < 175) WHERE rn = 1),
s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) + 1e-8 AS s_{c}' for c in FEATURES)} FROM firsts)
SELECT id, name, artists, primary_genre AS genres, {', '.join(f"{R(f'({c} - m_{c}) / s_{c}')} AS {c}" for c in FEATURES)} FROM firsts, s""")
def k03(spark, sf):
    raw = repeated(spark, sf).withColumnsRenamed({"id": "track_id", "name": "track_name", "primary_genre": "track_genre"})
    raw = raw.withColumn("track_name", F.when(F.col("tempo") < 175, F.col("track_name")))
    path = scratch_path(spark, "large")
    writers.write_parquet(catalog.preprocess_large(raw), path)
    return rounded(readers.read_parquet(spark, path))


EDA = [c for c in AUDIO9_EDA if c != "loudness"]


def present_clusters():
    return [c for c in CLUSTER_FEATURES if c != "loudness"]



DESCRIBED = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]
BOXED = ["n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers"]
BINNED = ["bin_start", "bin_end", "n", "mean"]


def _long_sql(section, item, columns, source):
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} || '.{c}' AS item, {R(c)} AS value FROM {source}" for c in columns)


@query("k04_profile_report", "WITH RECURSIVE " + LABELLED + ", h AS (WITH " + hist_sql(["valence"], 50, "labelled")
       + "), b AS (" + box_sql(MOOD_FEATURES, "mood_label", "labelled")
       + "), d AS (" + each(DESCRIBE.replace("tracks", "labelled"), MOOD_FEATURES)
       + f"), v AS (SELECT mood_label, count(*) AS n, 100e0 * count(*) / (SELECT count(*) FROM labelled) AS pct FROM labelled GROUP BY mood_label"
       + f"), r AS ({corr_sql(EDA, 'labelled')}), pc AS (WITH RECURSIVE " + components_sql(present_clusters()) + ") "
       + " UNION ALL ".join([
           _long_sql("moods", "mood_label", ["n", "pct"], "v"), _long_sql("describe", "feature", DESCRIBED, "d"),
           _long_sql("valence_histogram", "CAST(bin AS VARCHAR)", BINNED, "h"),
           _long_sql("correlations", "feature_a || '|' || feature_b", ["r"], "r"),
           _long_sql("boxes", "mood_label || '.' || feature", BOXED, "b"),
           _long_sql("components", "id || '.' || mood_label", ["pc1", "pc2"], "pc")]))
def k04(spark, sf):
    t = catalog.profile_report(labelled(spark, sf))

    def part(name, item, columns):
        values = F.array(*[F.struct(F.concat(item, F.lit(f".{c}")).alias("item"), F.col(c).cast("double").alias("value"))
                           for c in columns])
        return t[name].select(F.lit(name).alias("section"), F.explode(values).alias("v")).select("section", "v.*")

    c = F.col
    parts = [
        part("moods", c("mood_label"), ["n", "pct"]),
        part("describe", c("feature"), DESCRIBED),
        part("valence_histogram", c("bin").cast("string"), BINNED),
        part("correlations", F.concat_ws("|", "feature_a", "feature_b"), ["r"]),
        part("boxes", F.concat_ws(".", "mood_label", "feature"), BOXED),
        part("components", F.concat_ws(".", "id", "mood_label"), ["pc1", "pc2"]),
    ]
    return rounded(ingest.union_tables(parts))


@query("k05_build_vector_table", "WITH " + FILLED + f"SELECT id, {', '.join(f'{R(f'vec[{i + 1}]')} AS v{i}' for i in range(9))} FROM items")
def k05(spark, sf):
    path = scratch_path(spark, "vectors")
    catalog.build_vector_tables(tracks(spark, sf).select("id", "name", "artists", *FEATURES), path)
    got = readers.load_index(spark, path)["vectors"]
    return rounded(got.select("id", *[F.col("vec")[i].alias(f"v{i}") for i in range(9)]))


@query("k07_build_learned_table", "WITH " + TRACKS + ", " + network_sql() + f"""
SELECT id, name, i AS place, {R('v')} AS value FROM out JOIN tracks USING (id)""")
def k07(spark, sf):
    path = scratch_path(spark, "learned")
    catalog.build_learned_tables(tracks(spark, sf).select("id", "name", "artists", *FEATURES), ml.demo_layers(9, 64), path)
    got = readers.index_items(readers.load_index(spark, path))
    return elements(got, "vec", ("id", "name"))


@query("k08_build_profile_examples", "WITH " + LABELLED + ", " + examples_sql("mood_label") + f"""
SELECT id, profile, place, {R('item')} AS item, {R('usr')} AS user_value FROM (
  SELECT id, profile, unnest(range(9)) AS place, unnest(item_vec) AS item, unnest(user_vec) AS usr FROM ex)""")
def k08(spark, sf):
    examples, _, _ = catalog.build_profile_examples(labelled(spark, sf))
    both = examples.select("id", "profile", F.posexplode(F.arrays_zip("item_vec", "user_vec")).alias("place", "v"))
    return rounded(both.select("id", "profile", "place", F.col("v.item_vec").alias("item"), F.col("v.user_vec").alias("user_value")))


@query("k08_summary", "WITH " + LABELLED + "SELECT count(*) AS n_rows, count(DISTINCT mood_label) AS n_profiles, 9 AS n_features, 'mood_label' AS profile_column FROM labelled")
def k08_summary(spark, sf):
    return rounded(catalog.build_profile_examples(labelled(spark, sf))[2])
