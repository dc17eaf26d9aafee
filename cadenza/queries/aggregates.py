"""A: aggregations."""

from pyspark.sql import functions as F

from cadenza.functions.scalars import bounded_release_year
from cadenza.operators import clean, genres, ingest, learning, profile
from cadenza.operators.joins import rescaled_in_groups
from cadenza.operators.quantiles import exact_quantiles
from cadenza.queries.base import (
    FEATURES, LABELLED, NESTED, R, TRACKS, labelled, nested_entries, query, rounded, table, tracks,
)
from cadenza.schema import MOOD_FEATURES


def each(template, columns=FEATURES):
    """One SELECT per feature, united; ``{c}`` is the feature."""
    return " UNION ALL ".join(template.replace("{c}", c) for c in columns)


@query("a01_mean_population_std", "WITH " + TRACKS + each(
    f"SELECT '{{c}}' AS feature, {R('avg({c})')} AS mean, {R('stddev_pop({c})')} AS std FROM tracks"))
def a01(spark, sf):
    return rounded(clean.stats_by_feature(clean.column_stats(tracks(spark, sf), FEATURES), FEATURES))


@query("a02_mean_sample_std", "WITH " + TRACKS + each(
    f"SELECT '{{c}}' AS feature, {R('avg({c})')} AS mean, {R('stddev_samp({c})')} AS std FROM tracks"))
def a02(spark, sf):
    return rounded(clean.stats_by_feature(clean.column_stats(tracks(spark, sf), FEATURES, "sample"), FEATURES))


@query("a03_missing_counts", "WITH " + TRACKS + each(
    f"SELECT '{{c}}' AS column_name, count(*) - count({{c}}) AS missing, {R('100e0 * (count(*) - count({c})) / count(*)')} AS missing_pct FROM tracks",
    FEATURES + ["name", "release_date"]))
def a03(spark, sf):
    return rounded(clean.missing_counts(tracks(spark, sf), FEATURES + ["name", "release_date"]))


def _strategy(name):
    def run(spark, sf):
        df = tracks(spark, sf)
        values = clean.impute_values(df, FEATURES, name)
        rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in FEATURES])
        return rounded(values.select(F.explode(rows).alias("r")).select("r.*"))
    return run


query("a04_impute_mean", "WITH " + TRACKS + each(f"SELECT '{{c}}' AS feature, {R('avg({c})')} AS value FROM tracks"))(_strategy("mean"))
query("a04_impute_median", "WITH " + TRACKS + each(f"SELECT '{{c}}' AS feature, {R('median({c})')} AS value FROM tracks"))(_strategy("median"))
query("a04_impute_most_frequent", "WITH " + TRACKS + each(
    f"SELECT '{{c}}' AS feature, (SELECT {R('{c}')} FROM tracks WHERE {{c}} IS NOT NULL GROUP BY {{c}} ORDER BY count(*) DESC, {{c}} LIMIT 1) AS value"))(_strategy("most_frequent"))


@query("a05_value_counts", "WITH " + LABELLED + f"SELECT mood_label, count(*) AS n, {R('100e0 * count(*) / (SELECT count(*) FROM labelled)')} AS pct FROM labelled GROUP BY mood_label")
def a05(spark, sf):
    return rounded(profile.value_counts(labelled(spark, sf), "mood_label"))


@query("a06_top_genres", "WITH " + TRACKS + "SELECT primary_genre, count(*) AS n FROM tracks GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def a06(spark, sf):
    return profile.top_values(tracks(spark, sf), "primary_genre", 10)


@query("a06_top_artists", "WITH " + TRACKS + "SELECT artists, count(*) AS n FROM tracks GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10")
def a06_artists(spark, sf):
    return profile.top_values(tracks(spark, sf), "artists", 10)


TOKENS = "tokens AS (SELECT trim(unnest(string_split(all_genres, ';'))) AS genre FROM tracks WHERE all_genres NOT IN ('', 'Unknown'))"


@query("a07_top_tokens", "WITH " + TRACKS + ", " + TOKENS + "SELECT genre, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20")
def a07(spark, sf):
    return genres.top_genres(tracks(spark, sf))


@query("a07_unique_tokens", "WITH " + TRACKS + ", " + TOKENS + "SELECT count(DISTINCT genre) AS n_unique, count(*) AS n_all FROM tokens")
def a07_unique(spark, sf):
    return rounded(genres.token_counts(tracks(spark, sf)).agg(F.count("*").alias("n_unique"), F.sum("n").alias("n_all")))


@query("a08_mood_statistics", "WITH " + LABELLED + f""",
f AS (SELECT *, tempo * 1000 AS artist_followers FROM labelled),
g AS (SELECT mood_label, primary_genre, row_number() OVER (PARTITION BY mood_label ORDER BY count(*) DESC, primary_genre) AS rn
      FROM f GROUP BY mood_label, primary_genre)
SELECT f.mood_label, count(*) AS n_tracks, {R('avg(popularity)')} AS avg_popularity, {R('avg(artist_followers)')} AS avg_followers,
       max(g.primary_genre) AS top_genre
FROM f JOIN g ON f.mood_label = g.mood_label AND rn = 1 GROUP BY f.mood_label""")
def a08(spark, sf):
    return rounded(profile.mood_statistics(labelled(spark, sf).withColumn("artist_followers", F.col("tempo") * 1000)))


@query("a09_regroup_tracks", """WITH lines AS (
  SELECT l_orderkey, l_linenumber * 1000000 + l_suppkey AS pos, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag || l_linestatus END AS g,
         l_quantity AS followers, l_tax AS pop, l_shipdate FROM lineitem),
d AS (SELECT l_orderkey, g, min(pos) AS first_pos FROM lines WHERE g IS NOT NULL GROUP BY 1, 2),
t AS (SELECT l_orderkey, string_agg(g, '; ' ORDER BY first_pos, g) AS all_genres, arg_min(g, (first_pos, g)) AS primary_genre FROM d GROUP BY 1)
SELECT CAST(l_orderkey AS VARCHAR) AS track_id, coalesce(max(primary_genre), '') AS primary_genre, coalesce(max(all_genres), '') AS all_genres,
       """ + R("max(followers)") + " AS artist_followers, " + R("max(pop)") + """ AS artist_popularity
FROM lines LEFT JOIN t USING (l_orderkey) GROUP BY l_orderkey""")
def a09(spark, sf):
    """Order lines stand in for the exploded artists of a track: lists, first values and maxima per order."""
    genre = F.when(F.col("l_returnflag") != "R", F.concat("l_returnflag", "l_linestatus"))
    pos = (F.col("l_linenumber") * 1000000 + F.col("l_suppkey"))
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("track_id"), pos.alias("artist_pos"),
        genre.alias("primary_genre"), genre.alias("all_genres"),
        F.col("l_quantity").alias("artist_followers"), F.col("l_tax").alias("artist_popularity"))
    return rounded(ingest.regroup_tracks(rows))


DESCRIBE = f"""SELECT '{{c}}' AS feature, count({{c}}) AS count, {R('avg({c})')} AS mean, {R('stddev_samp({c})')} AS std,
 {R('min({c})')} AS min, {R('quantile_cont({c}, 0.25)')} AS p25, {R('quantile_cont({c}, 0.5)')} AS p50,
 {R('quantile_cont({c}, 0.75)')} AS p75, {R('max({c})')} AS max FROM tracks"""


@query("a10_describe", "WITH " + TRACKS + each(DESCRIBE))
def a10(spark, sf):
    return rounded(profile.describe(tracks(spark, sf), FEATURES))


PRICES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("a10_describe_lines", each(DESCRIBE.replace("tracks", "lineitem"), PRICES))
def a10_lines(spark, sf):
    return rounded(profile.describe(table(spark, sf, "lineitem"), PRICES))


def corr_sql(columns, source):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {R(f'corr({a}, {b})')} AS r FROM {source}"
        for i, a in enumerate(columns) for b in columns[:i])


@query("a11_correlations", "WITH " + TRACKS + corr_sql(FEATURES, "tracks"))
def a11(spark, sf):
    return rounded(profile.correlations(tracks(spark, sf), FEATURES))


@query("a11_correlations_all_numeric", corr_sql(["l_linenumber"] + PRICES, "lineitem"))
def a11_all(spark, sf):
    df = table(spark, sf, "lineitem")
    return rounded(profile.numeric_correlations(df, exclude=("l_orderkey", "l_partkey", "l_suppkey")))


def hist_sql(columns, bins, source):
    return ", ".join(f"""e_{c} AS (SELECT min({c}) AS lo, max({c}) AS hi, avg({c}) AS mean FROM {source}),
b_{c} AS (SELECT CAST(least(floor(({c} - lo) / (hi - lo) * {bins}), {bins - 1}) AS INTEGER) AS bin, count(*) AS n FROM {source}, e_{c} WHERE {c} IS NOT NULL GROUP BY 1)"""
                     for c in columns) + " " + " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, CAST(r AS BIGINT) AS bin, {R(f'lo + r * ((hi - lo) / {bins})')} AS bin_start,
 {R(f'lo + (r + 1) * ((hi - lo) / {bins})')} AS bin_end, coalesce(n, 0) AS n, {R('mean')} AS mean
FROM e_{c}, range({bins}) AS g(r) LEFT JOIN b_{c} ON bin = r""" for c in columns)


@query("a12_histogram_valence", "WITH " + TRACKS + ", " + hist_sql(["valence"], 50, "tracks"))
def a12(spark, sf):
    return rounded(profile.histogram(tracks(spark, sf), ["valence"], 50))


@query("a12_histogram_features", "WITH " + TRACKS + ", " + hist_sql(FEATURES, 80, "tracks"))
def a12_all(spark, sf):
    return rounded(profile.histogram(tracks(spark, sf), FEATURES, 80))


def box_sql(columns, by, source):
    return " UNION ALL ".join(f"""SELECT * FROM (
 WITH q AS (SELECT {by}, count({c}) AS n, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.5) AS median, quantile_cont({c}, 0.75) AS q3
            FROM {source} WHERE {c} IS NOT NULL GROUP BY {by})
 SELECT q.{by}, '{c}' AS feature, n, {R('q1')} AS q1, {R('median')} AS median, {R('q3')} AS q3,
   {R(f'min(CASE WHEN {c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1) THEN {c} END)')} AS whisker_low,
   {R(f'max(CASE WHEN {c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1) THEN {c} END)')} AS whisker_high,
   count(*) FILTER (NOT ({c} >= q1 - 1.5e0 * (q3 - q1) AND {c} <= q3 + 1.5e0 * (q3 - q1))) AS n_outliers
 FROM {source} s JOIN q ON s.{by} = q.{by} WHERE {c} IS NOT NULL GROUP BY q.{by}, n, q1, median, q3)""" for c in columns)


@query("a13_box_by_mood", "WITH " + LABELLED + box_sql(MOOD_FEATURES, "mood_label", "labelled"))
def a13(spark, sf):
    return rounded(profile.box_summary(labelled(spark, sf), MOOD_FEATURES))


@query("a14_global_rescale", "WITH " + TRACKS + f"SELECT id, {R('(popularity - (SELECT min(popularity) FROM tracks)) / ((SELECT max(popularity) - min(popularity) FROM tracks) + 1e-8)')} AS pop_norm FROM tracks")
def a14(spark, sf):
    from cadenza.operators.recommend import with_popularity_prior
    return rounded(with_popularity_prior(tracks(spark, sf)).select("id", "pop_norm"))


@query("a14_rescale_per_query", """SELECT o_orderkey, l_linenumber, l_suppkey, """ + R("""CASE WHEN hi > lo THEN (l_quantity - lo) / (hi - lo) ELSE 1 END""") + """ AS rescaled FROM (
  SELECT l_orderkey AS o_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey, l_quantity,
   min(l_quantity) OVER (PARTITION BY l_orderkey) AS lo, max(l_quantity) OVER (PARTITION BY l_orderkey) AS hi FROM lineitem)""")
def a14_per_query(spark, sf):
    df = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "o_orderkey").select(
        "o_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    return rounded(rescaled_in_groups(df, "o_orderkey", "l_quantity").drop("l_quantity"))


@query("a15_median_year", "WITH " + TRACKS + """
SELECT """ + R("median(y)") + """ AS median_year, count(y) AS n FROM (
  SELECT CASE WHEN CAST(substr(release_date, 1, 4) AS INTEGER) BETWEEN 1900 AND 2025 THEN CAST(substr(release_date, 1, 4) AS INTEGER) END AS y FROM tracks)""")
def a15(spark, sf):
    years = tracks(spark, sf).select(bounded_release_year(F.col("release_date")).alias("year"))
    return rounded(exact_quantiles(years, ["year"], [0.5]).select(F.col("q0").alias("median_year"), "n"))


@query("a16_distinct_artists", "WITH " + NESTED + "SELECT DISTINCT unnest(artist_ids) AS artist_id FROM flat")
def a16(spark, sf):
    return ingest.distinct_artists(ingest.flatten_tracks(nested_entries(spark, sf).select("item.track")))


@query("a17_label_counts", "WITH " + LABELLED + "SELECT mood_label, count(*) AS n FROM labelled GROUP BY 1 ORDER BY 1")
def a17(spark, sf):
    return profile.label_counts(labelled(spark, sf), "mood_label")


@query("a18_training_summary", "WITH " + LABELLED + "SELECT count(*) AS n_rows, count(DISTINCT mood_label) AS n_profiles, 9 AS n_features FROM labelled")
def a18(spark, sf):
    examples, _ = learning.profile_examples(labelled(spark, sf), "mood_label", FEATURES)
    return learning.training_summary(examples, FEATURES)
