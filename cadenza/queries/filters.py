"""F: filters."""

from pyspark.sql import functions as F

from cadenza.functions import scalars as x
from cadenza.operators import clean, ingest, recommend
from cadenza.queries.base import (
    LABELLED, NESTED, R, SEARCHES, TRACKS, labelled, nested_entries, query, r6, rounded, searches, stripped, table,
    tracks,
)
from cadenza.schema import MOOD_PLOT_ORDER


@query("f01_drop_missing", "WITH " + TRACKS + f"SELECT id, {R('energy')} AS energy, {R('valence')} AS valence FROM tracks WHERE energy IS NOT NULL AND valence IS NOT NULL")
def f01(spark, sf):
    return rounded(clean.drop_missing(tracks(spark, sf), ["energy", "valence"]).select("id", "energy", "valence"))


@query("f02_has_id", "WITH " + NESTED + "SELECT playlist_id, id, p_size AS size FROM raw WHERE NOT no_track AND id IS NOT NULL AND id <> ''")
def f02(spark, sf):
    rows = nested_entries(spark, sf).select("playlist_id", "item.track.id", "item.track")
    size = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("id"), F.col("p_size").alias("size"))
    return ingest.has_id(rows).drop("track").join(size, "id")


@query("f03_label_equals", "WITH " + LABELLED + "SELECT id, name, mood_label FROM labelled WHERE mood_label = 'sad'")
def f03(spark, sf):
    return labelled(spark, sf).filter(F.col("mood_label") == "sad").select("id", "name", "mood_label")


@query("f04_mood_match_equal", "WITH " + LABELLED + "SELECT id, mood_label FROM labelled WHERE lower(mood_label) = 'chill'")
def f04(spark, sf):
    return recommend.match_label(labelled(spark, sf), "CHILL").select("id", "mood_label")


@query("f04_mood_match_contains", "WITH " + LABELLED + "SELECT id, mood_label FROM labelled WHERE lower(mood_label) LIKE '%mel%'")
def f04_contains(spark, sf):
    return recommend.match_label(labelled(spark, sf), "Mel").select("id", "mood_label")


@query("f05_name_contains", "WITH " + TRACKS + "SELECT id, name FROM tracks WHERE lower(name) LIKE '%ring%'")
def f05(spark, sf):
    return recommend.name_contains(tracks(spark, sf), "RING").select("id", "name")


@query("f06_name_equals", "WITH " + TRACKS + "SELECT id, name FROM tracks WHERE lower(name) = 'small ring'")
def f06(spark, sf):
    return recommend.name_equals(tracks(spark, sf), "Small Ring").select("id", "name")


@query("f07_known_moods", "WITH " + LABELLED + "SELECT id, mood_label FROM labelled WHERE mood_label IN ('sad','romantic','chill','neutral','party','old_melody')")
def f07(spark, sf):
    return labelled(spark, sf).filter(F.col("mood_label").isin(*MOOD_PLOT_ORDER)).select("id", "mood_label")


@query("f08_fill_mood", "WITH " + LABELLED + """
SELECT id, CASE WHEN artists = 'Brand#7' OR tempo > 150 THEN mood_label ELSE primary_genre END AS mood_label FROM labelled""")
def f08(spark, sf):
    given = F.when(F.col("artists") == "Brand#7", F.lit(None)).when(F.col("tempo") > 150, F.lit("")).otherwise(F.col("primary_genre"))
    df = tracks(spark, sf).withColumn("mood_label", given)
    return ingest.apply_mood_rules(df).select("id", "mood_label")


@query("f09_finite_or_zero", "WITH " + TRACKS + f"""
SELECT id, {R("CASE WHEN danceability = 0 OR energy IS NULL THEN 0 ELSE energy / danceability END")} AS ratio FROM tracks""")
def f09(spark, sf):
    ratio = F.when(F.col("danceability") == 0, F.lit(float("inf"))).otherwise(
        F.col("energy") / F.when(F.col("danceability") == 0, 1.0).otherwise(F.col("danceability")))
    return tracks(spark, sf).select("id", r6(x.finite_or_zero(ratio)).alias("ratio"))


@query("f10_blank_query", "WITH " + SEARCHES + f"SELECT qid, {stripped('text')} = '' AS is_blank FROM searches")
def f10(spark, sf):
    return searches(spark, sf).select("qid", x.is_blank(F.col("text")).alias("is_blank"))
