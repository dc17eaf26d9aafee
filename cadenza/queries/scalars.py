"""X: scalar expressions over whole tables."""

from pyspark.sql import functions as F

from cadenza.functions import scalars as x
from cadenza.operators import clean, genres
from cadenza.queries.base import (
    FILLED, LABELLED, R, SEARCHES, TRACKS, big, feature_items, labelled, query, rounded, searches, stripped, table,
    tracks,
)
from cadenza.schema import MOODS

YEAR = "TRY_CAST(trim(string_split(d, '-')[1]) AS INTEGER)"
# dates in several shapes: order dates, years beyond the range, text
DATES = """dates AS (SELECT o_orderkey, CASE o_orderpriority
  WHEN '1-URGENT' THEN CAST(CAST(floor(o_totalprice) AS BIGINT) % 3000 AS VARCHAR)
  WHEN '2-HIGH' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR)
  WHEN '3-MEDIUM' THEN 'n/a' WHEN '5-LOW' THEN '' ELSE NULL END AS d FROM orders)"""


def _dates(spark, sf):
    p = F.col("o_orderpriority")
    d = (F.when(p == "1-URGENT", (F.floor("o_totalprice").cast("bigint") % 3000).cast("string"))
         .when(p == "2-HIGH", F.col("o_orderdate").cast("date").cast("string"))
         .when(p == "3-MEDIUM", F.lit("n/a")).when(p == "5-LOW", F.lit("")))
    return table(spark, sf, "orders").select("o_orderkey", d.alias("release_date"))


@query("x01_release_year", "WITH " + DATES + f""", y AS (SELECT o_orderkey, CASE WHEN {YEAR} BETWEEN 1900 AND 2025 THEN {YEAR} END AS y FROM dates)
SELECT o_orderkey, {R('coalesce(y, (SELECT median(y) FROM y))')} AS release_year FROM y""")
def x01(spark, sf):
    return rounded(clean.add_release_year(_dates(spark, sf)).select("o_orderkey", "release_year"))


@query("x02_unbounded_year", "WITH " + DATES + f"SELECT o_orderkey, CAST({YEAR} AS BIGINT) AS y FROM dates")
def x02(spark, sf):
    return _dates(spark, sf).select("o_orderkey", big(x.release_year(F.col("release_date"))).alias("y"))


@query("x03_mood_rule", "WITH " + LABELLED + "SELECT id, mood_label FROM labelled")
def x03(spark, sf):
    return labelled(spark, sf).select("id", "mood_label")


@query("x04_standard_mood", "WITH " + LABELLED + """
SELECT id, CASE WHEN tempo > 150 THEN mood_label WHEN tempo > 120 THEN mood_label ELSE 'neutral' END AS mood_label FROM labelled""")
def x04(spark, sf):
    odd = (F.when(F.col("tempo") > 150, F.upper("mood_label")).when(F.col("tempo") > 120, F.initcap("mood_label"))
           .when(F.col("tempo") > 90, F.lit("focus")))
    return labelled(spark, sf).select("id", x.standard_mood(odd, MOODS).alias("mood_label"))


@query("x05_genre_keyword", "SELECT doc_id, regexp_matches(lower(text), 'oldies|classic|vintage|retro') AS vintage FROM documents")
def x05(spark, sf):
    return table(spark, sf, "documents").select("doc_id", x.has_vintage_genre(F.col("text")).alias("vintage"))


@query("x06_multi_hot", "WITH " + TRACKS + """,
tokens AS (SELECT trim(unnest(string_split(all_genres, ';'))) AS genre FROM tracks),
top AS (SELECT genre, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20)
SELECT id, 'genre_' || replace(lower(genre), ' ', '_') AS column_name, CAST(contains(lower(all_genres), lower(genre)) AS BIGINT) AS hot
FROM tracks, top""")
def x06(spark, sf):
    return _hot_rows(genres.multi_hot(tracks(spark, sf)))


def _hot_rows(df):
    hot = [c for c in df.columns if c.startswith("genre_")]
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("hot")) for c in hot])
    return rounded(df.select("id", F.explode(pairs).alias("p")).select("id", "p.*"))


@query("x06_multi_hot_tokens", "WITH " + TRACKS + """,
tokens AS (SELECT trim(unnest(string_split(all_genres, ';'))) AS genre FROM tracks),
top AS (SELECT genre, count(*) AS n FROM tokens GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20)
SELECT id, 'genre_' || replace(lower(genre), ' ', '_') AS column_name,
  CAST(list_contains(list_transform(string_split(lower(all_genres), ';'), lambda g: trim(g)), lower(genre)) AS BIGINT) AS hot
FROM tracks, top""")
def x06_tokens(spark, sf):
    return _hot_rows(genres.multi_hot(tracks(spark, sf), match="token"))


@query("x07_search_text", "SELECT p_partkey, lower(coalesce(CASE WHEN p_size = 50 THEN NULL ELSE p_name END, '') || ' ' || coalesce(CASE WHEN p_size < 3 THEN NULL ELSE p_brand END, '')) AS text FROM part")
def x07(spark, sf):
    return table(spark, sf, "part").select("p_partkey", x.search_text(
        F.when(F.col("p_size") != 50, F.col("p_name")), F.when(F.col("p_size") >= 3, F.col("p_brand"))).alias("text"))


Z = "WITH " + FILLED + ", z AS (SELECT id, vec[2] AS energy, vec[3] AS valence, vec[1] AS danceability, popularity, name, artists FROM items) "


def _z(spark, sf):
    v = F.col("vec")
    return feature_items(spark, sf).select("id", "name", "artists", "popularity", v[1].alias("energy"), v[2].alias("valence"), v[0].alias("danceability"))


def label_sql(c, high, low, neutral):
    return f"CASE WHEN {c} >= 0.65e0 THEN '{high}' WHEN {c} <= -0.65e0 THEN '{low}' ELSE '{neutral}' END"


@query("x08_feature_label", Z + f"SELECT id, {label_sql('energy', 'high', 'low', 'neutral')} AS energy, {label_sql('valence', 'up', 'down', 'mid')} AS valence FROM z")
def x08(spark, sf):
    return _z(spark, sf).select("id", x.feature_label(F.col("energy"), "high", "low", "neutral").alias("energy"),
                                x.feature_label(F.col("valence"), "up", "down", "mid").alias("valence"))


def pct_sql(c):
    return f"CAST(least(95, greatest(5, trunc(({c} + 2e0) / 4e0 * 100))) AS BIGINT)"


@query("x09_percent_of_z", Z + f"""SELECT id, {pct_sql('energy')} AS energy, {pct_sql('valence')} AS valence,
  CAST(least(95, greatest(5, floor((danceability + 2e0) / 4e0 * 100 + 0.5e0))) AS BIGINT) AS dance_rounded FROM z""")
def x09(spark, sf):
    return rounded(_z(spark, sf).select("id", x.percent_of_z(F.col("energy")).alias("energy"),
                                        x.percent_of_z(F.col("valence")).alias("valence"),
                                        x.percent_of_z(F.col("danceability"), "round").alias("dance_rounded")))


THEME = "CASE " + " ".join(
    f"WHEN regexp_matches(q, '{'|'.join(w)}') THEN '{t}'" for t, w in x.THEME_WORDS.items()) + " ELSE 'chill' END"


@query("x11_query_theme", "WITH " + SEARCHES + f"SELECT qid, {THEME} AS theme FROM (SELECT qid, lower({stripped('text')}) AS q FROM searches)")
def x11(spark, sf):
    return searches(spark, sf).select("qid", x.query_theme(F.col("text")).alias("theme"))


@query("x11_document_theme", f"SELECT doc_id, {THEME} AS theme FROM (SELECT doc_id, lower({stripped('text')}) AS q FROM documents)")
def x11_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", x.query_theme(F.col("text")).alias("theme"))


REASONS = f"""list_filter([
  'ranked highly by the ' || artists || ' scorer (' || format('{{:.3f}}', energy) || ')',
  CASE WHEN sim IS NOT NULL THEN 'strong vector similarity to the seed track (' || format('{{:.3f}}', sim) || ')' END,
  CASE WHEN pop IS NOT NULL THEN 'popularity is ' || format('{{:.1f}}', pop) END,
  {label_sql('energy', 'high energy', 'low energy', 'balanced energy')},
  {label_sql('valence', 'brighter mood', 'more melancholic mood', 'balanced mood')},
  {label_sql('danceability', 'dance-forward feel', 'less dance-focused feel', 'moderate danceability')}], lambda r: r IS NOT NULL)"""


@query("x12_explanation", Z + f""", e AS (SELECT *, CASE WHEN popularity > 30 THEN valence END AS sim,
  CASE WHEN popularity < 33 THEN popularity END AS pop FROM z)
SELECT id, array_to_string(list_slice({REASONS}, 1, 4), ' | ') AS reasons FROM e""")
def x12(spark, sf):
    df = _z(spark, sf).withColumns({
        "final_score": F.col("energy"),
        "similarity_score": F.when(F.col("popularity") > 30, F.col("valence")),
        "popularity": F.when(F.col("popularity") < 33, F.col("popularity"))})
    reasons = x.explanation(df.columns, F.lit("tfidf"), F.col("artists"))
    return df.select("id", F.array_join(reasons, " | ").alias("reasons"))


TITLE = "array_to_string(list_transform(regexp_extract_all({t}, '[A-Za-z]+|[^A-Za-z]+'), lambda w: upper(w[1]) || lower(w[2:])), '')"


@query("x13_labels", "WITH " + SEARCHES + f"""
SELECT qid, 'Vibe: *' || {TITLE.format(t=stripped('text'))} || '*' AS vibe_label, '**' || qid || '** by ' || text AS track_label FROM searches""")
def x13(spark, sf):
    return searches(spark, sf).select("qid", x.vibe_label(F.col("text")).alias("vibe_label"),
                                      x.track_label(F.col("qid"), F.col("text")).alias("track_label"))


@query("x13_title_case", f"SELECT o_orderkey, {TITLE.format(t='o_orderpriority')} AS title FROM orders")
def x13_title(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", x.title_case(F.col("o_orderpriority")).alias("title"))


@query("x14_round_scores", "SELECT o_orderkey, round_even(o_totalprice / 7e0, 4) AS score FROM orders")
def x14(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.bround(F.col("o_totalprice") / 7.0, 4).alias("score"))
