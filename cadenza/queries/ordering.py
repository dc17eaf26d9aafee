"""W, T, D, U, L: windows, sorting, deduplication, union, sampling."""

from pyspark.sql import functions as F

from cadenza.operators import ingest, joins, ordering, recommend
from cadenza.plans.catalog import deduplicated
from cadenza.plans.search import recent_searches
from cadenza.queries.base import LABELLED, R, REPEATED, TRACKS, labelled, query, repeated, rounded, table, tracks


@query("w01_group_totals", "WITH " + TRACKS + f"""
SELECT id, primary_genre, count(*) OVER w AS group_n, {R('sum(tempo) OVER w')} AS group_sum_tempo,
  {R('sum(popularity) OVER w')} AS group_sum_popularity FROM tracks WINDOW w AS (PARTITION BY primary_genre)""")
def w01(spark, sf):
    df = tracks(spark, sf).select("id", "primary_genre", "tempo", "popularity")
    return rounded(joins.with_group_totals(df, "primary_genre", ["tempo", "popularity"], ["id"]).drop("tempo", "popularity"))


@query("w02_artist_run", "WITH " + TRACKS + """
SELECT id, primary_genre, artists, row_number() OVER (PARTITION BY primary_genre, artists ORDER BY popularity DESC, id) - 1 AS earlier FROM tracks""")
def w02(spark, sf):
    df = tracks(spark, sf).select("id", "primary_genre", "artists", "popularity")
    run = recommend.with_artist_run(df, "primary_genre", "artists", [F.col("popularity").desc(), F.col("id")])
    return rounded(run.drop("popularity"))


@query("w03_rank_numbers", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_suppkey, l_partkey) AS rank FROM lineitem""")
def w03(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice")
    order = [F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")]
    return rounded(ordering.number_results(df, "l_orderkey", order).drop("l_extendedprice", "l_partkey"))


@query("w04_cumulative_hits", """
SELECT l_orderkey, rank, CAST(sum(rel) OVER (PARTITION BY l_orderkey ORDER BY rank) AS BIGINT) AS hits FROM (
  SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS rel,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_suppkey, l_partkey) AS rank FROM lineitem)""")
def w04(spark, sf):
    df = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice",
        (F.col("l_returnflag") == "R").cast("int").alias("rel"))
    order = [F.col("l_extendedprice").desc(), F.col("l_linenumber"), F.col("l_suppkey"), F.col("l_partkey")]
    return rounded(ordering.running(df, ["l_orderkey"], order, {"hits": "rel"}).select("l_orderkey", "rank", "hits"))


@query("w04_cumulative_hits_split", """
SELECT l_returnflag, rank, CAST(sum(rel) OVER (PARTITION BY l_returnflag ORDER BY rank) AS BIGINT) AS hits FROM (
  SELECT l_returnflag, CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS rel,
    row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_suppkey, l_partkey) AS rank FROM lineitem)""")
def w04_split(spark, sf):
    """Three groups hold all rows; the form that spreads one group over many tasks."""
    df = table(spark, sf, "lineitem").select(
        "l_returnflag", "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "l_extendedprice",
        (F.col("l_linestatus") == "F").cast("int").alias("rel"))
    order = [F.col("l_extendedprice").desc(), *[F.col(c) for c in ("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")]]
    got = ordering.running(df, ["l_returnflag"], order, {"hits": "rel"}, max_group=1000)
    return rounded(got.select("l_returnflag", "rank", "hits"))


@query("w05_recent_searches", """
SELECT user_id, rank, query, ts FROM (
  SELECT user_id, query, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rank FROM (
    SELECT user_id, event_type AS query, ts, event_id,
      row_number() OVER (PARTITION BY user_id, lower(event_type) ORDER BY ts DESC, event_id DESC) AS rn FROM events)
  WHERE rn = 1) WHERE rank <= 5""")
def w05(spark, sf):
    history = table(spark, sf, "events").select("user_id", "ts", F.col("event_id").alias("seq"), F.col("event_type").alias("query"))
    return rounded(recent_searches(history))


@query("t01_top_by_popularity", "WITH " + TRACKS + f"SELECT id, name, {R('popularity')} AS popularity FROM tracks ORDER BY popularity DESC, ingest_seq LIMIT 10")
def t01(spark, sf):
    return rounded(ordering.top_rows(tracks(spark, sf), "popularity", 10).select("id", "name", "popularity"))


@query("t02_top_per_query", "WITH " + TRACKS + f"""
SELECT artists, id, rank, {R('tempo')} AS tempo FROM (
  SELECT *, row_number() OVER (PARTITION BY artists ORDER BY tempo DESC, id) AS rank FROM tracks) WHERE rank <= 5""")
def t02(spark, sf):
    top = ordering.top_per_group(tracks(spark, sf), ["artists"], [F.col("tempo").desc(), F.col("id")], 5, rank="rank")
    return rounded(top.select("artists", "id", "rank", "tempo"))


@query("t03_sort_and_head", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def t03(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("t04_numbered_listing", "WITH " + LABELLED + f"""
SELECT row_number() OVER (ORDER BY ingest_seq) AS row_no, name, artists, mood_label, {R('popularity')} AS popularity FROM labelled""")
def t04(spark, sf):
    return rounded(ordering.listing(labelled(spark, sf), ["name", "artists", "mood_label", "popularity"]))


@query("d01_keep_first", "WITH " + REPEATED + f"""
SELECT id, name, ingest_seq, {R('tempo')} AS tempo FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq) AS rn FROM repeated) WHERE rn = 1""")
def d01(spark, sf):
    return rounded(ordering.keep_first(repeated(spark, sf), "id").select("id", "name", "ingest_seq", "tempo"))


@query("d01_removed_count", "WITH " + REPEATED + "SELECT count(*) AS n_before, count(DISTINCT id) AS n_after, count(*) - count(DISTINCT id) AS n_removed FROM repeated")
def d01_removed(spark, sf):
    return ordering.removed_by_dedupe(repeated(spark, sf), "id")


@query("d01_write_report", "WITH " + REPEATED + """,
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY ingest_seq) AS rn FROM repeated) WHERE rn = 1),
totals AS (SELECT count(*) AS n FROM repeated)
SELECT 'n_before' AS measure, n FROM totals UNION ALL SELECT 'n_after', count(*) FROM firsts
UNION ALL SELECT 'n_removed', (SELECT n FROM totals) - count(*) FROM firsts
""" + "".join(f"UNION ALL SELECT 'missing_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM firsts\n" for c in ("name", "tempo", "release_date")))
def d01_report(spark, sf):
    """Removed rows and missing values as the write of the deduplicated table saw them."""
    return deduplicated(repeated(spark, sf).select("id", "ingest_seq", "name", "tempo", "release_date"), "id")[1]


@query("u01_union_by_name", """
SELECT 'order' AS kind, o_orderkey AS key, o_totalprice AS amount, o_orderpriority AS priority, NULL AS segment FROM orders
UNION ALL SELECT 'customer', c_custkey, c_acctbal, NULL, c_mktsegment FROM customer
UNION ALL SELECT 'supplier', s_suppkey, s_acctbal, NULL, NULL FROM supplier""")
def u01(spark, sf):
    o = table(spark, sf, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("key"),
                                          F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"))
    c = table(spark, sf, "customer").select(F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("amount"),
                                            F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"))
    s = table(spark, sf, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_acctbal").alias("amount"),
                                            F.col("s_suppkey").alias("key"))
    return ingest.union_tables([o, c, s])


@query("l01_seeded_sample", "WITH " + TRACKS + "SELECT id, name FROM tracks ORDER BY md5(id || ':42'), id LIMIT 200")
def l01(spark, sf):
    return ordering.sample_rows(tracks(spark, sf), 200).select("id", "name")
