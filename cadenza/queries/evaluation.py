"""E: offline evaluation."""

from cadenza.operators import evaluate as ev
from cadenza.queries.base import LABELLED, R, labelled, query, rounded
from cadenza.sources.writers import metrics_with_k

ORDER = ["popularity", "energy", "valence", "danceability", "tempo", "acousticness", "speechiness", "instrumentalness", "liveness"]


def eval_sql(label="mood_label", k=10, sample=200):
    """recs(qid, seed_label, rank, id, rel, artists) and per(qid, ...) over the labelled tracks."""
    return f"""base AS (SELECT id, CAST({label} AS VARCHAR) AS label, artists, {', '.join(f'coalesce({c}, 0e0) AS {c}' for c in ORDER)} FROM labelled),
bs AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) + 1e-8 AS s_{c}' for c in ORDER)} FROM base),
items AS (SELECT id, label, artists, [{', '.join(f'({c} - m_{c}) / s_{c}' for c in ORDER)}] AS vec FROM base, bs),
units AS (SELECT id, label, artists, list_transform(vec, lambda x: x / sqrt(list_inner_product(vec, vec))) AS vec FROM items),
sampled AS (SELECT * FROM units ORDER BY md5(id || ':42'), id LIMIT {sample}),
near AS (SELECT q.id AS qid, q.label AS seed_label, i.id, i.label, i.artists, list_inner_product(q.vec, i.vec) AS score
  FROM sampled q JOIN units i ON q.id <> i.id WHERE q.label IS NOT NULL),
recs AS (SELECT *, CASE WHEN label = seed_label THEN 1 ELSE 0 END AS rel FROM (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM near) WHERE rank <= {k}),
hits AS (SELECT *, sum(rel) OVER (PARTITION BY qid ORDER BY rank) AS h FROM recs),
per AS (SELECT qid, seed_label, sum(rel) AS hits, sum(rel * h / rank) / {k}e0 AS average_precision, sum(rel / log2(rank + 1)) AS dcg,
  count(DISTINCT coalesce(artists, 'None')) / {k}e0 AS artist_diversity FROM hits GROUP BY 1, 2),
totals AS (SELECT label AS seed_label, count(*) - 1 AS others FROM units GROUP BY 1),
metrics AS (SELECT qid, seed_label, hits, hits / {k}e0 AS precision, hits / greatest(others, 1) AS recall, average_precision,
  CASE WHEN others > 0 THEN dcg / list_sum(list_transform(range(1, least(others, {k}) + 1), lambda r: 1e0 / log2(r + 1))) ELSE 0e0 END AS ndcg, artist_diversity
  FROM per JOIN totals USING (seed_label))"""


def _recs(spark, sf, label="mood_label"):
    df = labelled(spark, sf).drop("ingest_seq")
    return df, ev.recommendations(df, 10, 200, 42, label)


def _metrics(spark, sf, *columns):
    df, recs = _recs(spark, sf)
    return rounded(ev.query_metrics(df, recs, 10).select("qid", *columns))


BASE = "WITH " + LABELLED + ", " + eval_sql()


@query("e01_harness_recommendations", BASE + f"SELECT qid, seed_label, rank, id, rel, {R('score')} AS score FROM recs")
def e01(spark, sf):
    return rounded(_recs(spark, sf)[1].select("qid", "seed_label", "rank", "id", "rel", "score"))


@query("e02_precision", BASE + f"SELECT qid, seed_label, CAST(hits AS BIGINT) AS hits, {R('precision')} AS precision FROM metrics")
def e02(spark, sf):
    return _metrics(spark, sf, "seed_label", "hits", "precision")


@query("e03_recall", BASE + f"SELECT qid, {R('recall')} AS recall FROM metrics")
def e03(spark, sf):
    return _metrics(spark, sf, "recall")


@query("e04_average_precision", BASE + f"SELECT qid, {R('average_precision')} AS average_precision FROM metrics")
def e04(spark, sf):
    return _metrics(spark, sf, "average_precision")


@query("e05_ndcg", BASE + f"SELECT qid, {R('ndcg')} AS ndcg FROM metrics")
def e05(spark, sf):
    return _metrics(spark, sf, "ndcg")


@query("e06_catalog_coverage", BASE + f"SELECT {R('(SELECT count(DISTINCT id) FROM recs) / (SELECT count(*) FROM labelled)')} AS catalog_coverage")
def e06(spark, sf):
    return rounded(ev.evaluate(labelled(spark, sf).drop("ingest_seq")).select("catalog_coverage"))


@query("e07_artist_diversity", BASE + f"SELECT qid, {R('artist_diversity')} AS artist_diversity FROM metrics")
def e07(spark, sf):
    return _metrics(spark, sf, "artist_diversity")


def report_sql(label, k=10):
    return f"""SELECT (SELECT count(*) FROM labelled) AS rows, '{label}' AS label_column, 9 AS feature_count,
 {R('avg(precision)')} AS "precision@{k}", {R('avg(recall)')} AS "recall@{k}", {R('avg(average_precision)')} AS "map@{k}", {R('avg(ndcg)')} AS "ndcg@{k}",
 {R('(SELECT count(DISTINCT id) FROM recs) / (SELECT count(*) FROM labelled)')} AS catalog_coverage, {R('avg(artist_diversity)')} AS artist_diversity FROM metrics"""


@query("e08_report", BASE + report_sql("mood_label"))
def e08(spark, sf):
    return metrics_with_k(rounded(ev.evaluate(labelled(spark, sf).drop("ingest_seq"))), 10)


@query("e08_report_by_genre", "WITH " + LABELLED + ", " + eval_sql("primary_genre") + report_sql("primary_genre"))
def e08_genre(spark, sf):
    return metrics_with_k(rounded(ev.evaluate(labelled(spark, sf).drop("ingest_seq"), label="primary_genre")), 10)
