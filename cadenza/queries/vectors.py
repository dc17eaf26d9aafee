"""V06-V12: vector operators."""

from pyspark.sql import functions as F

from cadenza.operators import profile, vectors as v
from cadenza.queries.base import FEATURES, FILLED, LABELLED, R, feature_items, labelled, query, rounded, table

def elements(df, column, keep=("id",)):
    """One row per element of a vector, numbered from 0."""
    return rounded(df.select(*keep, F.posexplode(column).alias("place", "value")))


PAIRS = """pairs AS (SELECT a.vec_id, CAST(a.embedding AS DOUBLE[]) AS x, CAST(list_reverse(b.embedding) AS DOUBLE[]) AS y
  FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1)"""


def _pairs(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    after = e.select((F.col("vec_id") - 1).alias("vec_id"), F.reverse("x").alias("y"))
    return e.join(after, "vec_id")


@query("v06_inner_product", "WITH " + PAIRS + f"SELECT vec_id, {R('list_inner_product(x, y)')} AS ip FROM pairs")
def v06(spark, sf):
    return rounded(_pairs(spark, sf).select("vec_id", v.inner_product(F.col("x"), F.col("y")).alias("ip")))


@query("v07_cosine", "WITH " + PAIRS + f"""SELECT vec_id, {R('list_inner_product(x, y) / sqrt(list_inner_product(x, x) * list_inner_product(y, y))')} AS cos,
  0e0 AS zero FROM pairs""")
def v07(spark, sf):
    nothing = F.transform("x", lambda e: e * 0.0)
    return rounded(_pairs(spark, sf).select("vec_id", v.cosine(F.col("x"), F.col("y")).alias("cos"),
                                            v.cosine(nothing, F.col("y")).alias("zero")))


@query("v08_unit_length", "WITH " + FILLED + f"""
SELECT id, place, {R('x')} AS value FROM (SELECT id, unnest(range(9)) AS place, unnest(list_transform(vec, lambda e: e / sqrt(list_inner_product(vec, vec)))) AS x FROM items)""")
def v08(spark, sf):
    u = feature_items(spark, sf).select("id", v.unit(F.col("vec")).alias("u"))
    return elements(u, "u")


def top_sql(score, source="items", k=10, queries=None, own="q.id <> i.id"):
    queries = queries or source
    return f"""scored AS (SELECT q.id AS qid, i.id AS id, CAST({score} AS DOUBLE) AS score FROM {queries} q JOIN {source} i ON {own}),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, id) AS rank FROM scored)
SELECT qid, id, rank, {R('score')} AS score FROM ranked WHERE rank <= {k}"""


IP = "list_inner_product(q.vec, i.vec)"
COS = "list_inner_product(q.vec, i.vec) / (sqrt(list_inner_product(q.vec, q.vec)) * sqrt(list_inner_product(i.vec, i.vec)))"


@query("v09_nearest_inner_product", "WITH " + FILLED + ", " + top_sql(IP))
def v09(spark, sf):
    items = feature_items(spark, sf)
    return rounded(v.nearest_items(items, None, 10))


@query("v09_nearest_embeddings", """WITH items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings), """ + top_sql(IP))
def v09_embeddings(spark, sf):
    items = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return rounded(v.nearest_items(items, None, 10))


@query("v10_nearest_cosine", "WITH " + FILLED + ", " + top_sql(COS))
def v10(spark, sf):
    items = feature_items(spark, sf)
    return rounded(v.nearest_items(items, None, 10, metric="cosine"))


@query("v11_nearest_to_vectors", """WITH items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
asked AS (SELECT id, list_reverse(vec) AS vec FROM items), """ + top_sql(IP, queries="asked", k=5))
def v11(spark, sf):
    items = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    asked = items.select(F.col("id").alias("qid"), F.col("id").alias("exclude_id"), F.reverse("vec").alias("vec"))
    return rounded(v.nearest_to_vectors(items, asked, 5))


@query("v11_nearest_grid", """WITH items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings),
asked AS (SELECT id, list_reverse(vec) AS vec FROM items), """ + top_sql(IP, queries="asked", k=5, own="true"))
def v11_grid(spark, sf):
    """The block-against-block form used when the queries are too many to send to every task."""
    items = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    asked = items.select(F.col("id").alias("qid"), F.reverse("vec").alias("vec"))
    n = max(items.count() // 3, 1)
    return rounded(v.nearest_to_vectors(items, asked, 5, max_query_rows=1, block_rows=n))


SOUND = [c for c in FEATURES if c != "popularity"]


def leading_sql(step, matrix, d):
    """e{step}(u, a): unit eigenvector of the largest eigenvalue of ``matrix`` (a), by repeated squaring."""
    square = f"""list_transform(range({d * d}), lambda p: list_sum(list_transform(range({d}),
      lambda k: m[CAST((p // {d}) * {d} + k + 1 AS INTEGER)] * m[CAST(k * {d} + p % {d} + 1 AS INTEGER)])))"""
    return f"""p{step} AS (SELECT 0 AS n, a, a AS m FROM {matrix} UNION ALL
  SELECT n + 1, a, list_transform(q, lambda x: x / list_max(list_transform(q, lambda y: abs(y)))) FROM (SELECT n, a, {square} AS q FROM p{step} WHERE n < 40)),
d{step} AS (SELECT a, m, list_transform(range({d}), lambda k: m[CAST(k * {d + 1} + 1 AS INTEGER)]) AS diag FROM p{step} WHERE n = 40),
c{step} AS (SELECT a, list_transform(range({d}), lambda k: m[CAST(k * {d} + list_position(diag, list_max(diag)) AS INTEGER)]) AS v FROM d{step}),
b{step} AS (SELECT a, v, list_transform(v, lambda x: abs(x)) AS av FROM c{step}),
e{step} AS (SELECT a, list_transform(v, lambda x: x * sign(v[list_position(av, list_max(av))]) / sqrt(list_inner_product(v, v))) AS u FROM b{step})"""


def components_sql(columns):
    d = len(columns)
    outer = f"u[CAST(p // {d} + 1 AS INTEGER)] * u[CAST(p % {d} + 1 AS INTEGER)]"
    return f"""whole AS (SELECT id, mood_label, {', '.join(columns)} FROM labelled WHERE {' AND '.join(f'{c} IS NOT NULL' for c in columns)}),
zs AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in columns)} FROM whole),
z AS (SELECT id, mood_label, [{', '.join(f'({c} - m_{c}) / s_{c}' for c in columns)}] AS z FROM whole, zs),
cov AS (SELECT [{', '.join(f'avg(z[{i + 1}] * z[{j + 1}])' for i in range(d) for j in range(d))}] AS a FROM z),
{leading_sql(1, 'cov', d)},
rest AS (SELECT list_transform(range({d * d}), lambda p: a[CAST(p + 1 AS INTEGER)] - l * {outer}) AS a FROM (
  SELECT a, u, list_sum(list_transform(range({d * d}), lambda p: a[CAST(p + 1 AS INTEGER)] * {outer})) AS l FROM e1)),
{leading_sql(2, 'rest', d)}
SELECT id, mood_label, {R('list_inner_product(z, e1.u)')} AS pc1, {R('list_inner_product(z, e2.u)')} AS pc2 FROM z, e1, e2"""


@query("v12_principal_components", "WITH RECURSIVE " + LABELLED + ", " + components_sql(SOUND))
def v12(spark, sf):
    coords, _ = profile.principal_components(labelled(spark, sf), SOUND)
    return rounded(coords)
