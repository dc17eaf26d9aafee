"""M: learning data and embeddings."""

from pyspark.sql import functions as F

from cadenza.operators import learning as ml
from cadenza.operators.recommend import with_popularity_prior
from cadenza.operators.vectors import unit
from cadenza.plans.catalog import build_learned_tables
from cadenza.queries.base import (
    FEATURES, FILLED, LABELLED, R, TRACKS, feature_items, labelled, query, rounded, table, tracks,
)
from cadenza.queries.vectors import elements


def examples_sql(profile):
    """ex(id, profile, group_n, item_vec, user_vec)"""
    cols = FEATURES
    return f"""work AS (SELECT id, {profile} AS profile, {', '.join(f'coalesce({c}, 0e0) AS {c}' for c in cols)} FROM labelled WHERE {profile} IS NOT NULL),
ws AS (SELECT {', '.join(f'avg({c}) AS m_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS s_{c}' for c in cols)} FROM work),
sc AS (SELECT id, profile, {', '.join(f'({c} - m_{c}) / s_{c} AS {c}' for c in cols)} FROM work, ws),
ex AS (SELECT id, profile, count(*) OVER w AS group_n, [{', '.join(cols)}] AS item_vec,
  [{', '.join(f'CASE WHEN count(*) OVER w > 1 THEN (sum({c}) OVER w - {c}) / (count(*) OVER w - 1) ELSE {c} END' for c in cols)}] AS user_vec
  FROM sc WINDOW w AS (PARTITION BY profile))"""


@query("m01_profile_examples", "WITH " + LABELLED + ", " + examples_sql("mood_label") + f"""
SELECT id, profile, group_n, {', '.join(f"{R(f'item_vec[{i + 1}]')} AS item_{i}, {R(f'user_vec[{i + 1}]')} AS user_{i}" for i in range(9))} FROM ex""")
def m01(spark, sf):
    ex, _ = ml.profile_examples(labelled(spark, sf), "mood_label", FEATURES)
    cols = [c for i in range(9) for c in (F.col("item_vec")[i].alias(f"item_{i}"), F.col("user_vec")[i].alias(f"user_{i}"))]
    return rounded(ex.select("id", "profile", "group_n", *cols))


def noise_sql(i):
    """The two noise values of position i, from the 13-digit hexadecimal numbers of a hash."""
    h = f"md5(id || ':42:{i}')"
    u = [f"((CAST('0x' || substr({h}, {at}, 13) AS BIGINT) + 0.5e0) / {16 ** 13}e0)" for at in (1, 14)]
    radius = f"0.15e0 * sqrt(-2e0 * ln({u[0]}))"
    return [f"{radius} * {f}(2e0 * pi() * {u[1]})" for f in ("cos", "sin")]


@query("m02_augmented_views", "WITH " + FILLED + " SELECT id, " + ", ".join(
    f"{R(f'vec[{i + 1}] + {noise_sql(i)[v - 1]}')} AS view{v}_{i}" for v in (1, 2) for i in range(9)) + " FROM items")
def m02(spark, sf):
    views = ml.augmented_views(feature_items(spark, sf).select("id", "vec"))
    return rounded(views.select("id", *[F.col(f"view{v}")[i].alias(f"view{v}_{i}") for v in (1, 2) for i in range(9)]))


def batches_sql(source, size, seed=42, drop=False, order="id"):
    cut = f"WHERE batch_id < (SELECT count(*) FROM {source}) // {size}" if drop else ""
    return f"""batches AS (SELECT * FROM (SELECT *, pos // {size} AS batch_id, pos % {size} AS batch_pos FROM (
  SELECT *, row_number() OVER (ORDER BY md5(CAST({order} AS VARCHAR) || ':{seed}'), {order}) - 1 AS pos FROM {source})) {cut})"""


@query("m03_batches_drop_remainder", "WITH " + TRACKS + ", " + batches_sql("tracks", 300, drop=True) + "SELECT id, batch_id, batch_pos FROM batches")
def m03_drop(spark, sf):
    return rounded(ml.training_batches(tracks(spark, sf).select("id"), 300, drop_remainder=True))


@query("m03_batches", "WITH " + TRACKS + ", " + batches_sql("tracks", 1024) + "SELECT id, batch_id, batch_pos FROM batches")
def m03(spark, sf):
    return rounded(ml.training_batches(tracks(spark, sf).select("id"), ml.RETRIEVAL_BATCH))


def unit_sql(v):
    return f"list_transform({v}, lambda x: x / sqrt(list_inner_product({v}, {v})))"


@query("m04_contrastive_loss", f"""WITH e AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
mixed AS (SELECT id, v, list_transform(list_zip(v, list_reverse(v)), lambda p: 0.85e0 * p[1] + 0.15e0 * p[2]) AS u FROM e),
views AS (SELECT id, {unit_sql('v')} AS z1, {unit_sql('u')} AS z2 FROM mixed),
""" + batches_sql("views", 100, drop=True) + f""",
z AS (SELECT batch_id, id, 1 AS view, z1 AS z FROM batches UNION ALL SELECT batch_id, id, 2, z2 FROM batches),
logits AS (SELECT a.batch_id, a.id, a.view, a.id = b.id AS positive, list_inner_product(a.z, b.z) / 0.07e0 AS s
  FROM z a JOIN z b ON a.batch_id = b.batch_id AND NOT (a.id = b.id AND a.view = b.view)),
rowloss AS (SELECT batch_id, id, view, ln(sum(exp(s - top))) + any_value(top) - max(CASE WHEN positive THEN s END) AS l FROM (
  SELECT *, max(s) OVER (PARTITION BY batch_id, id, view) AS top FROM logits) GROUP BY 1, 2, 3)
SELECT batch_id, count(*) // 2 AS n, {R('avg(l)')} AS loss FROM rowloss GROUP BY batch_id""")
def m04(spark, sf):
    v = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("v"))
    views = v.select("id", unit(F.col("v")).alias("z1"), unit(
        F.zip_with("v", F.reverse("v"), lambda a, b: 0.85 * a + 0.15 * b)).alias("z2"))
    return rounded(ml.contrastive_loss(ml.training_batches(views, 100, drop_remainder=True)))


@query("m05_retrieval_loss", "WITH " + LABELLED + ", " + examples_sql("primary_genre") + ", " + batches_sql("ex", 256) + f""",
logits AS (SELECT a.batch_id, a.id, a.id = b.id AS positive, list_inner_product(a.user_vec, b.item_vec) AS s
  FROM batches a JOIN batches b ON a.batch_id = b.batch_id),
rowloss AS (SELECT batch_id, id, ln(sum(exp(s - top))) + any_value(top) - max(CASE WHEN positive THEN s END) AS l FROM (
  SELECT *, max(s) OVER (PARTITION BY batch_id, id) AS top FROM logits) GROUP BY 1, 2)
SELECT batch_id, count(*) AS n, {R('sum(l)')} AS loss FROM rowloss GROUP BY batch_id""")
def m05(spark, sf):
    ex, _ = ml.profile_examples(labelled(spark, sf), "primary_genre", FEATURES)
    return rounded(ml.retrieval_loss(ml.training_batches(ex, 256)))


def network_sql(sizes=(9, 256, 128, 64), activation="elu"):
    """out(id, j, v): the demo network as joins with its weights, before scaling to length 1."""
    steps = [f"""x0 AS (SELECT id, unnest(range(9)) AS i, unnest([{', '.join(f'coalesce({c}, 0e0)' for c in FEATURES)}]) AS v FROM tracks)"""]
    for n, (rows, cols) in enumerate(zip(sizes, sizes[1:])):
        hidden = n < len(sizes) - 2
        below = "exp(v) - 1" if activation == "elu" else "0e0"
        value = f"CASE WHEN v > 0 THEN v ELSE {below} END / sqrt(1e0 + 1e-3)" if hidden else "v"
        steps.append(f"""w{n} AS (SELECT i, j, sin(CAST(i * {cols} + j + {n} AS DOUBLE)) / sqrt({rows}e0) AS w FROM range({rows}) AS a(i), range({cols}) AS b(j)),
x{n + 1} AS (SELECT id, i, {value} AS v FROM (
  SELECT id, j AS i, sum(v * w) + cos(CAST(j AS DOUBLE)) / 10e0 AS v FROM x{n} JOIN w{n} USING (i) GROUP BY id, j))""")
    return ", ".join(steps) + f""", length AS (SELECT id, sqrt(sum(v * v)) AS n FROM x{len(sizes) - 1} GROUP BY id),
out AS (SELECT id, i, v / n AS v FROM x{len(sizes) - 1} JOIN length USING (id))"""


@query("m06_embed_items", "WITH " + TRACKS + ", " + network_sql() + f"""
SELECT id, i AS place, {R('v')} AS value FROM out""")
def m06(spark, sf):
    got = build_learned_tables(tracks(spark, sf), ml.demo_layers(9, 64))
    return elements(got, "vec")


@query("m06_embed_items_relu", "WITH " + TRACKS + ", " + network_sql(activation="relu") + f"SELECT id, i AS place, {R('v')} AS value FROM out")
def m06_relu(spark, sf):
    layers = ml.read_layers(ml.layers_table(spark, ml.demo_layers(9, 64, activation="relu")))
    return elements(build_learned_tables(tracks(spark, sf), layers), "vec")


@query("m07_popularity_prior", f"""
SELECT p_partkey AS id, {R('(p_retailprice - (SELECT min(p_retailprice) FROM part)) / ((SELECT max(p_retailprice) - min(p_retailprice) FROM part) + 1e-8)')} AS pop_norm FROM part""")
def m07(spark, sf):
    df = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("popularity"))
    return rounded(with_popularity_prior(df).select("id", "pop_norm"))
