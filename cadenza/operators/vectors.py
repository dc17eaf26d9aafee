"""Vector expressions and exact nearest neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cadenza.operators.blocks import Dot, block_top_k
from cadenza.operators.clean import EPSILON, attach_row, column_stats
from cadenza.session import write_and_read


def inner_product(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda s, x: s + x)


def norm(v: Column) -> Column:
    return F.sqrt(inner_product(v, v))


def unit(v: Column) -> Column:
    """Scaled to length 1; a zero vector stays zero."""
    # the length is bound to a lambda variable so that it is computed once per vector
    scaled = F.transform(F.array(norm(v)), lambda n: F.transform(
        v, lambda x: F.when(n == 0, F.lit(0.0)).otherwise(x.cast("double") / n)))
    return scaled[0]


def cosine(a: Column, b: Column) -> Column:
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(inner_product(a, b) / n)


def normalized_vector(columns, stats: Column) -> Column:
    """Raw features to z-scores with given catalog statistics, as a vector."""
    return F.array(*[(F.coalesce(F.col(c).cast("double"), F.lit(0.0)) - stats[f"mean_{c}"])
                     / (stats[f"std_{c}"] + EPSILON) for c in columns])


def feature_table(df: DataFrame, columns, stats: DataFrame | None = None, keep=("id",)) -> DataFrame:
    """(keep..., vec): missing values count as 0, then z-scores by mean and population std."""
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns})
    stats = column_stats(filled, columns) if stats is None else stats
    return attach_row(filled, stats).select(*keep, normalized_vector(columns, F.col("_stats")).alias("vec"))


def nearest_items(items: DataFrame, seeds: DataFrame | None, k: int, metric: str = "ip", **bounds) -> DataFrame:
    """k best other items for every seed id: (qid, id, score, rank). ``items`` is (id, vec).

    Seeds that are not in the catalog give no rows; without ``seeds`` every item is one. Vectors are
    written once, for the seeds and the scan.
    """
    if metric not in ("ip", "cosine"):
        raise ValueError("metric must be 'ip' or 'cosine'")
    vec = unit(F.col("vec")) if metric == "cosine" else F.col("vec")
    items = write_and_read(items.select("id", vec.alias("vec")), "items")
    found = items if seeds is None else items.join(seeds.select("id").distinct(), "id", "left_semi")
    queries = found.select(F.col("id").alias("qid"), F.col("id").alias("exclude_id"), "vec")
    return block_top_k(items, queries, k, Dot(), written=True, **bounds)


def nearest_to_vectors(items: DataFrame, queries: DataFrame, k: int, metric: str = "ip", **bounds) -> DataFrame:
    """k best items for arbitrary vectors: ``queries`` is (qid, vec[, exclude_id])."""
    if metric == "cosine":
        items = items.select("id", unit(F.col("vec")).alias("vec"))
        queries = queries.withColumn("vec", unit(F.col("vec")))
    return block_top_k(items, queries, k, Dot(), **bounds)
