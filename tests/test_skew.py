"""Forms made for hot keys give the same rows as the plain ones."""

import numpy as np
import pytest
from pyspark.sql import Window as W, functions as F

from cadenza.operators import joins, ordering
from cadenza.operators.quantiles import exact_quantiles


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows has key 0."""
    n = 3000
    rows = [(i, 0 if i % 3 == 0 else i % 50, float((i * 37) % 101)) for i in range(n)]
    return spark.createDataFrame(rows, "i int, k int, v double").repartition(6)


def as_set(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join(spark, hot, how):
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 60, 2)], "k int, name string")
    salted = joins.salted_join(hot, right, "k", how, ["i"], rows_per_salt=100)
    assert as_set(salted) == as_set(hot.join(right, "k", how))


def test_lookup_join_beyond_broadcast(spark, hot, monkeypatch):
    right = spark.createDataFrame([(k, f"r{k}") for k in range(50)], "k int, name string")
    monkeypatch.setattr(joins, "fits_broadcast", lambda df: False)
    assert as_set(joins.lookup_join(hot, right, "k")) == as_set(hot.join(right, "k", "left"))


def test_salted_join_without_hot_keys(spark, hot):
    right = spark.createDataFrame([(k, f"r{k}") for k in range(50)], "k int, name string")
    assert as_set(joins.salted_join(hot, right, "k", "left", ["i"])) == as_set(hot.join(right, "k", "left"))


def test_fits_broadcast(hot):
    assert joins.fits_broadcast(hot)
    assert not joins.fits_broadcast(hot, rows=100)
    assert not joins.fits_broadcast(hot, size=1000)


@pytest.mark.parametrize("max_group", [1_000_000, 10])
def test_running(hot, max_group):
    order = [F.col("v").desc(), F.col("i")]
    got = ordering.running(hot, ["k"], order, {"total": "v"}, max_group=max_group)
    w = W.partitionBy("k").orderBy(*order)
    want = hot.withColumn("rank", F.row_number().over(w)).withColumn(
        "total", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)))
    assert as_set(got) == as_set(want)


def test_group_totals(hot):
    got = joins.with_group_totals(hot, "k", ["v"], ["i"])
    w = W.partitionBy("k")
    want = hot.withColumn("group_n", F.count("*").over(w)).withColumn("group_sum_v", F.sum("v").over(w))
    assert as_set(got) == as_set(want)


def test_known_rows(spark, hot):
    catalog = spark.createDataFrame([(k,) for k in range(0, 50, 5)], "k int")
    known, unknown = joins.known_rows(hot, catalog, "k")
    assert known.count() + unknown.count() == 3000
    assert {r[0] for r in known.select("k").distinct().collect()} == set(range(0, 50, 5))


def test_positions(spark):
    df = spark.createDataFrame([(i * i, f"x{i}") for i in range(500)], "ord bigint, x string").repartition(7)
    got = ordering.with_position(df, "ord", "pos", rows_per_bucket=30).orderBy("ord").collect()
    assert [r["pos"] for r in got] == list(range(500))


def test_shuffled_positions_are_a_permutation(hot):
    got = ordering.with_shuffled_position(hot, "i", 3, "pos").collect()
    assert sorted(r["pos"] for r in got) == list(range(3000))
    assert [r["pos"] for r in sorted(got, key=lambda r: r["i"])] != list(range(3000))


def test_sample_is_stable(hot):
    a = ordering.sample_rows(hot, 40, "i", 1)
    assert as_set(a) == as_set(ordering.sample_rows(hot.repartition(3), 40, "i", 1))
    assert as_set(a) != as_set(ordering.sample_rows(hot, 40, "i", 2))


def test_keep_first(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "first"), ("b", 5, "only")], "id string, ingest_seq int, v string")
    assert as_set(ordering.keep_first(df, "id").select("v")) == [("first",), ("only",)]
    assert ordering.removed_by_dedupe(df, "id").first()["n_removed"] == 1


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0, 1.0, 2.0], [5.0] * 100, list(np.random.default_rng(0).normal(size=5000)),
    list(np.random.default_rng(1).integers(0, 4, 3000).astype(float)), [0.0] * 999 + [1.0]])
def test_exact_quantiles(spark, values):
    df = spark.createDataFrame([(float(v), None) for v in values] + [(None, None)], "v double, empty double")
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    rows = exact_quantiles(df, ["v", "empty"], probs).collect()
    assert len(rows) == 1 and rows[0]["n"] == len(values)
    assert np.allclose([rows[0][f"q{i}"] for i in range(len(probs))], np.quantile(values, probs))


def test_exact_quantiles_by_group(spark, hot):
    got = exact_quantiles(hot, ["v"], [0.25, 0.5], "k", [0, 1, 2]).collect()
    frame = hot.toPandas()
    assert {r["k"] for r in got} == {0, 1, 2}
    for r in got:
        assert np.allclose([r["q0"], r["q1"]], np.quantile(frame.v[frame.k == r["k"]], [0.25, 0.5]))


def test_small_groups_are_spread_over_few_ranges(spark):
    from pyspark.sql import functions as F
    from cadenza.operators.ordering import running
    df = spark.range(4000).select((F.col("id") % 2).alias("g"), F.col("id").alias("at"), F.lit(1).alias("one"))
    got = running(df, ["g"], [F.col("at").desc()], {"upto": "one"}, max_group=10)
    assert got.filter(F.col("rank") != F.col("upto")).count() == 0 and got.count() == 4000
    # a range of its own for every ten rows would be 400 files
    assert len([f for f in got.inputFiles() if "/ranges-" in f]) <= 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
