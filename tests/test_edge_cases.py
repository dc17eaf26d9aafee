"""Missing values, blanks of any kind, excluded items, ranks outside their brackets and hot keys without a limit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza import schema
from cadenza.functions.scalars import is_blank, track_label
from cadenza.functions.text import strip
from cadenza.operators import joins, learning, ordering, profile, quantiles, recommend as rec, tfidf
from cadenza.operators.quantiles import exact_quantiles


def test_training_features(spark):
    def chosen(columns):
        return schema.training_features(spark.createDataFrame([], ", ".join(f"`{c}` {t}" for c, t in columns)))
    assert chosen([("duration_ms", "int"), ("genre_pop", "int"), ("tempo", "double"), ("energy", "double"),
                   ("genre_art", "int"), ("release_year", "int"), ("genre_text", "string"), ("other", "int")]) == [
        "energy", "tempo", "genre_pop", "genre_art", "release_year", "duration_ms"]
    assert chosen([("id", "long"), ("b", "int"), ("a", "double"), ("playlist_id", "int")]) == ["b", "a"]
    for choose in (schema.training_features, schema.evaluation_features):
        with pytest.raises(ValueError):
            choose(spark.createDataFrame([], "id long, name string"))


def test_strip_and_labels(spark):
    df = spark.createDataFrame([("\t a b\n",), (" x\x1c",), ("\n \r\n",), ("",), (None,)], "t string")
    got = df.select(strip(F.col("t")).alias("s"), is_blank(F.col("t")).alias("b"),
                    track_label(F.col("t"), F.lit(None).cast("string")).alias("l")).collect()
    assert [r["s"] for r in got] == ["a b", "x", "", "", None]
    assert [r["b"] for r in got] == [False, False, True, True, True]
    assert got[4]["l"] == "**** by "


def test_excluded_item_leaves_scores_alone(spark):
    rng = np.random.default_rng(5)
    items = spark.createDataFrame([(f"t{i}", f"n{i}", f"a{i % 3}", float(i), [float(x) for x in rng.normal(size=4)])
                                   for i in range(40)], "id string, name string, artists string, popularity double, vec array<double>")
    by_id = rec.hybrid_by_id(items, None, 5, candidate_multiplier=2)
    asked = items.select(F.col("id").alias("qid"), F.col("id").alias("exclude_id"), "vec")
    by_vector = rec.hybrid_by_vector(items, asked, 5, candidate_multiplier=2)
    columns = ["qid", "rank", "id", "final_score", "sim_score"]
    assert sorted(map(tuple, by_id.select(*columns).collect())) == sorted(map(tuple, by_vector.select(*columns).collect()))


@pytest.mark.parametrize("slack", [0.0, 0.1])
def test_ranks_outside_their_brackets(spark, monkeypatch, slack):
    monkeypatch.setattr(quantiles, "SKETCH", 8)
    monkeypatch.setattr(quantiles, "SLACK", slack)
    values = np.random.default_rng(2).normal(size=4000)
    df = spark.createDataFrame([(float(v), i % 2) for i, v in enumerate(values)], "v double, k int")
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]
    row = exact_quantiles(df, ["v"], probs).first()
    assert np.allclose([row[f"q{i}"] for i in range(len(probs))], np.quantile(values, probs))
    for row in exact_quantiles(df, ["v"], [0.3], "k").collect():
        assert np.isclose(row["q0"], np.quantile(values[row["k"]::2], 0.3))


def test_boxes_of_another_label(spark):
    df = spark.createDataFrame([(f"g{i % 7}", float(i % 11)) for i in range(300)] + [(None, 1.0)], "genre string, v double")
    assert {r["genre"] for r in profile.box_summary(df, ["v"], "genre").collect()} == {f"g{i}" for i in range(7)}


@pytest.mark.parametrize("how", ["inner", "left"])
def test_missing_keys_and_many_hot_keys(spark, monkeypatch, how):
    rows = [(i, None if i % 10 < 3 else i % 20) for i in range(2000)]
    left = spark.createDataFrame(rows, "i int, k int").repartition(5)
    right = spark.createDataFrame([(k, f"r{k}") for k in range(0, 20, 3)] + [(None, "none")], "k int, name string")
    want = sorted(map(tuple, left.join(right, "k", how).select("i", "k", "name").collect()), key=str)
    for few in (True, False):
        monkeypatch.setattr(joins, "fits_broadcast", lambda df, few=few: few)
        got = joins.salted_join(left, right, "k", how, ["i"], rows_per_salt=10).select("i", "k", "name")
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_positions_over_many_ranges(spark):
    df = spark.createDataFrame([(i * 7 % 1000,) for i in range(1000)], "v int").repartition(4)
    got = ordering.with_position(df, "v", "at", rows_per_bucket=30).collect()
    assert sorted((r["v"], r["at"]) for r in got) == [(i, i) for i in range(1000)]


def test_query_gram_join_equals_top_k(spark):
    items = spark.createDataFrame([(i, t) for i, t in enumerate(["red apple", "green apple", "blue sky", "skyline"])], "id int, text string")
    queries = spark.createDataFrame([("a", "apple"), ("b", "sky red"), ("c", "zzz")], "qid string, text string")
    grams = tfidf.counted_grams(items)
    idf = tfidf.fit_idf(items, grams=grams)
    rows = tfidf.vectors(items, idf, grams=grams)
    joined = {(r["qid"], r["id"]): r["score"] for r in tfidf.query_gram_join(rows, queries, idf).collect()}
    top = {(r["qid"], r["id"]): r["score"] for r in tfidf.tfidf_top_k(rows, queries, idf, 10).collect()}
    assert joined.keys() == top.keys() and all(np.isclose(joined[k], top[k]) for k in top)


def test_network_tables(spark):
    layers = learning.demo_layers(4, 3, (5,))
    back = learning.read_layers(learning.layers_table(spark, layers))
    for a, b in zip(layers, back):
        assert a.keys() == b.keys()
        assert all(np.array_equal(a[k], b[k]) if k != "activation" else a[k] == b[k] for k in a)
    items = spark.createDataFrame([(1, [1.0, 2.0, 3.0, 4.0]), (2, [0.0] * 4)], "id int, vec array<double>")
    got = learning.embed_items(items, back).collect()
    assert all(np.isclose(np.linalg.norm(r["embedding"]), 1) for r in got)
