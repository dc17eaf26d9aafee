"""Offline metrics and training data against plain numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import evaluate as ev, learning as ml
from cadenza.plans.catalog import build_profile_examples
from cadenza.schema import choose_profile_column, evaluation_features, training_features

ROWS = [("a", "A", "one", "chill", 0.1, 0.2, 0.3, 20), ("b", "B", "two", "chill", 0.15, 0.25, 0.35, 25),
        ("c", "C", "three", "party", 0.9, 0.95, 0.8, 80), ("d", "D", "four", "party", 0.85, 0.9, 0.75, 75),
        ("e", "E", "five", "focus", 0.4, 0.3, 0.5, 40), ("f", "F", "six", "focus", 0.45, 0.35, 0.55, 45)]
SCHEMA = "track_id string, name string, artist_names string, mood_label string, danceability double, energy double, valence double, popularity int"


@pytest.fixture(scope="module")
def six(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def test_evaluate_six_rows(six):
    r = ev.evaluate(six, k=1, sample_size=6).first()
    assert r["n_rows"] == 6 and r["feature_count"] == 4 and r["label_column"] == "mood_label"
    # the nearest row of each is its twin
    assert r["precision_at_k"] == r["recall_at_k"] == r["map_at_k"] == r["ndcg_at_k"] == 1.0
    assert r["artist_diversity"] == 1.0 and r["catalog_coverage"] == 1.0


def test_metrics_by_hand(six):
    k = 3
    recs = ev.recommendations(six, k, 6).collect()
    got = {r["qid"]: r for r in ev.query_metrics(six, ev.recommendations(six, k, 6), k).collect()}
    lists = {}
    for r in sorted(recs, key=lambda r: r["rank"]):
        lists.setdefault(r["qid"], []).append(r["rel"])
    for qid, rel in lists.items():
        hits = np.cumsum(rel)
        assert got[qid]["precision"] == pytest.approx(sum(rel) / k)
        assert got[qid]["recall"] == pytest.approx(sum(rel) / 1)
        assert got[qid]["average_precision"] == pytest.approx(sum(h / (i + 1) for i, (h, x) in enumerate(zip(hits, rel)) if x) / k)
        assert got[qid]["ndcg"] == pytest.approx(sum(x / math.log2(i + 2) for i, x in enumerate(rel)))


def test_no_labelled_seed_gives_zeros(six):
    r = ev.evaluate(six.withColumn("mood_label", F.lit(None).cast("string")), k=2, sample_size=6).first()
    assert [r[c] for c in ("precision_at_k", "recall_at_k", "map_at_k", "ndcg_at_k", "catalog_coverage", "artist_diversity")] == [0.0] * 6


def test_no_artist_column(six):
    assert ev.evaluate(six.drop("artist_names"), k=1, sample_size=6).first()["artist_diversity"] == 1.0


def test_single_row_label_has_no_ideal(six):
    lone = six.withColumn("mood_label", F.when(F.col("track_id") == "a", F.lit("alone")).otherwise(F.lit("rest")))
    got = {r["qid"]: r for r in ev.query_metrics(lone, ev.recommendations(lone, 2, 6), 2).collect()}
    assert got["a"]["ndcg"] == 0.0 and got["a"]["recall"] == 0.0


def test_feature_choice(six):
    assert evaluation_features(six) == ["danceability", "energy", "valence", "popularity"]
    assert training_features(six) == ["danceability", "energy", "valence", "popularity"]
    with pytest.raises(ValueError):
        evaluation_features(six.select("track_id"))
    assert choose_profile_column(six.withColumn("playlist_id", F.lit("p"))) == "mood_label"
    with pytest.raises(ValueError):
        choose_profile_column(six.select("track_id"))


def test_profile_examples(six, spark):
    lone = six.unionByName(spark.createDataFrame([("g", "G", "x", "solo", 0.5, None, float("inf"), 1)], SCHEMA))
    features = ["danceability", "energy", "valence", "popularity"]
    ex, params = ml.profile_examples(lone, "mood_label", features, "track_id")
    rows = ex.collect()
    x = np.array([[r[4], r[5] or 0.0, r[6] if math.isfinite(r[6]) else 0.0, r[7]] for r in ROWS + [("g", "", "", "solo", 0.5, None, float("inf"), 1)]])
    z = (x - x.mean(0)) / x.std(0)
    ids = [r[0] for r in ROWS] + ["g"]
    for r in rows:
        i = ids.index(r["track_id"])
        assert np.allclose(r["item_vec"], z[i])
        if r["profile"] == "solo":
            assert r["user_vec"] == r["item_vec"]
        else:
            group = [ids.index(q["track_id"]) for q in rows if q["profile"] == r["profile"]]
            # item + (n - 1) * user = sum of the group
            assert np.allclose(np.array(r["item_vec"]) + (len(group) - 1) * np.array(r["user_vec"]), z[group].sum(0))
    assert params.first()["scale_danceability"] == pytest.approx(x[:, 0].std())


def test_profile_job(six):
    examples, _, summary = build_profile_examples(six)
    s = summary.first()
    assert (s["n_rows"], s["n_profiles"], s["n_features"], s["profile_column"]) == (6, 3, 4, "mood_label")
    assert examples.count() == 6


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(250):
        v = [rng.normal(size=5) for _ in range(2)]
        rows.append((i, *[[float(a) for a in x / np.linalg.norm(x)] for x in v]))
    return spark.createDataFrame(rows, "id int, z1 array<double>, z2 array<double>")


def test_batches(many):
    whole = ml.training_batches(many, 64, drop_remainder=True)
    sizes = {r["batch_id"]: r["count"] for r in whole.groupBy("batch_id").count().collect()}
    assert sizes == {0: 64, 1: 64, 2: 64}
    rest = {r["batch_id"]: r["count"] for r in ml.training_batches(many, 64).groupBy("batch_id").count().collect()}
    assert rest == {0: 64, 1: 64, 2: 64, 3: 58}


def test_contrastive_loss(many):
    batches = ml.training_batches(many, 100)
    rows = batches.collect()
    for r in ml.contrastive_loss(batches).collect():
        mine = [b for b in rows if b["batch_id"] == r["batch_id"]]
        z = np.array([b["z1"] for b in mine] + [b["z2"] for b in mine])
        s = z @ z.T / 0.07
        n = len(mine)
        losses = []
        for i in range(2 * n):
            others = np.delete(s[i], i)
            losses.append(np.log(np.exp(others - others.max()).sum()) + others.max() - s[i, (i + n) % (2 * n)])
        assert r["loss"] == pytest.approx(np.mean(losses)) and r["n"] == n


def test_retrieval_loss(many):
    batches = ml.training_batches(many.withColumnsRenamed({"z1": "user_vec", "z2": "item_vec"}), 100)
    rows = batches.collect()
    for r in ml.retrieval_loss(batches).collect():
        mine = [b for b in rows if b["batch_id"] == r["batch_id"]]
        s = np.array([b["user_vec"] for b in mine]) @ np.array([b["item_vec"] for b in mine]).T
        assert r["loss"] == pytest.approx((np.log(np.exp(s).sum(1)) - np.diag(s)).sum())


def test_views_add_noise_of_the_given_size(many):
    got = ml.augmented_views(many, "z1", 5).collect()
    noise = np.array([np.array(r[v]) - np.array(r["z1"]) for r in got for v in ("view1", "view2")])
    assert abs(noise.mean()) < 0.02 and noise.std() == pytest.approx(0.15, rel=0.1)
    assert not np.allclose(noise[0], noise[1])


@pytest.mark.parametrize("activation", ["elu", "relu"])
def test_embedding_network(many, activation):
    layers = ml.demo_layers(5, 4, (8, 6), activation)
    got = {r["id"]: r["embedding"] for r in ml.embed_items(many.select("id", F.col("z1").alias("vec")), layers).collect()}
    for r in many.collect():
        x = np.array(r["z1"])
        for layer in layers:
            x = x @ layer["weights"] + layer["bias"]
            if "activation" in layer:
                x = np.where(x > 0, x, np.exp(x) - 1 if activation == "elu" else 0.0)
                x = x / math.sqrt(1 + 1e-3)
        assert np.allclose(got[r["id"]], x / np.linalg.norm(x))
        assert np.linalg.norm(got[r["id"]]) == pytest.approx(1.0)
