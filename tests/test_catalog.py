"""Ingest, cleaning, profiling and files on small edge-case tables."""

import json
import os
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import clean, genres, ingest, profile
from cadenza.plans import catalog
from cadenza.schema import keep_listed, normalize_schema, numeric_columns, rename_columns, similarity_features
from cadenza.session import scratch_path, shared_dir
from cadenza.sources import readers, writers

PAGES = [
    {"playlist_id": "p1", "page_no": 0, "items": [
        {"track": {"id": "t1", "name": "One", "popularity": 10, "artists": [{"id": "a1", "name": "A"}, {"id": None, "name": "B"}, {"id": "a2", "name": ""}],
                   "album": {"name": "Al", "release_date": "1999-01-01"}}},
        {"track": None}, {"track": {"id": None, "name": "x"}}, {"track": {"id": "", "name": "x"}}]},
    {"playlist_id": "p1", "page_no": 1, "items": [{"track": {"id": "t2", "artists": [], "album": None}}]},
    {"playlist_id": "p2", "page_no": 0, "items": [{"track": {"id": "t1", "name": "Again"}}, {"track": {"id": "t3", "name": "Three", "artists": [{"id": "zz", "name": "Z"}]}}]},
]


@pytest.fixture(scope="module")
def items(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("pages") / "pages.json"
    path.write_text("\n".join(json.dumps(p) for p in PAGES))
    return readers.read_playlist_pages(spark, str(path))


def test_pages(items):
    assert sorted((r["playlist_id"], r["page_no"], r["pos"], r["track"]["id"]) for r in items.collect()) == [
        ("p1", 0, 0, "t1"), ("p1", 1, 0, "t2"), ("p2", 0, 0, "t1"), ("p2", 0, 1, "t3")]


def test_flatten(items):
    rows = {(r["playlist_id"], r["track_id"]): r for r in ingest.flatten_tracks(items, keep=("playlist_id",)).collect()}
    one, two = rows[("p1", "t1")], rows[("p1", "t2")]
    assert one["artist_ids"] == ["a1", "a2"] and one["artist_names"] == ["A", "B"] and one["album"] == "Al"
    assert two["artist_ids"] == [] and (two["name"], two["album"], two["release_date"], two["popularity"]) == ("", "", "", 0)


def test_collect(spark, items):
    audio = spark.createDataFrame([("t1", 0.9, 0.9, 130.0), (None, 0.1, 0.1, 1.0), ("other", 0.1, 0.1, 1.0)],
                                  "id string, energy double, danceability double, tempo double")
    artists = spark.createDataFrame(
        [("a1", ["rock", "oldies"], (5,), 7), ("a2", [], None, None)],
        "id string, genres array<string>, followers struct<total:bigint>, popularity int")
    rows = {r["track_id"]: r for r in catalog.collect_catalog(items, audio, artists, {"p1": "", "p2": "sad"}).collect()}
    assert set(rows) == {"t1", "t2", "t3"}
    assert rows["t1"]["name"] == "One" and rows["t1"]["mood_label"] == "party"
    assert rows["t1"]["primary_genre"] == "rock" and rows["t1"]["all_genres"] == "rock; oldies; "
    assert rows["t1"]["artist_followers"] == 5 and rows["t1"]["artist_popularity"] == 7
    assert rows["t2"]["all_genres"] == "" and rows["t2"]["artist_followers"] is None and rows["t2"]["mood_label"] == "neutral"
    assert rows["t3"]["mood_label"] == "sad" and rows["t3"]["energy"] is None
    first = {r["track_id"]: r for r in catalog.collect_catalog(items, audio, artists, {"p2": "sad", "p1": "party"}).collect()}
    assert first["t1"]["name"] == "Again" and first["t1"]["mood_label"] == "sad"


def test_playlist_labels(items):
    labelled = ingest.label_by_playlist(items, {"p1": "party"})
    assert {(r["playlist_id"], r["mood_label"]) for r in labelled.collect()} == {("p1", "party"), ("p2", None)}


def test_preprocess(spark):
    rows = [("a", "A", "x", "pop; k-pop", "1990-01-01", "SAD", 1.0, 10, 0), ("a", "dup", "x", "pop", "1990", "sad", 9.0, 10, 1),
            ("b", None, None, None, "1800", None, None, 20, 2), ("c", "C", "z", "rock", "2010", "odd", 3.0, 30, 3)]
    df = spark.createDataFrame(rows, "track_id string, name string, artist_names string, all_genres string, release_date string, "
                                     "mood_label string, energy double, popularity int, ingest_seq int")
    out, params = catalog.preprocess(df)
    got = {r["track_id"]: r for r in out.collect()}
    assert set(got) == {"a", "b", "c"} and got["b"]["name"] == "Unknown" and got["b"]["all_genres"] == "Unknown"
    assert [got[i]["mood_label"] for i in "abc"] == ["sad", "neutral", "neutral"]
    # energy 1, 2 (median), 3 and year 1990, 2000 (median), 2010, both standardized; popularity kept
    for c in ("energy", "release_year"):
        assert np.allclose([got[i][c] for i in "abc"], [-np.sqrt(1.5), 0.0, np.sqrt(1.5)])
    assert [got[i]["popularity"] for i in "abc"] == [10.0, 20.0, 30.0]
    assert {c for c in out.columns if c.startswith("genre_")} == {"genre_pop", "genre_k-pop", "genre_rock"}
    assert "scale_energy" in params.columns
    with pytest.raises(ValueError):
        clean.scale(df, "other")


def test_constant_and_all_missing_columns(spark):
    df = spark.createDataFrame([(1.0, None, 2.0), (1.0, None, None)], "c double, n double, m double")
    assert [r["c"] for r in clean.scale(df)[0].collect()] == [0.0, 0.0]
    filled = clean.impute(df)
    assert [(r["n"], r["m"]) for r in filled.collect()] == [(None, 2.0), (None, 2.0)]
    frequent = spark.createDataFrame([(3.0,), (1.0,), (None,), (3.0,), (1.0,)], "x double")
    assert clean.most_frequent(frequent, ["x"]).first()["x"] == 1.0


def test_multi_hot_modes(spark):
    df = spark.createDataFrame([("k-pop; rock",), ("pop",), (None,)], "all_genres string")
    assert [r["genre_pop"] for r in genres.multi_hot(df, genres=["pop"]).collect()] == [1, 1, 0]
    assert [r["genre_pop"] for r in genres.multi_hot(df, genres=["pop"], match="token").collect()] == [0, 1, 0]
    assert genres.multi_hot(df.drop("all_genres").withColumn("x", F.lit(1))).columns == ["x"]


def test_schema_helpers(spark):
    df = spark.createDataFrame([("a", "n", "g", 1, 2.0)], "track_id string, track_name string, track_genre string, key int, other double")
    assert keep_listed(rename_columns(df)).columns == ["id", "name", "genres", "key"]
    assert numeric_columns(df) == ["key", "other"]
    assert normalize_schema(df).columns == ["id", "track_name", "track_genre", "key", "other", "name"]
    assert similarity_features(df.withColumn("genre_pop", F.lit(1))) == ["genre_pop", "artist_popularity", "popularity"]


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(400, 3))
    x[:, 2] = x[:, 0] * 2 + rng.normal(size=400) * 0.1
    rows = [(str(i), "sad" if i % 3 else "chill", *[float(v) for v in r]) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id string, mood_label string, energy double, valence double, tempo double"), x


def test_principal_components(numbers):
    df, x = numbers
    coords, ratios = profile.principal_components(df, ["energy", "valence", "tempo"])
    z = (x - x.mean(0)) / x.std(0)
    values, vecs = np.linalg.eigh(np.cov(z.T))
    assert np.allclose(ratios, (values / values.sum())[::-1][:2])
    assert ratios == sorted(ratios, reverse=True)
    got = np.array([[r["pc1"], r["pc2"]] for r in sorted(coords.collect(), key=lambda r: int(r["id"]))])
    for i in range(2):
        v = vecs[:, -1 - i]
        v = v if v[abs(v).argmax()] > 0 else -v
        assert np.allclose(got[:, i], z @ v)


def test_histogram_is_numpys(numbers, spark):
    df, x = numbers
    rows = profile.histogram(df, ["energy"], 50).orderBy("bin").collect()
    counts, edges = np.histogram(x[:, 0], 50)
    assert [r["n"] for r in rows] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in rows], edges[:-1])
    flat = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), ["v"], 4).orderBy("bin").collect()
    assert [r["n"] for r in flat] == np.histogram([2.0, 2.0], 4)[0].tolist()


def test_box_and_correlation(numbers):
    df, x = numbers
    r = {(a["mood_label"], a["feature"]): a for a in profile.box_summary(df, ["energy"]).collect()}[("chill", "energy")]
    mine = x[::3, 0]
    q1, q2, q3 = np.quantile(mine, [0.25, 0.5, 0.75])
    near = mine[(mine >= q1 - 1.5 * (q3 - q1)) & (mine <= q3 + 1.5 * (q3 - q1))]
    assert np.allclose([r["q1"], r["median"], r["q3"], r["whisker_low"], r["whisker_high"]], [q1, q2, q3, near.min(), near.max()])
    assert r["n_outliers"] == len(mine) - len(near)
    c = {(a["feature_a"], a["feature_b"]): a["r"] for a in profile.correlations(df, ["energy", "valence", "tempo"]).collect()}
    assert c[("tempo", "energy")] == pytest.approx(np.corrcoef(x.T)[2, 0]) and len(c) == 3
    with pytest.raises(ValueError):
        profile.correlations(df, ["energy"])


def test_report_has_all_tables(numbers):
    df, _ = numbers
    report = catalog.profile_report(df)
    assert set(report) == {"moods", "describe", "valence_histogram", "correlations", "boxes", "components"}
    assert all(t.count() > 0 for t in report.values())


def test_index_round_trip_and_fallback(spark, numbers):
    df, x = numbers
    raw, broken = scratch_path(spark, "raw"), scratch_path(spark, "broken")
    catalog.build_vector_tables(df.withColumn("popularity", F.lit(1.0)), raw)
    tables, kind = readers.load_index_or_fallback(spark, scratch_path(spark, "missing"), raw)
    assert kind == "raw" and tables["vectors"].count() == 400 and tables["feature_stats"].count() == 1
    for name in ("vectors", "items", "feature_stats"):
        os.makedirs(f"{broken}/{name}")
        with open(f"{broken}/{name}/part-0.parquet", "wb") as f:
            f.write(b"not a table")
    assert readers.load_index_or_fallback(spark, broken, raw)[1] == "raw"
    assert readers.load_index_or_fallback(spark, raw, raw)[1] == "learned"
    assert set(readers.index_items(tables).columns) >= {"id", "vec", "energy"}


def test_csv_lists_and_suffix(spark):
    df = spark.createDataFrame([("a", ["x", "y"], 'say "hi", you')], "id string, l array<string>, t string")
    flat, cols = scratch_path(spark, "flat") + ".csv", scratch_path(spark, "cols") + ".parquet"
    writers.write_csv(df, flat)
    writers.write_parquet(df, cols)
    assert readers.read_table(spark, flat).collect() == [("a", "x; y", 'say "hi", you')]
    assert readers.read_table(spark, cols).first()["l"] == ["x", "y"]


def test_metric_names(spark):
    report = spark.createDataFrame([(6, 0.5)], "n_rows int, precision_at_k double")
    path = scratch_path(spark, "metrics")
    writers.write_metrics(report, 3, path)
    assert spark.read.json(path).first().asDict() == {"rows": 6, "precision@3": 0.5}


def test_nan_becomes_missing(spark):
    path = scratch_path(spark, "nan")
    spark.createDataFrame([(float("nan"), 1.0)], "a double, b double").write.parquet(path)
    assert readers.read_parquet(spark, path).first().asDict() == {"a": None, "b": 1.0}


def test_shared_dir_where_the_setting_is_missing():
    def session(master):
        return SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master=master, applicationId="test-app"))

    own = shared_dir(session("local[2]"))
    assert os.path.isdir(own) and shared_dir(session("local[2]")) == own
    with pytest.raises(ValueError):
        shared_dir(session("spark://host:7077"))


def test_shared_dir_is_the_sessions(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark))
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
