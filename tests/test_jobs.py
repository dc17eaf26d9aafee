"""The command line, end to end: collect, preprocess, then everything that reads the result."""

import json

import numpy as np
import pytest

from cadenza.jobs import main

GENRES = ["rock", "pop", "jazz", "oldies"]


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("jobs")
    rng = np.random.default_rng(4)
    tracks = [{"track": {"id": f"t{i}", "name": f"Song {i % 30} take {i}", "popularity": int(rng.integers(1, 99)),
                         "artists": [{"id": f"a{i % 9}", "name": f"Artist {i % 9}"}],
                         "album": {"name": "LP", "release_date": f"{1980 + i % 45}-01-01"}}} for i in range(120)]
    pages = [{"playlist_id": "P1" if n < 30 else "P2", "page_no": n, "items": tracks[n * 2:n * 2 + 2]} for n in range(60)]
    audio = [{"id": f"t{i}", **{c: float(rng.random()) for c in (
        "danceability", "energy", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness", "valence")},
        "tempo": float(60 + 100 * rng.random())} for i in range(0, 120) if i % 11]
    artists = [{"id": f"a{i}", "genres": [GENRES[i % 4]], "followers": {"total": i * 10}, "popularity": i} for i in range(8)]
    for name, rows in (("pages", pages), ("audio", audio), ("artists", artists)):
        (root / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))
    main(["collect", "--pages", f"{root}/pages.json", "--audio", f"{root}/audio.json", "--artists", f"{root}/artists.json",
          "--playlist", "sad=P1", "--playlist", "party=P2", "--output", f"{root}/collected.csv"])
    main(["collect", "--pages", f"{root}/pages.json", "--audio", f"{root}/audio.json", "--artists", f"{root}/artists.json",
          "--playlist", "sad=P1", "--playlist", "party=P2", "--rules-only", "--output", f"{root}/ruled.parquet"])
    main(["preprocess", "--input", f"{root}/collected.csv", "--output", f"{root}/clean.parquet"])
    return root


def test_collect(spark, made):
    df = spark.read.option("header", True).csv(f"{made}/collected.csv")
    assert df.count() == 120
    assert {r["mood_label"]: r["count"] for r in df.groupBy("mood_label").count().collect()} == {"sad": 60, "party": 60}
    assert spark.read.parquet(f"{made}/ruled.parquet").select("mood_label").distinct().count() > 2


def test_preprocess(spark, made):
    df = spark.read.parquet(f"{made}/clean.parquet")
    assert df.count() == 120 and df.filter("energy is null").count() == 0
    assert {"genre_rock", "genre_pop", "genre_jazz", "genre_oldies"} <= set(df.columns)


def test_preprocess_large(spark, made):
    main(["preprocess-large", "--input", f"{made}/collected.csv", "--carry", "mood_label", "--output", f"{made}/large.parquet"])
    df = spark.read.parquet(f"{made}/large.parquet")
    assert df.count() == 120 and "mood_label" in df.columns and "album" not in df.columns


def test_report_and_index(spark, made):
    main(["report", "--input", f"{made}/clean.parquet", "--output", f"{made}/report"])
    assert spark.read.option("header", True).csv(f"{made}/report/moods").count() == 2
    main(["build-index", "--input", f"{made}/clean.parquet", "--output", f"{made}/index"])
    assert spark.read.parquet(f"{made}/index/vectors").count() == 120


def test_evaluate(spark, made):
    main(["evaluate", "--data", f"{made}/clean.parquet", "--top-k", "5", "--sample-size", "50", "--output", f"{made}/metrics"])
    r = spark.read.json(f"{made}/metrics").first()
    assert r["rows"] == 120 and 0 <= r["precision@5"] <= 1 and 0 <= r["ndcg@5"] <= 1


def test_recommend_and_browse(spark, made):
    data = ["--data", f"{made}/clean.parquet"]
    main(["mood", *data, "--mood", "sad", "-n", "4", "--output", f"{made}/mood.parquet"])
    main(["similar", *data, "--name", "song 3 take 3", "-n", "4", "--output", f"{made}/similar.parquet"])
    main(["stats", *data, "--output", f"{made}/stats.parquet"])
    main(["browse", *data, "--name", "take 11", "--output", f"{made}/browse.parquet"])
    assert spark.read.parquet(f"{made}/mood.parquet").count() == 4
    similar = spark.read.parquet(f"{made}/similar.parquet")
    assert similar.count() == 4 and similar.filter("id = 't3'").count() == 0
    assert spark.read.parquet(f"{made}/stats.parquet").count() == 2
    assert [r["row_no"] for r in spark.read.parquet(f"{made}/browse.parquet").orderBy("row_no").collect()] == list(range(1, 12))


def test_search(spark, made):
    spark.createDataFrame([("1", "gym workout"), ("2", "song 3 take 3"), ("3", " ")], "qid string, text string").write.parquet(f"{made}/asked.parquet")
    main(["search", "--data", f"{made}/clean.parquet", "--queries", f"{made}/asked.parquet", "--top-k", "3",
          "--learned", f"{made}/index", "--output", f"{made}/found.parquet"])
    rows = spark.read.parquet(f"{made}/found.parquet").collect()
    assert {(r["qid"], r["mode"]) for r in rows} == {("1", "vibe"), ("2", "hybrid")}
    assert {r["seed_id"] for r in rows if r["qid"] == "2"} == {"t3"}
