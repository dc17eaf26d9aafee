"""Recommenders against a plain Python rendering of their definitions."""

import inspect

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import explain, recommend as rec
from cadenza.operators.ordering import number_results

N = 60


@pytest.fixture(scope="module")
def catalog(spark):
    rng = np.random.default_rng(5)
    rows = []
    for i in range(N):
        v = rng.normal(size=8)
        rows.append((f"t{i:02d}", f"Name {i % 20}", f"a{i % 7}", float(rng.integers(0, 100)), [float(x) for x in v / np.linalg.norm(v)], i))
    return spark.createDataFrame(rows, "id string, name string, artists string, popularity double, vec array<double>, ingest_seq int"), rows


def expected_hybrid(rows, q, k, alpha, beta, gamma, mult, skip):
    pops = [r[3] for r in rows]
    sims = sorted(((round(float(np.dot(q, r[4])), 9), r) for r in rows), key=lambda t: (-t[0], t[1][0]))
    pool = [(float(np.dot(q, r[4])), r) for _, r in sims[:k * mult + 1] if r[0] != skip]
    lo, hi = min(s for s, _ in pool), max(s for s, _ in pool)
    based = []
    for s, r in pool:
        pop = (r[3] - min(pops)) / (max(pops) - min(pops) + 1e-8)
        based.append((alpha * (s - lo) / (hi - lo) + beta * pop, r))
    based.sort(key=lambda t: (-round(t[0], 9), t[1][0]))
    seen, out = {}, []
    for base, r in based[:k]:
        bonus = 1 / (1 + seen.get(r[2], 0))
        seen[r[2]] = seen.get(r[2], 0) + 1
        out.append((r[0], round(base + gamma * bonus, 3)))
    return out


@pytest.mark.parametrize("weights", [(0.7, 0.2, 0.1, 10), (0.5, 0.3, 0.2, 2)])
def test_hybrid_by_id(catalog, weights):
    df, rows = catalog
    got = {}
    for r in rec.hybrid_by_id(df, df.select("id"), 5, *weights).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["id"], round(r["final_score"], 3)))
    for r in rows:
        want = expected_hybrid(rows, r[4], 5, *weights, r[0])
        assert [i for i, _ in got[r[0]]] == [i for i, _ in want]
        assert np.allclose([s for _, s in got[r[0]]], [s for _, s in want], atol=2e-3)


def test_hybrid_defaults():
    p = inspect.signature(rec.hybrid_by_id).parameters
    d = {k: p[k].default for k in rec.HYBRID_WEIGHTS}
    assert d == rec.HYBRID_WEIGHTS == {"alpha": 0.70, "beta": 0.20, "gamma": 0.10, "candidate_multiplier": 10}
    assert d["alpha"] + d["beta"] + d["gamma"] == pytest.approx(1.0)


def test_hybrid_by_vector_keeps_all_rows(spark, catalog):
    df, rows = catalog
    asked = spark.createDataFrame([("q", rows[3][4])], "qid string, vec array<double>")
    got = [r["id"] for r in rec.hybrid_by_vector(df, asked, 5).orderBy("rank").collect()]
    assert got == [i for i, _ in expected_hybrid(rows, rows[3][4], 5, 0.7, 0.2, 0.1, 10, None)]
    no_self = asked.withColumn("exclude_id", F.lit("t03"))
    assert "t03" not in [r["id"] for r in rec.hybrid_by_vector(df, no_self, 5).collect()]


def test_similar_by_features(catalog):
    df, rows = catalog
    got = rec.similar_by_features(df, df.select("id"), 4).filter("qid = 't10'").orderBy("rank").collect()
    q = rows[10][4]
    near = sorted(((round(float(np.dot(q, r[4])), 9), r) for r in rows if r[0] != "t10"), key=lambda t: (-t[0], t[1][0]))[:4]
    want = sorted(((0.7 * s + 0.3 * r[3] / 100, r[0]) for s, r in near), key=lambda t: (-t[0], t[1]))
    assert [r["id"] for r in got] == [i for _, i in want]
    assert np.allclose([r["final_score"] for r in got], [s for s, _ in want])


def test_similar_by_name_uses_first_row_and_skips_itself(spark, catalog):
    df, _ = catalog
    names = spark.createDataFrame([("name 3",), ("NAME 4",), ("nothing",)], "name string")
    got = rec.similar_by_name(df.select("id", "vec", "name"), df, names, 3)
    seeds = {(r["query_name"], r["seed_id"]) for r in got.collect()}
    assert seeds == {("name 3", "t03"), ("NAME 4", "t04")}
    assert got.filter("id = seed_id").count() == 0


def test_match_label(spark):
    df = spark.createDataFrame([("a", "Chill"), ("b", "chillout"), ("c", None)], "id string, mood_label string")
    ids = lambda v: sorted(r["id"] for r in rec.match_label(df, v).collect())
    assert ids("CHILL") == ["a"] and ids("hillo") == ["b"] and ids("x") == []


def test_mood_request_columns(catalog):
    df, _ = catalog
    moody = df.withColumn("primary_mood", F.lit("Happy"))
    assert {r["mood"] for r in rec.mood_request(moody, "happy").collect()} == {"Happy"}
    assert {r["mood"] for r in rec.mood_request(df, "happy").collect()} == {"Popular Tracks (Mood Column Missing)"}
    assert rec.mood_request(moody, "sad").count() == 0


def test_output_rows(spark):
    df = spark.createDataFrame([("q", None, None, 0.5)], "qid string, name string, energy double, final_score double")
    out = explain.output_rows(number_results(df, "qid", [F.col("name")]), F.lit("vibe"), F.lit("e")).first()
    assert (out["id"], out["name"], out["artist"], out["energy"], out["similarity"]) == ("1", "Unknown", "Unknown", 0.0, 0.5)
    assert out["reasons"] == ["ranked highly by the e scorer (0.500)"]
