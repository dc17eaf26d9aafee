"""Routing and results of batch search on tiny catalogs."""

import pytest

from cadenza.operators.clean import zscore
from cadenza.plans import search as plan
from cadenza.schema import FEATURES9

ROWS = [
    ("1", "Blinding Lights", "The Weeknd", -0.2, 0.5, 0.0, 0.8, -0.5, -1.2, -1.0, 0.2, 0.5),
    ("2", "Heat Waves", "Glass Animals", 0.1, 0.3, 0.2, -0.3, -0.6, -0.8, -0.9, 0.1, 0.3),
    ("3", "Good as Hell", "Lizzo", 1.2, 1.0, 1.5, 0.5, -0.3, -1.5, -1.2, 0.3, 0.8),
]


@pytest.fixture(scope="module")
def index(spark):
    df = spark.createDataFrame(ROWS, "id string, name string, artists string, " + ", ".join(f"{c} double" for c in FEATURES9))
    return plan.build_search_index(df)


def ask(spark, *texts):
    return spark.createDataFrame([(t, t) for t in texts], "qid string, text string")


@pytest.fixture(scope="module")
def results(spark, index):
    asked = ask(spark, "Blinding Lights", "blinding", "heat wavs", "  ", "gym workout", "jj qq", "chil")
    found = plan.search(index, asked, 2)
    return asked, found, found.orderBy("qid", "rank").collect()


def rows_of(results, qid):
    return [r for r in results[2] if r["qid"] == qid]


def test_exact_name_ranks_first(results):
    r = rows_of(results, "Blinding Lights")
    assert r[0]["name"] == "Blinding Lights" and r[0]["mode"] == "tfidf"
    assert r[0]["label"] == "**Blinding Lights** by The Weeknd"


def test_partial_and_misspelt_names(results):
    assert rows_of(results, "blinding")[0]["name"] == "Blinding Lights"
    assert rows_of(results, "heat wavs")[0]["name"] == "Heat Waves"


def test_modes(results):
    asked, found, _ = results
    modes = {r["qid"]: (r["mode"], r["label"]) for r in plan.query_modes(asked, found).collect()}
    assert modes["  "] == ("none", "Empty query")
    assert modes["gym workout"] == ("vibe", "Vibe: *Gym Workout*")
    assert modes["chil"] == ("vibe", "Vibe: *Chil*")
    assert modes["jj qq"][0] == "fuzzy"
    assert len(rows_of(results, "jj qq")) == 2


def test_vibe_scores_are_rescaled(results):
    scores = [r["_search_score"] for r in rows_of(results, "gym workout")]
    assert scores == sorted(scores, reverse=True) and all(0 <= s <= 1 for s in scores)


def test_recommend_after_search(spark, index):
    got = plan.search_and_recommend(index, ask(spark, "Blinding Lights", "party banger"), 2)
    by = {}
    for r in got.orderBy("qid", "rank").collect():
        by.setdefault(r["qid"], []).append(r)
    assert all(r["seed_id"] == "1" and r["id"] != "1" and r["recommended"] for r in by["Blinding Lights"])
    assert len(by["Blinding Lights"]) == 2
    assert all(not r["recommended"] and r["mode"] == "vibe" for r in by["party banger"])


def test_seed_missing_from_items_keeps_search_rows(spark, index):
    got = plan.search_and_recommend(index, ask(spark, "Blinding Lights"), 2, items=index.items.filter("id <> '1'")).collect()
    assert got and all(not r["recommended"] and r["mode"] == "tfidf" for r in got)
    assert {r["id"] for r in got if r["rank"] == 1} == {"1"}


def test_service_engines(spark, index):
    learned = index.items.filter("id <> '2'").select("id", "name", "artists", "popularity", "vec")
    got = plan.search_service(index, ask(spark, "Blinding Lights", "heat waves", "party banger"), 2, learned)
    engines = {r["qid"]: (r["engine_name"], r["mode"]) for r in got.collect()}
    assert engines == {"Blinding Lights": ("two-tower hybrid", "hybrid"), "heat waves": ("FAISS fallback", "tfidf"),
                       "party banger": ("FAISS", "vibe")}
    plain = plan.search_service(index, ask(spark, "heat waves"), 2)
    assert {r["engine_name"] for r in plain.collect()} == {"FAISS"}


def test_recent_searches(spark):
    rows = [(1, i, i, t) for i, t in enumerate(["a", "B", "b ", "c", " ", "d", "e", "f", "A"])] + [(2, 1, 1, "x")]
    got = plan.recent_searches(spark.createDataFrame(rows, "user_id int, ts int, seq int, query string"))
    lists = {}
    for r in got.orderBy("user_id", "rank").collect():
        lists.setdefault(r["user_id"], []).append(r["query"])
    assert lists == {1: ["A", "f", "e", "d", "c"], 2: ["x"]}


def test_zscore_uses_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    assert [round(r["x"], 6) for r in zscore(df, ["x"], "sample").orderBy("x").collect()] == [-1.0, 0.0, 1.0]
    assert [round(r["x"], 4) for r in zscore(df, ["x"]).orderBy("x").collect()] == [-1.2247, 0.0, 1.2247]


def test_phrases_start_no_python_worker(spark):
    from cadenza.queries.base import searches
    plan = searches(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Scan ExistingRDD" not in plan and "LogicalRDD" not in plan


def test_gram_join_gives_all_pairs(spark):
    from cadenza.operators import tfidf
    items = spark.createDataFrame([(i, "blue steel" if i % 3 else "dark moon") for i in range(90)], "id int, text string")
    asked = spark.createDataFrame([(1, "steel"), (2, "zzz"), (3, "moon steel")], "qid int, text string")
    grams = tfidf.counted_grams(items)
    idf = tfidf.fit_idf(items, grams=grams)
    got = tfidf.query_gram_join(tfidf.vectors(items, idf, grams=grams), asked, idf)
    assert {r["qid"]: r["count"] for r in got.groupBy("qid").count().collect()} == {1: 60, 3: 90}
    from __spark_entry__ import oracle_sql
    assert "rank <=" not in oracle_sql()["j08_query_gram_join"]


def test_long_texts_are_counted_in_more_tasks(spark, monkeypatch):
    from cadenza.operators import tfidf
    monkeypatch.setattr(tfidf, "TASK_BYTES", 100)
    texts = spark.createDataFrame([(i % 190, f"blue steel {i} blue") for i in range(200)] + [(None, None)], "id int, text string")
    grams = tfidf.gram_counts(texts)
    assert grams.rdd.getNumPartitions() > 30
    assert grams.filter("id = 3 AND gram = ' bl'").first()["tf"] == 4
