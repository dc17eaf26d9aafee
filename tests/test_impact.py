"""Top-k of sparse vectors over postings in bands, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadenza.operators import impact, tfidf
from cadenza.operators.impact import ImpactIndex, ImpactSearch
from cadenza.session import write_and_read

WORDS = [f"w{i}" for i in range(40)]
ROWS = "grams array<string>, weights array<double>"


def vectors(seed, n, p):
    rng = np.random.default_rng(seed)
    out = []
    for i in range(n):
        have = [w for j, w in enumerate(WORDS) if rng.random() < p * 8 / (j + 4)]
        raw = np.round(rng.random(len(have)), 1) + 0.1
        out.append((i, have, (raw / np.linalg.norm(raw)).tolist() if have else []))
    return out


def brute(items, g, w, k):
    q = dict(zip(g, w))
    scored = [(round(sum(q.get(a, 0) * b for a, b in zip(gi, wi)), 9), i) for i, gi, wi in items]
    return [i for s, i in sorted(scored, key=lambda t: (-t[0], t[1])) if s > 0][:k]


def ranks(df, key="q"):
    out = {}
    for r in df.orderBy(key, "rank").collect():
        out.setdefault(r[key], []).append(r["id"])
    return out


@pytest.mark.parametrize("cells", [1_000_000, 50])
def test_against_brute_force(spark, monkeypatch, cells):
    monkeypatch.setattr(impact, "CELLS", cells)
    items = vectors(1, 200, 0.3)
    items += [(1000 + i, *items[3][1:]) for i in range(30)]  # a large class of equal vectors
    queries = vectors(2, 25, 0.3) + [(99, ["unknown"], [1.0]), (98, ["unknown", "w0"], [0.1, 0.9]), (97, *items[3][1:])]
    index = ImpactIndex.of_vectors(spark.createDataFrame(items, "id int, " + ROWS))
    asked = write_and_read(spark.createDataFrame(queries, "q int, " + ROWS), "t")
    for k in (1, 6, 300):
        got = ranks(ImpactSearch(index, asked, k).top())
        assert got == {q: best for q, g, w in queries if (best := brute(items, g, w, k))}


def test_bands_below_the_floor_are_not_read(spark):
    items = vectors(3, 2000, 0.3)
    index = ImpactIndex.of_vectors(spark.createDataFrame(items, "id int, " + ROWS))
    asked = write_and_read(spark.createDataFrame([(i, g, w) for i, g, w in items[:60] if g], "q int, " + ROWS), "t")
    search = ImpactSearch(index, asked, 3)
    read = search.blocks_read().agg(F.sum("bands_read"), F.sum("bands"), F.sum("postings_read"), F.sum("postings")).first()
    assert read[0] < 0.7 * read[1] and read[2] < 0.8 * read[3]
    assert ranks(search.top()) == {i: brute(items, g, w, 3) for i, g, w in items[:60] if g}


def test_index_of_texts_equals_that_of_vectors(spark):
    texts = [(i, t) for i, t in enumerate(["blue steel", "Blue steel", "steel", "green tin", "blue steel", None, "", "a b", "b a"] * 4)]
    items = spark.createDataFrame(texts, "id int, text string")
    queries = spark.createDataFrame([(1, "steel"), (2, "blue"), (3, "steel"), (4, "zzz"), (5, None), (6, "")], "qid int, text string")
    index, idf = tfidf.fit_index(items)
    counted = tfidf.counted_grams(items)
    assert {r["gram"]: round(r["idf"], 9) for r in idf.collect()} == {
        r["gram"]: round(r["idf"], 9) for r in tfidf.fit_idf(items, grams=counted).collect()}
    rows = tfidf.vectors(items, idf, grams=counted)
    one = ranks(tfidf.tfidf_top_k(items, queries, idf, 5, index=index), "qid")
    assert one == ranks(tfidf.tfidf_top_k(rows, queries, idf, 5), "qid")
    assert set(one) == {1, 2, 3} and one[1] == one[3]


def test_empty_sides(spark):
    none = spark.createDataFrame([], "id int, text string")
    some = spark.createDataFrame([(1, "blue")], "id int, text string")
    for items, queries in ((none, some), (some, none)):
        index, idf = tfidf.fit_index(items)
        assert tfidf.tfidf_top_k(items, queries.withColumnRenamed("id", "qid"), idf, 3, index=index).count() == 0


@pytest.mark.parametrize("asked_rows", [200_000, 3])
def test_few_queries_scan_the_texts(spark, monkeypatch, asked_rows):
    monkeypatch.setattr(tfidf, "ASKED_ROWS", asked_rows)
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(WORDS, 30)) for _ in range(60)]
    texts += texts[:20] + [None, " "]
    items = spark.createDataFrame(list(enumerate(texts)), "id bigint, text string")
    queries = spark.createDataFrame([("a", texts[0]), ("b", "w1 w30"), ("c", "w1 w30"), ("d", "zz"), ("e", None)], "qid string, text string")
    index, idf = tfidf.fit_index(items)
    wanted = tfidf.tfidf_top_k(items, queries, idf, 4, index=index).collect()
    written = []
    monkeypatch.setattr(tfidf, "write_and_read", lambda df, name: written.append(name) or write_and_read(df, name))
    got = tfidf.scan_top_k(items, queries, 4)
    rows = lambda of: sorted((r["qid"], r["rank"], r["id"], round(r["score"], 9)) for r in of)
    assert rows(got.collect()) == rows(wanted) and len(wanted) == 12
    # no table of postings unless the queries are too many to travel
    assert ("gram-counts" in written) == (asked_rows == 3)
