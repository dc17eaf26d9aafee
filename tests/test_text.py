"""Text measures against plain Python."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cadenza.functions.text import TextBlock, char_grams, pair_ratio, token_sort, token_sort_ratio
from cadenza.operators import tfidf
from cadenza.operators.vibe import KEYWORDS, VIBE_KEYWORDS, VIBE_TARGETS, detect_vibe

TEXTS = ["Blinding Lights", " a  bb ccc ", "", "x", "naïve café\nnew line", "A-b c'd", "aa aa aa", "\t tab  tab"]


def grams_of(text):
    out = []
    for w in text.lower().split():
        p = f" {w} "
        out += [p[i:i + n] for n in (2, 3, 4) for i in range(len(p) - n + 1)]
    return out


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


def ratio(a, b):
    return 100.0 if not a and not b else 200.0 * common(a, b) / (len(a) + len(b))


def test_char_grams(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    for r in df.select("text", char_grams(F.col("text")).alias("g")).collect():
        assert sorted(r["g"]) == sorted(grams_of(r["text"]))


def test_gram_counts(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    got = {(r["id"], r["gram"]): r["tf"] for r in tfidf.gram_counts(df).collect()}
    want = {(i, g): n for i, t in enumerate(TEXTS) for g, n in Counter(grams_of(t)).items()}
    assert got == want


def test_tfidf_rows(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")
    rows = tfidf.vectors(df, tfidf.fit_idf(df))
    counts = [Counter(grams_of(t)) for t in TEXTS]
    df_of = Counter(g for c in counts for g in c)
    for r in rows.collect():
        raw = {g: (1 + math.log(n)) * (math.log((1 + len(TEXTS)) / (1 + df_of[g])) + 1) for g, n in counts[r["id"]].items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        assert {g: round(w, 9) for g, w in zip(r["grams"], r["weights"])} == {g: round(w / norm, 9) for g, w in raw.items()}


word = st.text(alphabet="abcdé ", max_size=12)


@settings(max_examples=60, deadline=None)
@given(st.lists(word, min_size=1, max_size=8), word)
def test_block_common_subsequence(texts, pattern):
    block = TextBlock(texts)
    assert block.common(pattern).tolist() == [common(pattern, t) for t in texts]
    assert np.allclose(block.ratio(pattern), [ratio(pattern, t) for t in texts])


def test_long_patterns_use_several_words():
    rng = np.random.default_rng(1)
    texts = ["".join(rng.choice(list("abcdefgh"), n)) for n in (1, 40, 63, 64, 65, 130, 200)]
    block = TextBlock(texts)
    for p in texts:
        assert block.common(p).tolist() == [common(p, t) for t in texts]


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(word, word), min_size=1, max_size=8))
def test_pair_ratio(pairs):
    left, right = [a for a, _ in pairs], [b for _, b in pairs]
    got = pair_ratio(left, right)
    assert np.allclose(got, [ratio(a, b) for a, b in pairs])
    assert np.allclose(got, pair_ratio(right, left))
    assert np.allclose(pair_ratio(left, left), 100.0)


def test_token_sort_ratio(spark):
    df = spark.createDataFrame([("gym workout", "workout  gym"), ("", ""), (None, "a"), ("abc", "abd")], "a string, b string")
    got = [r[0] for r in df.select(token_sort_ratio(F.col("a"), F.col("b"))).collect()]
    assert got[0] == 100.0 and got[1] == 100.0 and got[2] is None and got[3] == pytest.approx(400 / 6)
    assert df.select(token_sort(F.col("b"))).first()[0] == "gym workout"


def test_fuzzy_search_against_brute_force(spark):
    corpus = [(i, t.lower()) for i, t in enumerate(TEXTS + ["blinding lihgts", "lights blinding"])]
    asked = ["blinding light", "aa", "zz"]
    items = spark.createDataFrame(corpus, "id int, text string")
    queries = spark.createDataFrame([(q, q) for q in asked], "qid string, text string")
    got = {}
    for r in tfidf.fuzzy_top_k(items, queries, 3).orderBy("qid", "rank").collect():
        got.setdefault(r["qid"], []).append((r["id"], round(r["score"], 9)))
    for q in asked:
        s = " ".join(sorted(q.split()))
        scored = [(i, round(ratio(s, " ".join(sorted(t.split()))) / 100, 9)) for i, t in corpus]
        assert got[q] == sorted(scored, key=lambda x: (-x[1], x[0]))[:3]


def test_vibe_tables():
    assert len(KEYWORDS) == 112 and len(VIBE_KEYWORDS) == 10
    assert VIBE_KEYWORDS.keys() == VIBE_TARGETS.keys()
    assert all(len(t) == 9 for t in VIBE_TARGETS.values())


@pytest.mark.parametrize("text, want", [
    ("slow dance", "party"), ("good vibes", "chill"), ("relax deep", "chill"), ("chil", "chill"), ("wurkout", "gym"),
    ("Gym Workout", "gym"), ("zq jx", None), ("STUDY", "focus")])
def test_detect_vibe(spark, text, want):
    df = spark.createDataFrame([(text,)], "text string")
    assert detect_vibe(df).first()["vibe"] == want
