"""First keyword of a table, by automaton, against plain containment."""

import random

import pytest

from cadenza.operators.keywords import first_keyword
from cadenza.operators.vibe import KEYWORDS, keyword_table


def brute(text, keywords):
    found = [(p, w, v) for p, w, v in keywords if w and text and w in text]
    return min(found) if found else (None, None, None)


@pytest.mark.parametrize("part_bytes", [None, 70, 1000])
def test_against_containment(spark, part_bytes):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abcé ") for _ in range(n))
    keywords = [(i, word(rng.randrange(0, 5)), f"p{i % 4}") for i in range(60, 0, -1)] + [(99, None, "p"), (100, "zzz", "p")]
    texts = [(i % 20, word(rng.randrange(0, 25))) for i in range(120)] + [(1, None), (1, ""), (None, "xzzzx")]
    got = first_keyword(spark.createDataFrame(texts, "doc_id int, text string"),
                        spark.createDataFrame(keywords, "pos int, keyword string, profile string"), part_bytes=part_bytes).collect()
    assert sorted(map(tuple, got), key=str) == sorted(((d, *brute(t, keywords)) for d, t in texts), key=str)


def test_no_keywords_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a")], "doc_id int, text string")
    none = spark.createDataFrame([], "pos int, keyword string, profile string")
    assert [tuple(r) for r in first_keyword(texts, none).collect()] == [(1, None, None, None)]
    assert first_keyword(texts.filter("false"), none).count() == 0


def test_vibe_keywords_as_a_table(spark):
    assert [(r["keyword"], r["profile"]) for r in keyword_table(spark).orderBy("pos").collect()] == KEYWORDS
