"""Bounded fuzzy search against scoring every pair."""

import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from cadenza.functions.text import TextBlock
from cadenza.operators import tfidf
from cadenza.operators.kernels import SLACK, TokenSort

LETTERS = "abcde fé🙂"


def names(seed, n):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randrange(2, 9))) for _ in range(60)]
    return [" ".join(sorted(rng.sample(words, rng.randrange(1, 5)))) for _ in range(n)]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=LETTERS, max_size=14), min_size=1, max_size=20, unique=True), st.text(alphabet=LETTERS, max_size=14),
       st.integers(1, 6), st.sampled_from([-np.inf, 0.3, 0.7, 1.0]))
def test_nothing_among_the_best_is_left_out(texts, query, k, floor):
    kernel, block = TokenSort(), TextBlock(texts)
    every = block.ratio(query) / 100.0
    assert (kernel.bounds(query, block, kernel.counts(texts)) + 1e-12 >= every).all()
    found = kernel._above(query, block, kernel.counts(texts), floor, k)
    known = ~np.isinf(found)
    assert (found[known] == every[known]).all()
    kth = max(floor, np.sort(every)[-k] if len(texts) >= k else -np.inf)
    assert known[every >= kth].all()


def test_chosen_strings_alone():
    texts = names(4, 300)
    block, chosen = TextBlock(texts), np.arange(300) % 7 == 0
    assert (block.ratio(texts[5], chosen)[chosen] == block.ratio(texts[5])[chosen]).all()


def test_few_pairs_are_measured():
    texts = sorted(set(names(1, 4000)))
    kernel, block = TokenSort(), TextBlock(texts)
    counts = kernel.counts(texts)
    for query in names(2, 40):
        kernel._above(query, block, counts, -np.inf, 5)
    assert kernel.measured < 0.3 * kernel.bounded


@pytest.mark.parametrize("bounds", [{}, {"max_query_rows": 1, "block_rows": 40}])
def test_search_against_every_pair(spark, bounds):
    texts = names(7, 150) * 2 + ["", "a", None]
    asked = names(8, 12) + [names(7, 1)[0].upper(), "", None, names(8, 1)[0]]
    items = spark.createDataFrame([(i, t, f"n{i}") for i, t in enumerate(texts)], "id int, text string, name string")
    queries = spark.createDataFrame([(i, t) for i, t in enumerate(asked)], "qid int, text string")
    got = {}
    for r in tfidf.fuzzy_top_k(items, queries, 7, carry=("name",), **bounds).orderBy("qid", "rank").collect():
        assert r["name"] == f"n{r['id']}"
        got.setdefault(r["qid"], []).append((r["id"], round(r["score"], 9)))
    given_texts = [(i, " ".join(sorted(t.split()))) for i, t in enumerate(texts) if t is not None]
    block = TextBlock([t for _, t in given_texts])
    for q, text in enumerate(asked):
        if text is None:
            assert q not in got
            continue
        scores = block.ratio(" ".join(sorted(text.lower().split()))) / 100.0
        best = sorted(zip((-np.round(scores, 9)).tolist(), (i for i, _ in given_texts)))[:7]
        assert got[q] == [(i, round(-s, 9)) for s, i in best]
    assert SLACK == 1e-9
