from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from cadenza.operators import grams, tfidf

WORDS = [f"w{i}" for i in range(40)] + ["a", "É", "ß", "\U0001F600x", "naïve\x00b", "ab", "aaaa", "中文字", "\x1f"]


def some_texts(seed, n=60):
    rng = np.random.default_rng(seed)
    texts = [" ".join(rng.choice(WORDS, rng.integers(1, 50))) for _ in range(n)]
    return texts + ["", " ", None, "aaaa " * 40, texts[0], "A B c"]


def as_rows(vectors):
    return sorted(((r["id"] is None, r["id"]), sorted(zip(r["grams"], (round(w, 9) for w in r["weights"])))) for r in vectors.collect())


@pytest.mark.parametrize("chunk,bits", [(1_500_000, 20), (60, 2)])
def test_blocks_are_counted_as_by_hand(monkeypatch, chunk, bits):
    monkeypatch.setattr(grams, "CHUNK_GRAMS", chunk)
    monkeypatch.setattr(grams, "COUNT_BITS", bits)
    lists = [t.lower().split(" ") if t else t and [] for t in some_texts(5)]
    lists = [x and [w for w in x if w] for x in lists]
    wanted = {(i, g): n for i, x in enumerate(lists) for g, n in Counter(
        f" {w} "[j:j + n] for w in x or [] for n in (2, 3, 4) for j in range(len(w) + 3 - n)).items()}
    block = grams.Block(pa.array(lists, pa.list_(pa.string())))
    alphabet = grams.Alphabet(block.points)
    keys, counted = block.cut(alphabet)
    names = alphabet.strings(keys).to_pylist()
    got = [((t, names[g]), n) for part in counted() for t, g, n in zip(*(x.tolist() for x in part))]
    assert dict(got) == wanted and len(got) == len(wanted)
    # the same where there are more characters than can be numbered
    assert set(zip(*(x.tolist() for x in grams._one_by_one(block)[::-1]))) == set(wanted)


@pytest.mark.parametrize("cells", [4_000_000, 12])
def test_scores_of_texts_and_queries(monkeypatch, cells):
    monkeypatch.setattr(grams, "CELLS", cells)
    rng = np.random.default_rng(4)
    texts, asked = (rng.random((n, 30)) * (rng.random((n, 30)) < 0.4) for n in (9, 5))
    asked[:, 7] = 0
    q, place = np.nonzero(asked)
    matrix = grams._Asked(place, q, asked[q, place], 5, 30)
    t, place = np.nonzero(texts)
    got = [s for _, _, s in matrix.scores(np.searchsorted(t, np.arange(9), "right"), place, texts[t, place])]
    assert np.allclose(np.concatenate(got), texts @ asked.T)


@pytest.mark.parametrize("repeated", [False, True])
def test_long_texts_have_the_same_weights(spark, repeated):
    rows = list(enumerate(some_texts(3)))
    if repeated:
        rows += [(5, "again w1 w2"), (5, None), (None, "w3 w4"), (None, "w4 zz"), (6, None)]
    df = spark.createDataFrame(rows, "id bigint, text string")
    idf, plain = tfidf.fit_idf(df, long=True), tfidf.fit_idf(df)
    assert {r["gram"]: (r["df"], r["idf"]) for r in idf.collect()} == {r["gram"]: (r["df"], r["idf"]) for r in plain.collect()}
    got = tfidf.vectors(df, idf, long=True)
    # no row per gram is made
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert as_rows(got) == as_rows(tfidf.vectors(df, plain))
    # grams that are not fitted drop out, also those of unknown characters
    few = spark.createDataFrame([(1, "w1 中中 Ω"), (2, "Ω")], "id bigint, text string")
    assert as_rows(tfidf.vectors(few, idf, long=True)) == as_rows(tfidf.vectors(few, idf))


def test_a_key_with_too_many_texts_is_counted_in_spark(spark, monkeypatch):
    df = spark.createDataFrame([(1, "w1 w2"), (1, "w2 w3"), (2, "w1")], "id bigint, text string")
    wanted = as_rows(tfidf.vectors(df, tfidf.fit_idf(df)))
    monkeypatch.setattr(tfidf, "MERGED_BYTES", 4)
    assert tfidf.one_row_each(df, "id", "text") is None
    assert as_rows(tfidf.vectors(df, tfidf.fit_idf(df, long=True), long=True)) == wanted


def test_scan_keeps_the_best_of_many_equal_scores(spark):
    texts = some_texts(7, 90) + [f"{a} {b}" for a in WORDS[:12] for b in WORDS[:12]]
    items = spark.createDataFrame([(None if i == 40 else i, t) for i, t in enumerate(texts)], "id bigint, text string")
    queries = spark.createDataFrame([(1, "w1 w2"), (2, texts[3]), (3, "zz"), (4, None), (None, "w5"), (5, "w1 w2"), (1, "w9")], "qid bigint, text string")
    index, idf = tfidf.fit_index(items)
    rows = lambda of: sorted((r["qid"], r["rank"], r["id"] or -1, round(r["score"], 9)) for r in of.collect())
    got = tfidf.scan_top_k(items, queries, 6)
    assert rows(got.filter("qid <> 1")) == rows(tfidf.tfidf_top_k(items, queries, idf, 6, index=index).filter("qid <> 1"))


def test_strings_of_keys():
    wanted = [" a", "ab", "é中\U0001F600", "abcd", "a\x00"]
    alphabet = grams.Alphabet(grams.code_points("".join(wanted)))
    keys = grams.keys_of(pa.array(wanted), alphabet)
    assert alphabet.strings(keys).to_pylist() == wanted and len(set(keys.tolist())) == 5
