import random

import pytest

from cadenza.llm.graph import components
from cadenza.llm.ngram_join import drop_near_duplicates, near_duplicates
from tests.llm.helpers import ODD, by_id, corpus, prose, words


def shingles(text):
    w = words(text, lower=True)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    label = {d: d for d in sets}

    def root(d):
        while label[d] != d:
            d = label[d]
        return d
    ids = sorted(sets)
    for i, x in enumerate(ids):
        for y in ids[i + 1:]:
            if sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if 100 * both >= 80 * (len(sets[x]) + len(sets[y]) - both):
                    a, b = sorted((root(x), root(y)))
                    label[b] = a
    return {d: (len(sets[d]), root(d)) for d in ids}


def family(seed, members, length, changes):
    """Near copies of one text; some chains link only through others."""
    rng, base, out = random.Random(seed), prose(seed, length), []
    for _ in range(members):
        own = list(rng.choice(out)) if out and rng.random() < 0.5 else list(base)
        for _ in range(changes):
            own[rng.randrange(length)] = f"c{rng.randrange(10**6)}"
        out.append(own)
    return [" ".join(w) for w in out]


def check(docs, rows, **options):
    got = {d: (r["n_shingles"], r["component_id"]) for d, r in by_id(near_duplicates(docs, **options)).items()}
    assert got == brute(rows)


@pytest.mark.parametrize("fragment_size", [300, 2_000_000])
def test_against_brute_force(make_docs, fragment_size):
    rows = corpus(4, 70)
    rows += [(1000 + i, t) for i, t in enumerate(family(8, 25, 120, 2) + family(9, 25, 90, 1) + family(10, 20, 200, 5))]
    check(make_docs(rows), rows, fragment_size=fragment_size)


def test_at_and_below_the_threshold(make_docs):
    # 16 shingles in common of 20 are 80 %, of 21 less
    base = prose(77, 20)
    near, far = base[:18] + ["q1", "q2"], base[:17] + ["r1", "r2", "r3", "r4"]
    rows = [(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (4, " ".join(base[:18]))]
    check(make_docs(rows), rows)


def test_case_counts_only_for_ascii(make_docs):
    rows = [(1, "A B C D É"), (2, "a b c d É"), (3, "a b c d é"), (4, "a\tb\nc d\r\nÉ"), (5, "a b c")]
    check(make_docs(rows), rows)


def test_odd_rows(make_docs):
    got = near_duplicates(make_docs(ODD)).collect()
    assert len(got) == len(ODD)
    assert sorted((r["doc_id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in got) == [
        (0, 0, 0), (0, 0, 0), (0, 1, 5), (5, 1, 5), (5, 1, 5), (5, 1, 5), (7, 1, 7), (8, 0, 8)]
    assert near_duplicates(make_docs([])).count() == 0
    assert near_duplicates(make_docs([(1, None), (2, "")])).count() == 2


def test_filter_keeps_one_of_each_group(make_docs):
    rows = corpus(4, 70)
    kept = drop_near_duplicates(make_docs(rows))
    assert kept.columns == make_docs(rows).columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({c for _, c in brute(rows).values()})
    assert drop_near_duplicates(make_docs(ODD)).count() == 6


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "x long, y long")
    assert {r["node"]: r["label"] for r in components(edges).collect()} == {
        **{i: 0 for i in range(41)}, 100: 100, 101: 100}
