import hashlib
import random
import re

from cadenza.llm.decontam import Searcher, contamination, drop_contaminated, windows, words_of
from tests.llm.helpers import ODD, by_id

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(rows, items):
    out = {}
    for d, t in rows:
        w, hit, found = split(t), set(), set()
        for item, text in items:
            v = split(text)
            for i in range(max(1, len(v) - 9) if v else 0):
                wanted = v[i:i + 10]
                for j in range(len(w) - len(wanted) + 1):
                    if w[j:j + len(wanted)] == wanted:
                        hit.update(range(j, j + len(wanted)))
                        found.add(str(item))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit))
    return out


def tables(seed=1):
    rng = random.Random(seed)
    vocabulary = ["the", "of", "é", "Ünï", "a", "b", "ab", "x1", "9", "then", "other", "日本"]

    def text(n):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", ", ", "--", "\n", "\x00", ". "]) for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([12, 30, 10, 9, 3, 1, 0, 25, 11])] + [(20, None), (21, " .. "), (10, "rare")]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 30))]
        if i % 3 == 0:
            parts.append(rng.choice(items)[1] or "")
            parts.append(text(rng.randrange(0, 10)))
        rows.append((i, " ".join(parts)))
    return rows + [(100, None), (101, ""), (102, "!!"), (103, "Rare"), (104, "rarely")], items


def check(spark, docs, rows, items, **options):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {d: tuple(r)[1:] for d, r in by_id(contamination(docs, benchmark, **options)).items()}
    assert got == brute(rows, items)


def test_against_brute_force(spark, make_docs):
    rows, items = tables()
    check(spark, make_docs(rows), rows, items)


def test_several_tables_of_test_strings(spark, make_docs):
    rows, items = tables(2)
    check(spark, make_docs(rows), rows, items, table_bytes=300)


def test_search_finds_every_place():
    strings = sorted(windows([(1, "a b"), (2, "b a b c"), (3, "the quick brown fox jumps over the lazy dog again and again")]))
    texts = [b"a b a b c a b", b"", b"The quick brown fox jumps over the lazy dog again", b"xa b"]
    for (n, hits), text in zip(Searcher(strings).search(texts), texts):
        norm = b" " + b" ".join(words_of(text)) + b" "
        assert n == len(words_of(text))
        assert sorted(hits) == sorted((norm[:i].count(b" "), s.count(b" ") - 1, k) for k, s in enumerate(strings)
                                      for i in range(len(norm)) if norm.startswith(s, i))


def test_odd_rows(spark, make_docs):
    items = spark.createDataFrame([(3, "another text"), (None, None)], "item_id long, text string")
    got = contamination(make_docs(ODD), items).collect()
    assert sorted((r["doc_id"] or 0, r["n_hit"]) for r in got) == [
        (0, 0), (0, 0), (0, 0), (5, 0), (5, 0), (5, 2), (7, 0), (8, 0)]
    kept = drop_contaminated(make_docs(ODD), items)
    assert kept.columns == make_docs(ODD).columns and kept.count() == len(ODD) - 1
    assert contamination(make_docs([]), items).count() == 0
    assert drop_contaminated(make_docs([]), items).count() == 0
    assert not any(r["contaminated"] for r in contamination(make_docs(ODD), items.limit(0)).collect())
