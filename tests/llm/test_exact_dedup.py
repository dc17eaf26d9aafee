import hashlib

from pyspark.sql import functions as F

from cadenza.llm.exact_dedup import drop_duplicates, exact_duplicates, prepare, sorted_names
from tests.llm.helpers import ODD, SPACE, by_id, corpus


def brute(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(SPACE.sub(" ", t or ""), []).append(d)
    return {d: (min(groups[n]), len(groups[n]), d == min(groups[n]), hashlib.sha256(n.encode()).hexdigest())
            for d, t in rows for n in [SPACE.sub(" ", t or "")]}


def check(docs, rows, **options):
    got = {d: tuple(r)[1:] for d, r in by_id(exact_duplicates(docs, **options)).items()}
    assert got == brute(rows)


def test_against_brute_force(make_docs):
    rows = corpus()
    check(make_docs(rows), rows)


def test_many_levels_of_small_blocks(make_docs):
    rows = corpus(5, 40)
    check(make_docs(rows), rows, block_bytes=16)


def test_colliding_hashes_do_not_join_different_texts(make_docs):
    rows = corpus(6, 40)
    check(make_docs(rows), rows, block_bytes=64, fingerprint=lambda c: F.pmod(F.xxhash64(c), F.lit(3)))
    check(make_docs(rows), rows, block_bytes=64, fingerprint=lambda c: F.lit(0))


def test_names_are_unique_and_sorted_within_partitions(spark):
    names = sorted_names(spark.createDataFrame([(i % 50,) for i in range(500)], "v int")).collect()
    assert len({r["name"] for r in names}) == len(names) == 50


def test_null_and_repeated_ids(make_docs):
    rows = sorted((r["keep_id"] is None, r["keep_id"] or 0, r["group_size"], r["kept"])
                  for r in exact_duplicates(make_docs(ODD)).collect())
    # the text of id 5 stays once; a null id stays only where it is alone
    assert sum(kept for *_, kept in rows) == 4
    assert len(rows) == len(ODD)
    kept = drop_duplicates(make_docs(ODD))
    assert kept.columns == make_docs(ODD).columns
    assert sorted((r["doc_id"] or -1, len(r["text"] or "")) for r in kept.collect()) == [(5, 12), (5, 14), (7, 20005), (8, 0)]


def test_empty_table(make_docs):
    assert exact_duplicates(make_docs([])).count() == 0
    assert drop_duplicates(make_docs([])).count() == 0


def test_no_python_in_the_plan(make_docs):
    plan = exact_duplicates(make_docs([(1, "a")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert prepare(make_docs([(1, "a")])).count() == 1
