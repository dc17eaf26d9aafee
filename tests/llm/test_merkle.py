import pytest
from pyspark.sql import functions as F

from cadenza.llm.merkle import audit, content, levels_for, tree, leaves, warc_records, with_offsets

RECORDS = "file string, offset long, length long, page_id long, record string, range int, digest string"


def replica(spark, rows):
    full = [(f, o, n, p, r, 1, "d") for f, o, n, p, r in rows]
    return spark.createDataFrame(full, RECORDS).withColumn("content", content(F.col("record")))


def rows_of(count=300, files=3):
    return [(f"f{i % files}", i // files * 40, 40, i, f"record {i}") for i in range(count)]


@pytest.mark.parametrize("range_bytes,fanout", [(100, 2), (4096, 16), (1, 3)])
def test_finds_exactly_the_damage(spark, range_bytes, fanout):
    left = rows_of()
    right = [(f, o, n, p, "other" if p in (7, 250) else r) for f, o, n, p, r in left if p not in (11, 12)]
    right = right + [("f9", 0, 5, 999, "extra")]
    got = audit(replica(spark, left), replica(spark, right), range_bytes, fanout).collect()
    assert sorted((r["page_id"], r["kind"]) for r in got) == [
        (7, "changed"), (11, "missing"), (12, "missing"), (250, "changed"), (999, "extra")]


def test_equal_and_empty_replicas(spark):
    assert audit(replica(spark, rows_of()), replica(spark, rows_of())).count() == 0
    assert audit(replica(spark, []), replica(spark, [])).count() == 0
    assert audit(replica(spark, rows_of(4)), replica(spark, [])).count() == 4


def test_nulls_and_repeated_places(spark):
    left = [("a", 0, 5, 1, "x"), ("a", 0, 5, 1, "x"), ("a", 5, 5, 2, None), ("a", 10, 5, 3, "z")]
    right = [("a", 0, 5, 1, "x"), ("a", 5, 5, 2, "y"), ("a", 10, 5, 3, "z")]
    got = {r["offset"]: r["kind"] for r in audit(replica(spark, left), replica(spark, right)).collect()}
    assert got == {0: "changed", 5: "extra"}


def test_only_mismatching_branches_differ(spark):
    left, right = rows_of(), rows_of()
    right[100] = (*right[100][:4], "changed")
    trees = [tree(leaves(replica(spark, r)), 100, 2) for r in (left, right)]
    a, b = ({(r["file"], r["level"], r["node"]): r["digest"] for r in t.collect()} for t in trees)
    assert a.keys() == b.keys()
    differ = [k for k in a if a[k] != b[k]]
    height = levels_for(max(r[1] for r in left), 100, 2)
    # one node on each level, up to the root of its file
    assert sorted(level for _, level, _ in differ) == list(range(height + 1))
    assert {file for file, _, _ in differ} == {right[100][0]}
    assert sum(level == height for _, level, _ in a) == 3


def test_records_and_offsets(spark):
    pages = spark.createDataFrame([(1, "u", "é"), (2, None, None), (1500, "v", "x"), (None, "w", "y"), (2, None, None)],
                                  "page_id long, url string, html string")
    records = warc_records(pages).collect()
    assert len(records) == 5 and all(r["length"] == len(r["record"].encode()) for r in records)
    placed = with_offsets(warc_records(pages).withColumn("c", content(F.col("record"))), [F.col("page_id"), F.col("c")])
    files = {}
    for r in placed.collect():
        files.setdefault(r["file"], []).append((r["offset"], r["length"]))
    assert len(files) == 3
    for spans in files.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
