import random
import zlib

import pytest
from hypothesis import given, settings, strategies as st

from cadenza.llm import sharding
from cadenza.llm.sharding import Ends, assign, cuts_within, minimax_cuts, ordered_groups, prepare, smallest_capacity, write_shards
from tests.llm.helpers import ODD, corpus


def least_capacity(sizes, shards):
    """The plain dynamic program over all ways to cut."""
    ends = [0]
    for s in sizes:
        ends.append(ends[-1] + s)
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(len(ends))]
    return best[-1]


def plain(rows, shards):
    """{(id, text): shard}, sizes and least capacity by plain code; the cuts are taken from exact running sizes."""
    groups = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    order = sorted(groups, key=lambda t: (min((d is None, d or 0) for d in groups[t]), t))
    sizes = [(len(t.encode()) + 16) * len(groups[t]) for t in order]
    return groups, order, sizes


def check(docs, rows, shards):
    got = assign(docs, shards).collect()
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["text_crc32"]) for r in got)) == sorted(
        (d is None, d or 0, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows)
    shard_sizes, slots = [0] * shards, [[] for _ in range(shards)]
    for r in got:
        shard_sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append((r["slot"], r["doc_id"] is None, r["doc_id"] or 0))
    for each in slots:
        assert [s for s, *_ in sorted(each)] == list(range(len(each)))
        assert [x[1:] for x in sorted(each)] == sorted(x[1:] for x in each)
    groups, order, sizes = plain(rows, shards)
    assert max(shard_sizes) == least_capacity(sizes, shards)
    # shards are stretches of the order, and equal texts lie together
    by_id = {}
    for r in got:
        by_id.setdefault((r["doc_id"], r["text_crc32"]), set()).add(r["shard"])
    of = [{s for d in groups[t] for s in by_id[d, zlib.crc32(t.encode())]} for t in order]
    assert all(len(s) == 1 for s in of)
    assert [min(s) for s in of] == sorted(min(s) for s in of)
    return shard_sizes


@pytest.mark.parametrize("shards", [1, 2, 7, 40])
def test_against_brute_force(make_docs, shards):
    rows = corpus(documents=80)
    check(make_docs(rows), rows, shards)


def test_a_group_beyond_an_even_share(make_docs):
    rows = [(i, "copy " * 30) for i in range(0, 60, 2)] + [(i, f"text {i} " * 10) for i in range(1, 90, 2)]
    sizes = check(make_docs(rows), rows, 8)
    # the group fills the largest shard; the others share the rest
    assert all(s > 0 for s in sizes)


def test_even_sizes_where_groups_are_small(make_docs):
    rng = random.Random(5)
    rows = [(i, f"{i} " + "x" * rng.randrange(400)) for i in range(2000)]
    sizes = check(make_docs(rows), rows, 10)
    assert max(sizes) - min(sizes) <= 2 * 420


def test_odd_rows_and_more_shards_than_groups(make_docs):
    check(make_docs(ODD), ODD, 12)
    assert assign(make_docs([])).count() == 0


def test_large_forms_give_the_same_rows(make_docs, monkeypatch):
    rows = corpus(11, 120)
    before = sorted(map(tuple, assign(make_docs(rows), 6).collect()))
    monkeypatch.setattr(sharding, "ORDERED_ROWS", 10)
    assert sorted(map(tuple, assign(make_docs(rows).repartition(5), 6).collect())) == before


def test_few_known_ends_give_the_same_cuts(make_docs):
    groups = ordered_groups(prepare(make_docs(corpus(4, 150))))
    whole = minimax_cuts(groups, 9)
    assert minimax_cuts(groups, 9, blocks=3, parts=2) == whole
    assert minimax_cuts(groups, 9, blocks=1, parts=5) == whole


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 60), min_size=1, max_size=25), st.integers(1, 8))
def test_capacity_and_cuts(sizes, shards):
    ends = Ends([sum(sizes[:i + 1]) for i in range(len(sizes))], [0] * len(sizes))
    capacity = smallest_capacity(ends, shards, max(sizes))
    assert capacity == least_capacity(sizes, shards)
    cuts = [0, *cuts_within(ends, shards, capacity), sum(sizes)]
    assert cuts == sorted(cuts) and all(c in ends.ends for c in cuts)
    assert max(b - a for a, b in zip(cuts, cuts[1:])) == capacity


def test_written_shards_hold_all_rows(spark, make_docs, tmp_path):
    docs = make_docs(corpus(documents=40) + ODD)
    table = write_shards(docs, str(tmp_path / "out"), 5)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("row.*").collect())) == sorted(map(str, docs.collect()))
    assert {r["shard"]: r["rows"] for r in table.collect()} == {
        r["shard"]: r["count"] for r in back.groupBy("shard").count().collect()}
