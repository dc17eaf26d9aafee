import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from cadenza.llm.boundary_set import ArrayContainer, BitmapContainer, BoundarySet, RunContainer
from cadenza.llm.fill_in_middle import restored, transform, unit_ends
from tests.llm.helpers import ODD, corpus

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]", re.S)


def brute(doc_id, text, seed=1, transformed=90, suffix_first=20):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(units)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= transformed:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if h4 % 100 < suffix_first:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(docs, rows, **options):
    found = transform(docs, **options)
    rebuilt = found.withColumn("text", restored(F.col("output"), F.col("form")))
    key = lambda r: (r[0] is None, r[0] or 0, *map(str, r[1:]))
    got = sorted((tuple(r) for r in rebuilt.collect()), key=key)
    assert got == sorted(((d, *brute(d, t, **options), t or "") for d, t in rows), key=key)
    return got


TEXTS = ["", None, "<P>", "a <S> b", "<", "<<", "<S", "P>S>M>", "<<P", "a<M", "日本語 🙂 x", "é" * 50, "a" * 500,
         "word " * 300, "\n\r\t\x00 x", "A1b2C3", "ſK"]


def test_against_brute_force(make_docs):
    rows = corpus() + [(1000 + i, t) for i, t in enumerate(TEXTS * 8)]
    got = check(make_docs(rows), rows)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_other_rates_and_seeds(make_docs):
    rows = [(i, t) for i, t in enumerate(TEXTS * 4)]
    assert {r[2] for r in check(make_docs(rows), rows, seed=7, transformed=100, suffix_first=100)} == {"plain", "spm"}
    assert {r[2] for r in check(make_docs(rows), rows, seed=7, transformed=0)} == {"plain"}


def test_odd_rows_and_long_texts(make_docs):
    rows = ODD + [(i, "a b" * 70000 + "é.1 " * 60000) for i in range(4)]
    check(make_docs(rows), rows)


def test_empty_table(make_docs):
    assert transform(make_docs([])).count() == 0


def test_same_rows_in_any_partitioning(make_docs):
    rows = corpus(9, 30)
    one, many = (sorted(map(tuple, transform(make_docs(rows).repartition(n)).collect())) for n in (1, 7))
    assert one == many


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab<P>SM é🙂1 ", max_size=30), max_size=6))
def test_units_of_a_block_do_not_run_into_each_other(texts):
    wanted = [np.cumsum([len(u) for u in UNIT.findall(t)]).tolist() for t in texts]
    assert [e.tolist() for e in unit_ends([t.encode() for t in texts])] == wanted


@pytest.mark.parametrize("offsets, kinds", [
    (range(0, 300_000, 97), [ArrayContainer] * 5),
    (range(0, 200_000, 3), [BitmapContainer] * 3 + [ArrayContainer]),
    (range(5, 200_000), [RunContainer] * 4),
    ([*range(100), *range(70_000, 138_000, 2), 1 << 40], [RunContainer, BitmapContainer, ArrayContainer, ArrayContainer]),
    ([], []), ([0], [ArrayContainer]), ([65535, 65536], [ArrayContainer] * 2)])
def test_select_in_each_kind_of_container(offsets, kinds):
    wanted = np.array(list(offsets), np.int64)
    found = BoundarySet(wanted)
    assert len(found) == len(wanted) and [type(c) for c in found.containers] == kinds
    assert found.select(np.arange(len(wanted))).tolist() == wanted.tolist()
    with pytest.raises(IndexError):
        found.select([len(wanted)])


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(0, 1 << 18), max_size=400), st.integers(0, 70_000), st.integers(0, 70_000))
def test_select_of_mixed_sets(some, start, length):
    wanted = sorted(some | set(range(start, start + length)))
    ranks = np.arange(0, len(wanted), 7)
    assert BoundarySet(np.array(wanted, np.int64)).select(ranks).tolist() == [wanted[r] for r in ranks]
