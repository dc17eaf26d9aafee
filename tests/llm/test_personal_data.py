import hashlib
import re
import time

import numpy as np
import pytest

from cadenza.llm.personal_data import (KINDS, LABELS, Field, added_spans, base_spans, build, fit, passes_luhn,
                                       personal_data, train)
from tests.llm.helpers import ODD, by_id

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {"email": True, "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                    "card": 14 <= len(digits) <= 19 and passes_luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return sorted(out, key=lambda x: (x[1], KINDS.index(x[0])))


TEXTS = [
    "mail a.b@c.de, x@y then q@r.s@t.u and @z.z, é@ö.de ü.x@y.zz",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.002.003.004 1.2.3 9.9.9.999.1.1.1.1 0.0.0.00000000255",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111 5 4242424242424242 4242 1",
    "+49 (30) 1234567 +1 2 +12345678901234567 ++4915112345678. +4 9-1.5(1)12345678)",
    "+1 555 123 4567 a@b.c 10.0.0.1 4012888888881881", "", None, "no marks", "a@b@c.d e@f..g h@i.j.",
]


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(1)
    alphabet = list("ab@..+-0123456789 ()5") + ["1.2.", "@x.y", "4111 1111 ", "+49"]
    noise = ["".join(rng.choice(alphabet, rng.integers(1, 60))) for _ in range(3000)]
    for text in TEXTS + noise:
        assert base_spans(text or "") == plain(text), text


def test_long_runs_take_linear_time():
    start = time.time()
    for text in ("a" * 300_000 + " 1", "1" * 300_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 100_000 + "1", "1 " * 100_000):
        base_spans(text)
    assert time.time() - start < 20


def exact_marginals(field, graph):
    """By enumeration of all labellings."""
    import itertools
    own, count = field.own(graph), len(LABELS)
    total = np.zeros_like(own)
    for labels in itertools.product(range(count), repeat=len(own)):
        if any(g >= 0 and g != x for g, x in zip(graph.given, labels)):
            continue
        score = sum(own[i, x] for i, x in enumerate(labels)) + sum(
            field.pair[s, labels[a], labels[b]] for (a, b), s in zip(graph.edges, graph.skip))
        total[np.arange(len(own)), labels] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_messages_are_exact_on_trees():
    rng = np.random.default_rng(2)
    field = Field(rng.normal(0, 1, (40, 5)), rng.normal(0, 1, (2, 5, 5)))
    text = "a1 b2 c3 word a1"
    graph = build([text], [[]])
    assert graph.edges.tolist() == [[0, 1], [1, 2], [0, 3]] and graph.skip.tolist() == [0, 0, 1]
    assert np.allclose(field.marginals(graph, rounds=60), exact_marginals(field, graph), atol=1e-3)
    graph = build([text], [[("card", 0, 2)]])
    assert np.allclose(field.marginals(graph, rounds=60), exact_marginals(field, graph), atol=1e-3)


def test_repetition_carries_a_label():
    """A token without marks of its own gets the label of its repetition inside a base span."""
    pair = np.zeros((2, 5, 5))
    pair[1] += 4 * np.eye(5)
    field = Field(np.zeros((40, 5)), pair)
    text = "call +49 30 1234567 or later 1234567 again"
    found = added_spans([text], [base_spans(text)], field, 0.5)
    assert found == [[("phone", 29, 36)]]
    assert added_spans([text], [base_spans(text)], Field(np.zeros((40, 5)), np.zeros((2, 5, 5))), 0.5) == [[]]


def test_training_reproduces_labels():
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(120):
        n = rng.integers(0, 10, 12)
        texts.append(f"write u{n[0]}@mail{n[1]}.example.com from 10.{n[2]}.3.{n[3]} or +1 555 12{n[4]} 45{n[5]}7 line {n[6]} of {n[7]}")
    field = train(texts)
    graph = build(texts, [base_spans(t) for t in texts])
    guess = field.marginals(graph, hold=False).argmax(axis=1)
    assert (guess == np.maximum(graph.given, 0)).mean() > 0.95


def test_query_columns(make_docs):
    rows = list(enumerate(TEXTS))
    docs = make_docs(rows)
    got = by_id(personal_data(docs, fit(docs)))
    for d, text in rows:
        spans = plain(text)
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert [got[d][f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in spans) for k in KINDS]
        assert got[d]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        every = [x for x in got[d]["spans"].split(",") if x]
        assert set(listed.split(",")) - {""} <= set(every) and len(every) == len(spans) + got[d]["n_added"]


@pytest.mark.parametrize("rows", [ODD, []])
def test_odd_rows(make_docs, rows):
    assert personal_data(make_docs(rows), fit(make_docs(rows))).count() == len(rows)
