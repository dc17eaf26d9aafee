"""Personal data: pattern spans, and more spans by a skip-chain conditional random field.

Base spans follow fixed patterns. The field labels the tokens that hold a digit or an at sign
(all others are O): features of a token give its own potential, neighbouring tokens share a chain
potential, and repeated or similar tokens anywhere in the document share a skip potential. Loopy
message passing over all edges of many documents at once gives each token's probabilities; tokens
inside base spans are held at their label. Tokens labelled with a high probability become spans.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cadenza.llm.common import id_and_text, share, text_blocks

KINDS = ("email", "ip", "card", "phone")
LABELS = ("O", *KINDS)
SAMPLE_DOCS, SAMPLE_CHARS = 400, 20_000
ROUNDS, DAMPING, LEAST = 12, 0.3, 0.9
STEPS, RATE = 200, 0.1
SCHEMA = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, "
          "spans string, n_added bigint")

_LOCAL_RUN = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
_TOKEN = re.compile(r"\S+")


def passes_luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _emails(text: str):
    """Leftmost matches without rescanning: the name is the run of name characters before an at sign."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL_RUN.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        else:
            done = at + 1
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind in the order of ``KINDS``."""
    if not _MARK.search(text):
        return []
    found = [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p[-20:]) <= 255 for p in m[0].split(".")):
                found.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and passes_luhn(digits):
                found.append(("card", *m.span()))
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m[0]) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


# ---- the field --------------------------------------------------------------------------------

N_FEATURES = 40


def features(token: str) -> list[int]:
    """Numbers of the features a token has."""
    digits = sum(c.isdigit() for c in token)
    letters = sum(c.isalpha() for c in token)
    core = token.strip(".,;:!?()[]\"'")
    return [
        0,
        1 + min(digits, 15),
        17 + min(letters, 3),
        21 + min(core.count("."), 4),
        26 if "@" in core else 27,
        28 if core.startswith("+") else 29,
        30 + min(core.count("-"), 3),
        34 if core.isdigit() else 35,
        36 + min(len(core) // 8, 3),
    ]


def similar_key(token: str) -> str:
    """Tokens with the same key share a potential: equal digits, or else equal letters and digits."""
    digits = "".join(c for c in token if c.isdigit())
    return digits if len(digits) >= 4 else "".join(c for c in token.lower() if c.isalnum() or c == "@")


@dataclass
class Graph:
    """Tokens of many documents with their chain and skip edges."""
    features: np.ndarray
    edges: np.ndarray
    skip: np.ndarray
    given: np.ndarray
    spans: list[tuple[int, int, int]]


def build(texts: list[str], base: list[list[tuple[str, int, int]]]) -> Graph:
    rows, edges, skip, given, spans = [], [], [], [], []
    for n, (text, found) in enumerate(zip(texts, base)):
        if not _MARK.search(text):
            continue
        last_number, seen, position = -2, {}, 0
        for number, m in enumerate(_TOKEN.finditer(text)):
            token = m[0]
            if not _MARK.search(token):
                continue
            start, end = m.span()
            while position < len(found) and found[position][2] <= start:
                position += 1
            inside = [f for f in found[position:position + 8] if f[1] < end and f[2] > start]
            me = len(rows)
            rows.append(features(token))
            given.append(LABELS.index(inside[0][0]) if inside else -1)
            spans.append((n, start, end))
            chained = number == last_number + 1
            if chained:
                edges.append((me - 1, me))
                skip.append(0)
            last_number = number
            # each repetition is tied to the one before it, so edges grow with the tokens
            key = similar_key(token)
            if key in seen and not (chained and seen[key] == me - 1):
                edges.append((seen[key], me))
                skip.append(1)
            seen[key] = me
    return Graph(np.array(rows, np.int64).reshape(-1, len(features(""))), np.array(edges, np.int64).reshape(-1, 2),
                 np.array(skip, np.int64), np.array(given, np.int64), spans)


@dataclass
class Field:
    unary: np.ndarray
    pair: np.ndarray

    def own(self, graph: Graph) -> np.ndarray:
        return self.unary[graph.features].sum(axis=1) if len(graph.features) else np.zeros((0, len(LABELS)))

    def marginals(self, graph: Graph, hold: bool = True, rounds: int = ROUNDS) -> np.ndarray:
        """Beliefs after ``rounds`` damped rounds of sum-product messages along all edges."""
        own = self.own(graph)
        if hold:
            known = graph.given >= 0
            own = own.copy()
            own[known] = -30.0
            own[np.flatnonzero(known), graph.given[known]] = 30.0
        if not len(graph.edges):
            return _softmax(own)
        # every edge carries a message each way
        source = np.concatenate([graph.edges[:, 0], graph.edges[:, 1]])
        target = np.concatenate([graph.edges[:, 1], graph.edges[:, 0]])
        half = len(graph.edges)
        weights = np.concatenate([self.pair[graph.skip], self.pair[graph.skip].transpose(0, 2, 1)])
        reverse = np.concatenate([np.arange(half) + half, np.arange(half)])
        messages = np.zeros((2 * half, len(LABELS)))
        for _ in range(rounds):
            gathered = own.copy()
            np.add.at(gathered, target, messages)
            leaving = gathered[source] - messages[reverse]
            fresh = _log_sum(leaving[:, :, None] + weights)
            fresh -= fresh.max(axis=1, keepdims=True)
            messages = DAMPING * messages + (1 - DAMPING) * fresh
        np.add.at(own, target, messages)
        return _softmax(own)


def _log_sum(x: np.ndarray) -> np.ndarray:
    top = x.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=1, keepdims=True)))[:, 0]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True)) if len(x) else x
    return e / e.sum(axis=1, keepdims=True) if len(x) else x


def train(texts: list[str], steps: int = STEPS, rate: float = RATE) -> Field:
    """Weights by pseudo-likelihood: each token's label given its features and its neighbours' labels.

    Labels come from the base spans, and are O outside them. A small penalty keeps weights finite.
    """
    graph = build(texts, [base_spans(t) for t in texts])
    count = len(LABELS)
    field = Field(np.zeros((N_FEATURES, count)), np.zeros((2, count, count)))
    if not len(graph.features):
        return field
    labels = np.maximum(graph.given, 0)
    truth = np.eye(count)[labels]
    balance = len(labels) / (count * np.maximum(np.bincount(labels, minlength=count), 1))
    weight = np.minimum(balance, 20)[labels][:, None] / len(labels)
    left, right = (graph.edges[:, 0], graph.edges[:, 1])
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in (field.unary, field.pair)]
    for step in range(1, steps + 1):
        scores = field.own(graph)
        np.add.at(scores, left, field.pair[graph.skip, :, labels[right]])
        np.add.at(scores, right, field.pair[graph.skip, labels[left], :])
        error = (_softmax(scores) - truth) * weight
        d_unary, d_pair = np.zeros_like(field.unary), np.zeros_like(field.pair)
        for column in graph.features.T:
            np.add.at(d_unary, column, error)
        np.add.at(d_pair.transpose(0, 2, 1), (graph.skip, labels[right]), error[left])
        np.add.at(d_pair, (graph.skip, labels[left]), error[right])
        for (first, second), g, p in zip(moments, (d_unary, d_pair), (field.unary, field.pair)):
            g = g + 1e-4 * p
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            p -= rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return field


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS) -> Field:
    """A field trained on at most ``sample_docs`` documents with digits or at signs, by a hash of their id."""
    rows = id_and_text(docs).filter(F.col("text").rlike("[0-9@]") & (F.length("text") <= chars))
    ids = rows.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs).distinct()
    texts = rows.join(F.broadcast(ids), "doc_id").orderBy("doc_id", "text").limit(2 * sample_docs).collect()
    return train([r["text"] for r in texts])


def added_spans(texts: list[str], base: list[list], field: Field, least: float = LEAST) -> list[list[tuple[str, int, int]]]:
    """Spans of tokens outside base spans with a label of probability ``least`` or more.

    Neighbouring tokens of one label make one span; punctuation around it is left out.
    """
    out: list[list] = [[] for _ in texts]
    graph = build(texts, base)
    chances = field.marginals(graph)
    previous = None
    for i, (n, start, end) in enumerate(graph.spans):
        label = int(chances[i].argmax()) if len(chances) else 0
        if graph.given[i] >= 0 or label == 0 or chances[i, label] < least:
            previous = None
            continue
        token = texts[n][start:end]
        core = token.strip(".,;:!?()[]{}<>\"'|")
        if not core:
            previous = None
            continue
        begin = start + token.index(core)
        span = (LABELS[label], begin, begin + len(core))
        if previous and previous[0] == (n, label) and texts[n][previous[1]:start].isspace():
            last = out[n].pop()
            span = (span[0], last[1], span[2])
        out[n].append(span)
        previous = ((n, label), end)
    return out


def _listed(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in sorted(spans, key=lambda x: (x[1], KINDS.index(x[0]), x[2])))


def personal_data(docs: DataFrame, field: Field) -> DataFrame:
    """One row per document: doc_id, base span counts by kind, base_sha256, spans (base and added), n_added.

    Spans are ``kind:start:end`` by start, then kind, in code points with the end exclusive, joined by
    commas. Null and empty texts have no spans. Repeated rows give a row each; an empty table an
    empty one; other columns are ignored.
    """
    shared = share(docs, field)

    def run(batches):
        known = shared()
        for part in text_blocks(batches):
            texts = [t or "" for t in part.column("text").to_pylist()]
            base = [base_spans(t) for t in texts]
            added = added_spans(texts, base, known)
            counts = [[sum(f[0] == k for f in found) for found in base] for k in KINDS]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts],
                pa.array([hashlib.sha256(_listed(found).encode()).hexdigest() for found in base]),
                pa.array([_listed(found + more) for found, more in zip(base, added)]),
                pa.array([len(a) for a in added], pa.int64()),
            ], ["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)
