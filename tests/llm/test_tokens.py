import hashlib

import numpy as np
import pytest

from cadenza.llm import pieces
from cadenza.llm.pieces import BYTE, CONTROL, NORMAL, UNKNOWN, USER_DEFINED, Vocabulary, parse
from cadenza.llm.queries import model_path
from cadenza.llm.token_counts import automaton, count_unit, token_counts
from cadenza.llm.viterbi import Encoder, decode, encode, round_trip
from tests.llm.helpers import ODD, by_id, corpus

TEXTS = ["Hello  wor\tld é\n\nx ", " ", "日本語 🙂 x", "aaaa" * 60, "a", "", "  lead", "trail  ", "x\n", "▁x"]


@pytest.fixture(scope="module")
def model():
    with open(model_path(), "rb") as f:
        return parse(f.read())


def small(byte_pieces=False):
    """A vocabulary with many ties."""
    extra = [(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)] if byte_pieces else []
    rows = [("<unk>", 0.0, UNKNOWN), ("<s>", 0.0, CONTROL), *extra] + [
        (p, s, NORMAL) for p, s in [("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁a", -2.0),
                                    ("aba", -3.0), ("aa", -1.5), ("▁▁", -1.5)]] + [("bb", 0.0, USER_DEFINED)]
    return Vocabulary(*map(list, zip(*rows)))


def brute(unit, vocabulary):
    """The plain dynamic program: starts in order, a strictly better score in single precision replaces."""
    best = [(np.float32(0), [])] + [None] * len(unit)
    for i in range(len(unit)):
        if best[i] is None:
            continue
        for j in range(i + 1, len(unit) + 1):
            piece = vocabulary.usable.get(unit[i:j])
            if piece is None and j > i + 1:
                continue
            score = vocabulary.unknown_score if piece is None else vocabulary.best[piece]
            value = np.float32(float(best[i][0]) + score)
            if best[j] is None or value > best[j][0]:
                best[j] = (value, best[i][1] + [(piece, unit[i:j])])
    out, unknown = [], False
    for piece, text in best[-1][1]:
        if piece is not None:
            out.append(piece)
        elif vocabulary.byte_ids or not unknown:
            out.extend(vocabulary.unknown_ids(text))
        unknown = piece is None
    return out, float(best[-1][0])


@pytest.mark.parametrize("byte_pieces", [False, True])
def test_ties_against_the_plain_program(byte_pieces):
    import itertools
    vocabulary = small(byte_pieces)
    units = ["".join(p) for n in range(1, 7) for p in itertools.product("ab▁é", repeat=n)][:3000]
    found, wanted = automaton(vocabulary), [brute(u, vocabulary) for u in units]
    assert Encoder(vocabulary).encode_units(units) == [w[0] for w in wanted]
    assert [count_unit(u, found, vocabulary) for u in units] == [(len(ids), score) for ids, score in wanted]


def test_real_vocabulary_against_the_plain_program(model):
    units = sorted({u for _, t in corpus(9, 30) for u in model.units(t or "")} | {u for t in TEXTS for u in model.units(t)})
    found, wanted = automaton(model), [brute(u, model) for u in units]
    assert Encoder(model).encode_units(units) == [w[0] for w in wanted]
    assert [count_unit(u, found, model)[0] for u in units] == [len(w[0]) for w in wanted]


def as_unigram(data):
    """The model file with its kind, one byte of its training settings, set to unigram."""
    def fields(at, end):
        def number():
            nonlocal at
            value = shift = 0
            while True:
                byte = data[at]
                at += 1
                value |= (byte & 127) << shift
                shift += 7
                if byte < 128:
                    return value
        while at < end:
            key = number()
            if key & 7 == 0:
                start = at
                number()
            else:
                size = {1: 8, 5: 4}.get(key & 7) or number()
                start, at = at, at + size
            yield key >> 3, start, at
    out = bytearray(data)
    for n, start, stop in fields(0, len(data)):
        if n == 2:
            for m, a, _ in fields(start, stop):
                if m == 3:
                    out[a] = 1
    return bytes(out)


def test_score_is_the_best_of_the_library_lattice(model):
    import sentencepiece
    with open(model_path(), "rb") as f:
        library = sentencepiece.SentencePieceProcessor(model_proto=as_unigram(f.read()))
    units = [u for u in sorted({u for _, t in corpus(9, 12) for u in model.units(t or "")}) if u.startswith("▁") and len(u) > 2
             and "\n" not in u]
    for unit, ids in zip(units, Encoder(model).encode_units(units)):
        top = library.nbest_encode(unit[1:], nbest_size=2)[0]
        assert sum(model.scores[i] for i in ids) == pytest.approx(sum(model.scores[i] for i in top))
        assert library.decode(ids) == model.restore(model.decode_unit(ids))


def test_encode_decode(make_docs, model):
    rows = list(enumerate(TEXTS)) + [(50, None)]
    ids = encode(make_docs(rows), model)
    back = {r["doc_id"]: r["text"] for r in decode(ids, model).collect()}
    assert back == {**{i: t.replace("▁", " ") for i, t in enumerate(TEXTS)}, 50: None}


def test_round_trip_and_counts(make_docs, model):
    rows = corpus(11, 40) + [(500 + i, t) for i, t in enumerate(TEXTS)]
    got, counts = by_id(round_trip(make_docs(rows), model)), by_id(token_counts(make_docs(rows), model))
    for d, text in rows:
        ids = [i for u in model.units(text or "") for i in brute(u, model)[0]]
        assert got[d]["n_tokens"] == counts[d]["n_tokens"] == len(ids)
        assert got[d]["ids_sha256"] == hashlib.sha256(np.array(ids, "<i4").tobytes()).hexdigest()
        assert got[d]["exact"] == ("▁" not in (text or ""))
    assert round_trip(make_docs(ODD), model).count() == token_counts(make_docs(ODD), model).count() == len(ODD)
    assert round_trip(make_docs([]), model).count() == token_counts(make_docs([]), model).count() == 0


def test_units_cover_the_text(model):
    assert model.units("") == [] and model.units("a b") == ["▁a", "▁b"] and model.units(" ") == ["▁▁"]
    with pytest.raises(ValueError):
        Vocabulary(["<unk>", "a▁b"], [0.0, -1.0], [UNKNOWN, NORMAL])
    assert pieces.UNIT.findall("▁▁a▁") == ["▁▁a", "▁"]
