import hashlib

import numpy as np
import pytest

from cadenza.llm.fm_index import FMIndex, WaveletMatrix, intervals, suffix_order
from cadenza.llm.substring_dedup import halves, repeated_passages
from tests.llm.helpers import by_id, corpus, prose, words


def brute(rows, window=50):
    texts = {d: words(t) for d, t in rows}
    least = {}
    for d in sorted(texts):
        for i in range(len(texts[d]) - window + 1):
            least.setdefault(tuple(texts[d][i:i + window]), d)
    out = {}
    for d, w in texts.items():
        keep = [True] * len(w)
        for i in range(len(w) - window + 1):
            if least[tuple(w[i:i + window])] < d:
                keep[i:i + window] = [False] * window
        kept = [x for x, k in zip(w, keep) if k]
        out[d] = (len(w), len(w) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return out


def shared_passages():
    """Passages of 49 to 90 words in many contexts, one document repeating itself, nested repeats."""
    rows, long_ = [], prose(500, 90)
    for i in range(40):
        before, after = prose(600 + i, i % 7 * 5), prose(700 + i, i % 5 * 9)
        rows.append((i, " ".join(before + long_[i % 4 * 5:49 + i % 42] + after)))
    own = prose(800, 60)
    return rows + [(90, " ".join(own + prose(801, 3) + own)), (91, " ".join(own[5:])), (92, " ".join(own[:49]))]


def check(docs, rows, **options):
    got = {d: tuple(r)[1:] for d, r in by_id(repeated_passages(docs, **options)).items()}
    assert got == brute(rows)


@pytest.mark.parametrize("options", [{}, {"shard_words": 700}, {"crowded": 1}, {"crowded": 3}])
def test_against_brute_force(make_docs, options):
    rows = corpus(7, 50) + [(1000 + d, t) for d, t in shared_passages()]
    check(make_docs(rows), rows, **options)


def repeated_starts():
    """Documents that begin with a row of one word or a repeated line, then share texts of several lengths."""
    rows = []
    for family in range(12):
        line = ["*"] if family % 2 else prose(900 + family, 2 + family // 2)
        head = (line * 40)[:26 + 2 * family]
        text = head + prose(920 + family, 60)
        for member, shared in enumerate((56, 70, 62, 84, 53)):
            rows.append((10 * family + member, " ".join(text[:shared] + prose(1000 + 10 * family + member, 20 + member))))
    return rows


@pytest.mark.parametrize("crowded", [0, 2])
def test_several_marks_at_the_start_of_a_crowded_text(make_docs, crowded):
    check(make_docs(repeated_starts()), repeated_starts(), crowded=crowded)


def test_longer_anchors_keep_every_shared_window():
    """Two passages around one anchor share a window exactly if they share a longer anchor, at every depth."""
    rng = np.random.default_rng(5)
    window, size = 12, 5
    anchor = [b"a%d" % i for i in range(size)]

    def leaves(words, at, name=1, low=0, high=window - size, depth=0):
        out = {(depth, name)}
        for named, begin, end, place, least, most in halves(name, words, at, low, high, window, size):
            assert words[begin:end][place:place + size] == anchor and end - begin >= window
            if least == most:
                out.add((depth + 1, named, "end"))
            else:
                out |= leaves(words[begin:end], place, named, least, most, depth + 1)
        return out

    def windows(words, at):
        return {tuple(words[i:i + window]) for i in range(max(0, at - window + size), at + 1) if i + window <= len(words)}
    met = 0
    for _ in range(1500):
        pair = []
        for _ in range(2):
            before, after = ([b"%d" % (rng.random() < 0.05) for _ in range(int(rng.integers(0, window - size + 1)))]
                             for _ in range(2))
            pair.append((before + anchor + after, len(before)))
        ends = [{x for x in leaves(*p) if len(x) == 3} if len(p[0]) >= window else set() for p in pair]
        assert [len(e) for e in ends] == [len(windows(*p)) for p in pair]
        shared = windows(*pair[0]) & windows(*pair[1])
        assert len(ends[0] & ends[1]) == len(shared)
        met += bool(shared)
    assert 50 < met < 1450


def test_odd_rows(make_docs):
    text = " ".join(prose(5, 60))
    rows = [(5, text), (5, text), (5, text + " more"), (None, text), (9, None), (10, ""), (11, "x" * 9000)]
    got = sorted((r["doc_id"] or 0, r["n_words"], r["n_removed"]) for r in repeated_passages(make_docs(rows)).collect())
    # rows with one id do not count against each other; a null id comes last
    assert got == [(0, 60, 60), (5, 60, 0), (5, 60, 0), (5, 61, 0), (9, 0, 0), (10, 0, 0), (11, 1, 0)]
    assert repeated_passages(make_docs([])).count() == 0


def test_suffix_order_and_ranks():
    rng = np.random.default_rng(1)
    tokens = rng.integers(0, 5, 300)
    order = suffix_order(tokens, 300)
    assert order.tolist() == sorted(range(300), key=lambda i: tokens[i:].tolist())
    matrix = WaveletMatrix(tokens, 5)
    symbols, at = rng.integers(0, 5, 200), rng.integers(0, 301, 200)
    assert matrix.rank(symbols, at).tolist() == [(tokens[:i] == s).sum() for s, i in zip(symbols, at)]


def test_matching_statistics():
    rng = np.random.default_rng(2)
    parts = [rng.integers(1, 3, 30).tolist() for _ in range(12)]
    tokens = np.array([t for p in parts for t in [*p, 0]])
    index = FMIndex(tokens, np.repeat(np.arange(12), 31), 3, 30)

    def occurs(piece, own):
        return any(parts[o][i:i + len(piece)] == piece for o in range(own) for i in range(31 - len(piece)))
    for own in range(12):
        for end in range(0, 30, 7):
            start = end + 1
            while start > 0 and occurs(parts[own][start - 1:end + 1], own):
                start -= 1
            base = np.array([own * 31])
            assert index.extend(base, base + end, np.array([own]))[0] - base[0] == start
    found = intervals(index, np.arange(12) * 31, np.full(12, 30), np.arange(12), 8)
    for own in range(12):
        covered = {i for w, s, e in found.tolist() if w == own for i in range(s, e)}
        assert covered == {j for i in range(23) if occurs(parts[own][i:i + 8], own) for j in range(i, i + 8)}
