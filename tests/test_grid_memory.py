import numpy as np
import pyarrow as pa

from cadenza.operators import pruned
from cadenza.operators.pruned import Bounds, _Part


def cell(rng, n, n_blocks, width=4):
    x = rng.normal(size=(n, width))
    block = rng.integers(0, n_blocks, n)
    centres = np.stack([x[block == b].mean(axis=0) for b in range(n_blocks)])
    far = np.linalg.norm(x - centres[block], axis=1)
    of = lambda v: np.array([v[block == b].max() for b in range(n_blocks)])
    return x, block, Bounds(centres, of(far), of(np.linalg.norm(x, axis=1)), np.bincount(block))


def column(x, size):
    return pa.chunked_array([pa.array(x[at:at + size].tolist(), pa.list_(pa.float64())) for at in range(0, len(x), size)])


def test_scores_of_large_blocks_are_bounded(monkeypatch):
    rng = np.random.default_rng(3)
    x, block, bounds = cell(rng, 600, 3)
    queries = rng.normal(size=(500, 4))
    own = [np.where(np.arange(500) % 7 == 0, np.arange(500), -1)]
    sizes, scores = [], _Part._scores
    monkeypatch.setattr(pruned, "SCORES", 2000, raising=False)
    monkeypatch.setattr(_Part, "_scores", lambda *given: sizes.append((s := scores(*given)).size) or s)
    wanted = queries @ x.T
    wanted[np.flatnonzero(own[0] >= 0), own[0][own[0] >= 0]] = -np.inf
    for rows, asked in ((x, queries), (column(x, 70), column(queries, 90))):
        part = _Part(np.arange(600), rows, block, bounds, 5)
        found = {}
        for q, row, score in part.best(asked, own):
            for a, b, c in zip(q.tolist(), row.tolist(), score.tolist()):
                found.setdefault(a, []).append((b, round(c, 9)))
        assert {q: [r for r, _ in rows] for q, rows in found.items()} == {q: np.argsort(-wanted[q])[:5].tolist() for q in range(500)}
    # a block of 200 rows meets 500 queries, some at a time
    assert sizes and max(sizes) <= 2000
