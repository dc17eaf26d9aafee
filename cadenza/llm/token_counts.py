"""Count-only Viterbi: Aho-Corasick finds all vocabulary pieces of a unit in one pass; the dynamic
program keeps the best score and the number of pieces at each position, and no way back."""

from __future__ import annotations

from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cadenza.llm.common import WordCache, id_and_text, share, text_blocks
from cadenza.llm.pieces import Vocabulary

#: Sums of whole numbers above this are exact in single precision.
EXACT = -float(1 << 24)
#: Rounds what is put in to single precision.
_SINGLE = array("f", [0.0])
SCHEMA = "doc_id bigint, n_units bigint, n_tokens bigint, score double"


def automaton(vocabulary: Vocabulary):
    import ahocorasick

    found = ahocorasick.Automaton()
    for piece, i in vocabulary.usable.items():
        found.add_word(piece, (len(piece), vocabulary.best[i]))
    found.make_automaton()
    return found


def count_unit(unit: str, found, vocabulary: Vocabulary) -> tuple[int, float]:
    """(number of pieces, score) of the best sequence.

    At a tie the piece that starts first wins, which the automaton reports first. A character
    without a piece of its own costs the unknown score and counts a piece per byte, or, without byte
    pieces, one per run. Sums are compared and kept in single precision.
    """
    best, pieces, in_unknown = [0.0], [0], [False]
    matches = found.iter(unit)
    match = next(matches, None)
    for end, char in enumerate(unit):
        top, count, unknown, single = None, 0, False, False
        while match is not None and match[0] == end:
            length, score = match[1]
            start = end + 1 - length
            _SINGLE[0] = best[start] + score
            # longest first, so a strict comparison keeps the earliest start
            if top is None or _SINGLE[0] > top:
                top, count = _SINGLE[0], pieces[start] + 1
            single = single or length == 1
            match = next(matches, None)
        if not single:
            _SINGLE[0] = best[end] + vocabulary.unknown_score
            if top is None or _SINGLE[0] > top:
                more = len(char.encode()) if vocabulary.byte_ids else 0 if in_unknown[end] else 1
                top, count, unknown = _SINGLE[0], pieces[end] + more, True
        best.append(top)
        pieces.append(count)
        in_unknown.append(unknown)
    return pieces[-1], best[-1]


def count_known(unit: str, found) -> tuple[int, float]:
    """The same where every character is a piece and sums are exact: no rounding, no gaps."""
    best, pieces = [None] * (len(unit) + 1), [0] * (len(unit) + 1)
    best[0] = 0.0
    for end, (length, score) in found.iter(unit):
        start, end = end + 1 - length, end + 1
        value, old = best[start] + score, best[end]
        if old is None or value > old:
            best[end], pieces[end] = value, pieces[start] + 1
    return pieces[-1], best[-1]


def count_units(units: list[str], found, vocabulary: Vocabulary) -> np.ndarray:
    """A row of (number of pieces, score) per unit; plain sums where they are exact in single precision."""
    out, single = [], vocabulary.single
    for unit in units:
        got = count_known(unit, found) if vocabulary.whole and single.issuperset(unit) else None
        out.append(got if got and got[1] > EXACT else count_unit(unit, found, vocabulary))
    return np.array(out, float).reshape(-1, 2)


def token_counts(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """One row per document: doc_id, n_units, n_tokens, score.

    Null and empty texts have no tokens and score 0. Repeated rows give a row each; an empty table
    an empty one; other columns are ignored. Units are counted once per task and distinct text.
    """
    shared = share(docs, vocabulary)

    def run(batches):
        vocabulary = shared()
        found = automaton(vocabulary)
        cache = WordCache(lambda new: count_units(new, found, vocabulary))
        for part in text_blocks(batches):
            units = [vocabulary.units(t or "") for t in part.column("text").to_pylist()]
            sizes = np.array([len(u) for u in units], np.int64)
            index = cache.index([u for of_text in units for u in of_text])
            rows = np.repeat(np.arange(len(units)), sizes)
            values = cache.values[index] if len(index) else np.zeros((0, 2))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array(sizes),
                pa.array(np.bincount(rows, values[:, 0], len(units)).astype(np.int64)),
                pa.array(np.bincount(rows, values[:, 1], len(units)).astype(float)),
            ], ["doc_id", "n_units", "n_tokens", "score"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)
