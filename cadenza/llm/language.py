"""Language identification by a bidirectional gated recurrent network over bytes.

Every byte position gets a probability for each language from a forward and a backward recurrence;
a document's probabilities are the mean over its positions. Both recurrences run over the whole text,
white space included. Texts longer than ``STRETCH`` bytes run as stretches side by side, cut between
characters, that start ``OVERLAP`` bytes before and end as many after the positions they give. Weights
are trained in numpy by backpropagation through time, on single words and stretches of running text of
a bounded sample of labelled documents.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cadenza.llm.common import id_and_text, raw_texts, share, text_blocks

#: Bytes of the longest single word learned from in one piece.
PIECE = 48
#: Positions that a stretch gives at most, and bytes it runs over on either side of them.
STRETCH, OVERLAP = 2048, 128
#: Lengths of the stretches of running text learned from.
LEARNED = (16, 32, 64)
HIDDEN = 16
#: Bounds of the training sample: documents of each language, their characters, words taken from all.
SAMPLE_DOCS, SAMPLE_CHARS, SAMPLE_WORDS = 150, 20_000, 40_000
#: Parts taken of a document with more characters, spread over it; together as many characters.
PARTS = 8
#: Parts of a language's hashes that are ranked apart first.
SPREAD = 16
STEPS, BATCH, RATE = 700, 256, 0.01
UNDETERMINED = "und"
#: Logits that one array holds; bounds the memory of a task, whatever the number of languages.
CELLS = 8 << 20
LETTER = re.compile(r"[^\W\d_]")
SCHEMA = "doc_id bigint, lang_pred string, score double"


def held_out(doc_id) -> F.Column:
    """Documents nothing may be learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(docs: DataFrame, per_language: int = SAMPLE_DOCS, chars: int = SAMPLE_CHARS,
           parts: int = 0) -> list[tuple[str, bytes]]:
    """(lang, text) of at most ``per_language`` different texts of each language, none of them of held-out documents.

    They are the first by a hash of the text. Of a text with more than ``chars`` characters, ``parts`` evenly
    spread ones of ``chars / parts`` characters are taken; without ``parts`` such texts are left out. Only hashes
    are ranked, first in parts by their remainder, so that the texts of a common language meet in no single task.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.col("text").isNotNull())
    if not parts:
        rows = rows.filter(F.length("text") <= chars)
    rows = rows.withColumn("print", F.xxhash64("text"))
    texts = rows.groupBy("lang", "print").agg(F.min("doc_id").alias("doc_id"))
    order = Window.partitionBy("lang").orderBy("print")
    apart = Window.partitionBy("lang", F.pmod("print", F.lit(SPREAD))).orderBy("print")
    near = texts.withColumn("n", F.row_number().over(apart)).filter(F.col("n") <= per_language)
    picked = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_language)
    # bounded by languages times per_language
    found = rows.join(F.broadcast(picked), ["lang", "print", "doc_id"]).select("lang", "n", "text")
    if parts:
        size = max(1, chars // parts)
        spread = [F.substring("text", (F.lit(1) + F.floor((F.length("text") - size) * (i / max(1, parts - 1)))).cast("int"),
                              F.lit(size)) for i in range(parts)]
        pieces = F.when(F.length("text") <= chars, F.array("text")).otherwise(F.array(*spread))
        found = found.select("lang", "n", F.explode(pieces).alias("text"))
    found = found.dropDuplicates(["lang", "n", "text"])
    return [(r["lang"], r["text"].encode()) for r in found.orderBy("lang", "n", "text").collect()]


def pieces_of(text: bytes) -> list[bytes]:
    words = text.split()
    if text and max(map(len, words), default=0) > PIECE:
        words = [w[i:i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    return words


def stretches(text: bytes, size: int | None = None, overlap: int | None = None) -> list[tuple[int, int, int, int]]:
    """(begin, low, high, end): positions ``low`` to ``high`` are given by a run from ``begin`` to ``end``.

    All four lie between characters; ``low`` to ``high`` cover the text once.
    """
    size, overlap = STRETCH if size is None else size, OVERLAP if overlap is None else overlap

    def border(at: int) -> int:
        at = min(max(at, 0), len(text))
        for back in range(min(4, at + 1)):
            if at in (back, len(text)) or text[at - back] & 0xC0 != 0x80:
                return at - back
        return at

    cuts = [0, *(border(at) for at in range(size, len(text), size)), len(text)] if text else []
    return [(border(low - overlap), low, high, border(high + overlap)) for low, high in zip(cuts, cuts[1:])]


def _sigmoid(x):
    return 1 / (1 + np.exp(-x))


@dataclass
class Network:
    """One gated recurrence each way; gates are (update, reset, candidate) in one matrix."""
    languages: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(languages: list[str], hidden: int, seed: int = 7) -> "Network":
        rng = np.random.default_rng(seed)
        weights = {}
        for way in "fb":
            weights[f"x{way}"] = rng.normal(0, 0.3, (256, 3 * hidden))
            weights[f"u{way}"] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 3 * hidden))
        weights["o"] = rng.normal(0, 0.3, (2 * hidden, len(languages)))
        weights["c"] = np.zeros(len(languages))
        return Network(languages, {k: v.astype(np.float32) for k, v in weights.items()})

    def recur(self, way: str, codes: np.ndarray, keep: bool = False):
        """States at every position of (length, rows) byte codes, in reading order of ``way``."""
        table, loop = self.weights[f"x{way}"], self.weights[f"u{way}"]
        size = loop.shape[0]
        state = np.zeros((codes.shape[1], size), np.float32)
        states, saved = [], []
        for row in codes:
            given = table[row]
            gates = _sigmoid(given[:, :2 * size] + state @ loop[:, :2 * size])
            update, reset = gates[:, :size], gates[:, size:]
            inner = reset * state
            candidate = np.tanh(given[:, 2 * size:] + inner @ loop[:, 2 * size:])
            if keep:
                saved.append((state, update, reset, inner, candidate))
            state = state + update * (candidate - state)
            states.append(state)
        return states, saved

    def positions(self, codes: np.ndarray) -> np.ndarray:
        """(length, rows, languages): probabilities at every byte."""
        forward, _ = self.recur("f", codes)
        backward, _ = self.recur("b", codes[::-1])
        return self._read(np.array(forward), np.array(backward[::-1]))

    def _read(self, forward, backward):
        size = forward.shape[-1]
        logits = forward @ self.weights["o"][:size] + backward @ self.weights["o"][size:] + self.weights["c"]
        logits -= logits.max(axis=-1, keepdims=True)
        chance = np.exp(logits)
        return chance / chance.sum(axis=-1, keepdims=True)

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean cross-entropy over all positions and its gradient, back through time both ways."""
        states = {"f": self.recur("f", codes, True), "b": self.recur("b", codes[::-1], True)}
        forward, backward = np.array(states["f"][0]), np.array(states["b"][0][::-1])
        chance = self._read(forward, backward)
        length, rows = codes.shape
        picked = np.arange(rows)
        loss = -np.log(chance[:, picked, labels] + 1e-9).mean()
        error = chance
        error[:, picked, labels] -= 1
        error /= length * rows
        size = forward.shape[-1]
        out = {"c": error.sum((0, 1)),
               "o": np.concatenate([np.tensordot(s, error, ((0, 1), (0, 1))) for s in (forward, backward)])}
        into = error @ self.weights["o"].T
        for way, part, order in (("f", into[..., :size], codes), ("b", into[::-1, :, size:], codes[::-1])):
            loop, saved = self.weights[f"u{way}"], states[way][1]
            table, inner_out = np.zeros_like(self.weights[f"x{way}"]), np.zeros_like(loop)
            back = np.zeros((rows, size), np.float32)
            for t in range(length - 1, -1, -1):
                state, update, reset, inner, candidate = saved[t]
                back = back + part[t]
                d_candidate = back * update * (1 - candidate ** 2)
                d_inner = d_candidate @ loop[:, 2 * size:].T
                d_gates = np.concatenate([back * (candidate - state) * update * (1 - update),
                                          d_inner * state * reset * (1 - reset)], axis=1)
                inner_out[:, 2 * size:] += inner.T @ d_candidate
                inner_out[:, :2 * size] += state.T @ d_gates
                np.add.at(table, order[t], np.concatenate([d_gates, d_candidate], axis=1))
                back = back * (1 - update) + d_inner * reset + d_gates @ loop[:, :2 * size].T
            out[f"x{way}"], out[f"u{way}"] = table, inner_out
        return float(loss), out

    def _logits(self, way: str, codes: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
        """(positions, languages): one recurrence's share of the logits at every byte of ``codes``.

        Row ``i`` has ``length[i]`` bytes from ``first[i]``; lengths fall, so that the rows still running are the first.
        """
        table, loop = self.weights[f"x{way}"], self.weights[f"u{way}"]
        size = loop.shape[0]
        # negated, as a gate is 1 / (1 + exp(-x))
        gate_of, gate = -table[:, :2 * size], -loop[:, :2 * size]
        inner_of, inner = table[:, 2 * size:].copy(), loop[:, 2 * size:].copy()
        read = self.weights["o"][:size] if way == "f" else self.weights["o"][size:]
        begin, step = (first, 1) if way == "f" else (first + length - 1, -1)
        out = np.empty((len(codes), len(self.languages)), np.float32)
        state = np.zeros((len(first), size), np.float32)
        running = np.searchsorted(-length, -np.arange(length[0]), "left")
        for t, rows in enumerate(running.tolist()):
            at, state = begin[:rows] + step * t, state[:rows]
            byte = codes[at]
            gates = gate_of.take(byte, axis=0)
            gates += state @ gate
            np.exp(gates, out=gates)
            gates += 1
            np.reciprocal(gates, out=gates)
            candidate = inner_of.take(byte, axis=0)
            candidate += (gates[:, size:] * state) @ inner
            np.tanh(candidate, out=candidate)
            candidate -= state
            candidate *= gates[:, :size]
            state = state + candidate
            out[at] = state @ read
        return out

    def word_sums(self, words: list[bytes]) -> np.ndarray:
        """Per word or longer text, the sums of its positions' probabilities, and the number of positions."""
        out = np.zeros((len(words), len(self.languages) + 1))
        parts = sorted(((n, *part) for n, text in enumerate(words) for part in stretches(text)),
                       key=lambda p: p[1] - p[4])
        limit, start = max(1, CELLS // len(self.languages)), 0
        ends = np.cumsum([p[4] - p[1] for p in parts])
        while start < len(parts):
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            owner, begin, low, high, end = np.array(parts[start:stop], np.int64).T
            length = end - begin
            first = np.cumsum(length) - length
            codes = np.frombuffer(b"".join(words[p[0]][p[1]:p[4]] for p in parts[start:stop]), np.uint8)
            logits = self._logits("f", codes, first, length)
            logits += self._logits("b", codes, first, length)
            # one row per language: sums over a few languages are slow along the inner axis
            chance = np.zeros((len(self.languages), len(codes) + 1), np.float32)
            chance[:, :-1] = logits.T
            chance += self.weights["c"][:, None]
            chance -= chance.max(axis=0)
            np.exp(chance, out=chance)
            chance /= chance.sum(axis=0)
            spans = np.stack([first + low - begin, first + high - begin], 1).ravel()
            np.add.at(out[:, :-1], owner, np.add.reduceat(chance, spans, axis=1, dtype=np.float64)[:, ::2].T)
            np.add.at(out[:, -1], owner, high - low)
            start = stop
        return out


def _running(samples: list[tuple[str, bytes]], languages: list[str], length: int) -> dict:
    """By language: its texts of ``length`` bytes or more, and the cumulative numbers of their starts."""
    out = {}
    for n, lang in enumerate(languages):
        texts = [text for label, text in samples if label == lang and len(text) >= length]
        if texts:
            out[n] = texts, np.cumsum([len(text) - length + 1 for text in texts])
    return out


def _from_border(text: bytes, start: int, length: int) -> bytes:
    """``length`` bytes of a text from the character that ``start`` lies in."""
    while start and text[start] & 0xC0 == 0x80:
        start -= 1
    return text[start:start + length]


def train(samples: list[tuple[str, bytes]], hidden: int = HIDDEN, steps: int = STEPS, batch: int = BATCH,
          rate: float = RATE, words: int = SAMPLE_WORDS, seed: int = 7) -> Network | None:
    """A network fitted to (lang, text) samples, by Adam; None without any words.

    Steps take turns: single words of one length, lengths in proportion to their words, and stretches of
    running text, from anywhere in the texts. Languages count evenly.
    """
    languages = sorted({lang for lang, _ in samples})
    rng = np.random.default_rng(seed)
    each = max(1, words // max(1, len(languages)))
    groups: dict[int, list[list[bytes]]] = {}
    for n, lang in enumerate(languages):
        own = [p for label, text in samples if label == lang for p in pieces_of(text)]
        for i in rng.permutation(len(own))[:each] if len(own) > each else range(len(own)):
            groups.setdefault(len(own[i]), [[] for _ in languages])[n].append(own[i])
    if not groups:
        return None
    net = Network.fresh(languages, hidden, seed)
    lengths = sorted(groups)
    share = np.array([sum(map(len, groups[n])) * n for n in lengths], float)
    running = {length: found for length in LEARNED if (found := _running(samples, languages, length))}
    moments = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in net.weights.items()}
    for step in range(1, steps + 1):
        picked, labels = [], []
        if step % 2 and running:
            length = list(running)[rng.integers(0, len(running))]
            for n, (texts, reach) in running[length].items():
                for at in rng.integers(0, reach[-1], max(1, batch // len(running[length]))):
                    i = int(np.searchsorted(reach, at, "right"))
                    picked.append(_from_border(texts[i], int(reach[i] - at) - 1, length))
                    labels.append(n)
        else:
            length = lengths[rng.choice(len(lengths), p=share / share.sum())]
            present = [n for n, own in enumerate(groups[length]) if own]
            for n in present:
                own = groups[length][n]
                for i in rng.integers(0, len(own), max(1, batch // len(present))):
                    picked.append(own[i])
                    labels.append(n)
        codes = np.frombuffer(b"".join(picked), np.uint8).reshape(len(picked), length).T
        _, gradients = net.gradients(codes, np.array(labels))
        pace = rate * min(1, 2 * (1 - step / (steps + 1)))
        for k, g in gradients.items():
            first, second = moments[k]
            first += 0.1 * (g - first)
            second += 0.01 * (g * g - second)
            fixed = first / (1 - 0.9 ** step), second / (1 - 0.99 ** step)
            net.weights[k] = (net.weights[k] - pace * fixed[0] / (np.sqrt(fixed[1]) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, per_language: int = SAMPLE_DOCS, hidden: int = HIDDEN, steps: int = STEPS) -> Network | None:
    return train(sample(docs, per_language, parts=PARTS), hidden, steps)


class Predictor:
    def __init__(self, net: Network | None):
        self.net = net

    def rows(self, column) -> list[tuple[str, float]]:
        """(language, score) per text."""
        texts = raw_texts(column)
        if self.net is None:
            return [(UNDETERMINED, 0.0)] * len(texts)
        # equal texts of a block run once
        numbers: dict[bytes, int] = {}
        index = np.array([numbers.setdefault(t, len(numbers)) for t in texts], np.int64)
        sums = self.net.word_sums(list(numbers))[index]
        chance = sums[:, :-1] / np.maximum(sums[:, -1:], 1)
        best = chance.argmax(axis=1)
        out = []
        for i, text in enumerate(texts):
            if LETTER.search(text.decode("utf-8", "replace")):
                out.append((self.net.languages[best[i]], min(1.0, float(chance[i, best[i]]))))
            else:
                out.append((UNDETERMINED, 0.0))
        return out


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """One row per document: doc_id, lang_pred, score (the mean probability of that language).

    Null, empty and letterless texts, and all texts if there was nothing to learn from, are ``und``
    with score 0. Of equal probabilities the language first in the alphabet wins. Only the text is
    read; repeated rows give a row each, an empty table an empty one.
    """
    shared = share(docs, net)

    def run(batches):
        predictor = Predictor(shared())
        for part in text_blocks(batches):
            rows = predictor.rows(part.column("text"))
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows], pa.float64()),
            ], ["doc_id", "lang_pred", "score"])

    return id_and_text(docs).mapInArrow(run, SCHEMA)


def keep_identified(docs: DataFrame, net: Network | None, least: float = 0.0) -> DataFrame:
    """Rows of ``docs``, with all their columns, that have a language with a score of ``least`` or more."""
    shared = share(docs, net)
    names, at = docs.columns, docs.columns.index("text")

    def run(batches):
        predictor = Predictor(shared())
        named = (pa.RecordBatch.from_arrays(b.columns, [str(i) for i in range(b.num_columns)]) for b in batches)
        for part in text_blocks(named, str(at)):
            rows = predictor.rows(part.column(str(at)))
            kept = part.filter(pa.array([lang != UNDETERMINED and score >= least for lang, score in rows]))
            yield pa.RecordBatch.from_arrays(kept.columns, names)

    return docs.mapInArrow(run, docs.schema)
