"""Reads a SentencePiece model file and splits texts into units that are tokenised on their own.

Only the file's vocabulary, scores and normaliser switches are read; nothing is trained. Its pieces
are used as a unigram vocabulary: the best-scoring sequence of pieces is wanted, and ties go to the
sequence whose last piece starts earliest, as in the library's unigram model.
"""

from __future__ import annotations

import re
import struct
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

SPACE = "▁"
UNIT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: Numbers of the file format: piece kinds.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    kinds: list[int]
    dummy_prefix: bool = True
    usable: dict[str, int] = field(default_factory=dict)
    byte_ids: list[int] = field(default_factory=list)

    def __post_init__(self):
        low, high = min(self.scores), max(self.scores)
        normal = [s for s, k in zip(self.scores, self.kinds) if k == NORMAL]
        low, high = (min(normal), max(normal)) if normal else (low, high)
        self.unknown_score = low - UNKNOWN_PENALTY
        self.usable = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k in (NORMAL, USER_DEFINED)}
        self.best = {i: (len(p.encode()) * high - 0.1 if self.kinds[i] == USER_DEFINED else self.scores[i])
                     for p, i in self.usable.items()}
        by_byte = {p: i for i, (p, k) in enumerate(zip(self.pieces, self.kinds)) if k == BYTE}
        self.byte_ids = [by_byte[f"<0x{b:02X}>"] for b in range(256)] if len(by_byte) == 256 else []
        self.byte_of = {i: b for b, i in enumerate(self.byte_ids)}
        self.unknown = next((i for i, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.single = {p for p in self.usable if len(p) == 1}
        # sums of few such scores are exact in single precision
        self.whole = all(float(s).is_integer() for s in self.best.values())
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.usable):
            raise ValueError("a piece continues after a word's end; words cannot be tokenised on their own")

    def normalise(self, text: str) -> str:
        """Spaces become visible marks; one more is put in front. Empty stays empty."""
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def units(self, text: str) -> list[str]:
        """Runs of marks with the word behind them; no piece crosses from one to the next."""
        return UNIT.findall(self.normalise(text))

    def unknown_ids(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()] if self.byte_ids else [self.unknown]

    def decode_unit(self, ids: list[int]) -> str:
        """Text of the ids of one or more whole units, marks still in it."""
        out, pending = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                pending.append(self.byte_of[i])
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append("" if self.kinds[i] == CONTROL else " ⁇ " if i == self.unknown else self.pieces[i])
        return "".join(out) + pending.decode("utf-8", "replace")

    def restore(self, text: str) -> str:
        """Marks back to spaces, without the one put in front."""
        if self.dummy_prefix and text.startswith(SPACE):
            text = text[1:]
        return text.replace(SPACE, " ")


def _fields(data: bytes):
    """(number, value) of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            if size is None:
                size = varint()
            yield key >> 3, data[at:at + size]
            at += size


def parse(data: bytes) -> Vocabulary:
    pieces, scores, kinds, switches, rules = [], [], [], {}, b""
    for number, value in _fields(data):
        if number == 1:
            entry = dict(_fields(value))
            pieces.append(entry.get(1, b"").decode())
            scores.append(struct.unpack("<f", entry[2])[0] if 2 in entry else 0.0)
            kinds.append(entry.get(3, NORMAL))
        elif number == 3:
            spec = dict(_fields(value))
            switches, rules = {k: v for k, v in spec.items() if isinstance(v, int)}, spec.get(2, b"")
    if rules or switches.get(4, 1) or not switches.get(5, 1):
        raise ValueError("only models that keep texts as they are, with visible spaces, are supported")
    return Vocabulary(pieces, scores, kinds, bool(switches.get(3, 1)))


def load(spark: SparkSession, path: str) -> Vocabulary:
    """The vocabulary of a model file that the driver, or else Spark's readers, can open."""
    try:
        with open(path, "rb") as f:
            return parse(f.read())
    except FileNotFoundError:
        return parse(bytes(spark.read.format("binaryFile").load(path).first()["content"]))
