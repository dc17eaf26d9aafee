"""Fill-in-middle transformation of documents.

A text is a sequence of units: runs of ASCII letters, and every other character alone. The ends of its
units form a ``BoundarySet``; two units drawn from a digest of the document's id are looked up there and
give the offsets at which the text is cut into prefix, middle and suffix. The parts are written
behind marks, suffix before middle, so that a model learns to fill the middle in.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from cadenza.llm.boundary_set import BoundarySet
from cadenza.llm.common import id_and_text, text_blocks

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents, those that are transformed, and of these, those written suffix first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
SEED = 1
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("form", pa.string()),
                     ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])
_DDL = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def unit_ends(texts: list[bytes]) -> list[np.ndarray]:
    """Offsets in characters behind every unit, for each UTF-8 text."""
    raw = np.frombuffer(b"".join(texts), np.uint8)
    leads = (raw & 0xC0) != 0x80
    seen = np.concatenate([[0], np.cumsum(leads)])
    first = seen[np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])]
    lower = raw[leads] | 0x20
    letter = (lower >= 0x61) & (lower <= 0x7A)
    ends = np.ones(len(letter), bool)
    ends[:-1] = ~(letter[:-1] & letter[1:])
    # the last character of a text ends a unit, whatever text follows in the block
    ends[first[1:][first[1:] > first[:-1]] - 1] = True
    places = np.flatnonzero(ends)
    cuts = np.searchsorted(places, first)
    return [places[cuts[i]:cuts[i + 1]] + 1 - first[i] for i in range(len(texts))]


def draws(doc_id: Column, seed: int = SEED) -> list[Column]:
    """Four integers from the digest of ``seed:doc_id``; a null id has no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def _cut(batches):
    for batch in batches:
        for block in text_blocks([batch]):
            texts = block.column("text").to_pylist()
            sets = [BoundarySet(ends) for ends in unit_ends([t.encode() for t in texts])]
            n = np.array([len(s) for s in sets], np.int64)
            one, two = (block.column(c).to_numpy() % (n + 1) for c in ("h1", "h2"))
            counts = np.stack([np.minimum(one, two), np.maximum(one, two)], axis=1)
            # no unit is offset 0, k units are the k-th boundary
            offsets = [[0 if k == 0 else int(s.select([k - 1])[0]) for k in pair] for s, pair in zip(sets, counts.tolist())]
            out = []
            for text, form, (a, b) in zip(texts, block.column("form").to_pylist(), offsets):
                if form == "plain":
                    out.append((None, None, text))
                elif form == "psm":
                    out.append((a, b - a, f"{PREFIX}{text[:a]}{SUFFIX}{text[b:]}{MIDDLE}{text[a:b]}"))
                else:
                    out.append((a, b - a, f"{SUFFIX}{text[b:]}{PREFIX}{text[:a]}{MIDDLE}{text[a:b]}"))
            prefix, middle, output = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), pa.array(n), pc.cast(block.column("form"), pa.string()),
                 pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                schema=_SCHEMA)


def transform(docs: DataFrame, seed: int = SEED, transformed: int = TRANSFORMED,
              suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output): every document's transformed text.

    ``n`` counts units. ``form`` is ``psm`` (prefix, suffix, middle), ``spm`` (suffix, prefix, middle) or
    ``plain``, where the text stays as it is: an empty text, one that contains a mark, or one drawn to
    stay. Lengths are in characters and null where the form is plain. Draws depend on the id and
    ``seed`` alone, so rows of one id and text have one output, and any partitioning gives the same rows.
    A null text counts as empty; a null id as one without digits. An empty table gives an empty table.
    A text of any length is cut as a whole. Other columns, whatever their names, are ignored.
    """
    h1, h2, h3, h4 = draws(F.col("doc_id"), seed)
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.col("text").contains(mark)
    plain = (F.col("text") == "") | marked | (h3 % 100 >= transformed)
    form = F.when(plain, "plain").when(h4 % 100 < suffix_first, "spm").otherwise("psm")
    rows = id_and_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    return rows.select("doc_id", "text", h1.alias("h1"), h2.alias("h2"), form.alias("form")).mapInArrow(_cut, _DDL)


def restored(output: Column, form: Column) -> Column:
    """The text a transformed one was made from; its parts contain no mark, so the first marks are the ones written."""
    def split(text, mark):
        head = F.substring_index(text, mark, 1)
        return head, F.substr(text, F.length(head) + F.lit(len(mark) + 1))

    body = F.substr(output, F.lit(len(PREFIX) + 1))
    prefix, rest = split(body, SUFFIX)
    suffix, middle = split(rest, MIDDLE)
    psm = F.concat(prefix, middle, suffix)
    suffix, rest = split(body, PREFIX)
    prefix, middle = split(rest, MIDDLE)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)
