"""Words, texts with copies, and brute-force versions shared by the tests."""

import random
import re

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text, lower=False):
    text = text or ""
    if lower:
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
    return [w for w in SPACE.split(text) if w]


def by_id(df, key="doc_id"):
    return {r[key]: r for r in df.collect()}


def prose(seed, count, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}{rng.choice(['', 'é', 'ß', ','])}" for _ in range(count)]


def corpus(seed=3, documents=60):
    """Texts with exact copies, near copies, shared passages, blanks and odd white space."""
    rng = random.Random(seed)
    passage, line = prose(1000, 70), prose(1001, 30)
    out = []
    for i in range(documents):
        kind = i % 6
        if kind == 1 and out:
            out.append(out[rng.randrange(len(out))])
            continue
        own = prose(seed * 1000 + i, rng.randrange(1, 180))
        if kind == 2 and out:
            own = words(out[rng.randrange(len(out))])
            for _ in range(max(1, len(own) // 60)):
                if own:
                    own[rng.randrange(len(own))] = f"new{rng.randrange(9999)}"
        if kind == 3:
            own = own[:40] + passage + own[40:]
        if kind == 4:
            own = own + line + own[:5]
        out.append(rng.choice([" ", "  ", "\n", "\t "]).join(own))
    return [(i, t) for i, t in enumerate(out)] + [
        (documents, None), (documents + 1, ""), (documents + 2, " \n "), (documents + 3, ""),
        (documents + 4, "one"), (documents + 5, "One"), (documents + 6, "a b c d"), (documents + 7, "a b c e")]


ODD = [(5, "same text here"), (5, "same text here"), (5, "another text"), (None, "same text here"), (None, None),
       (7, "x" * 20000 + " tail"), (8, ""), (None, "")]
