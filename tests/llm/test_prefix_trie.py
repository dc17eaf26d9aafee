import hashlib
import random
import re
import zlib

import pytest

from cadenza.llm.prefix_trie import end_digests, ordered_turns, prefix_trie, with_prefixes, with_shared_starts

COLUMNS = "conv_id bigint, turn bigint, role string, text string, node string, depth string, words string"
SPACE = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture
def make(spark):
    """A conversations table with extra, clashing columns."""
    return lambda rows: spark.createDataFrame([(*r, "a", "b", "c") for r in rows], COLUMNS)


def sequences(rows):
    found = {}
    for c, turn, role, text in rows:
        if c is not None:
            found.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(turns)] for c, turns in found.items()}


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - c % 20, [])[:h] + turns[h:]
    return out


def brute(conversations):
    members = {}
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), set()).add(c)
    children, leaves, saved = ({v: 0 for v in members} for _ in range(3))
    for v, cs in members.items():
        words = len([w for w in SPACE.split(v[-1][1]) if w]) if v else 0
        if v:
            children[v[:-1]] += 1
        for d in range(len(v) + 1):
            saved[v[:d]] += (len(cs) - 1) * words
    for v in members:
        for d in range(len(v) + 1):
            leaves[v[:d]] += children[v] == 0
    return sorted((min(cs), len(v), min(members[v[:-1]]) if v else -1, len(cs), children[v], leaves[v], saved[v], hashlib.sha256(
        ",".join(map(str, sorted(c for c in cs if len(conversations[c]) == len(v)))).encode()).hexdigest())
        for v, cs in members.items())


def rows_of(trie):
    return sorted(tuple(-1 if x is None else x for x in r) for r in trie.drop("words").collect())


def check(df, rows, shared=True, **options):
    turns = ordered_turns(df, options.get("max_group"))
    ids, moved = with_shared_starts(turns) if shared else (turns.select("conv_id").distinct(), turns)
    wanted = brute(rebuilt(sequences(rows)) if shared else sequences(rows))
    assert rows_of(prefix_trie(ids, moved, **options)) == wanted


def talks(seed, count, longest=14):
    """Conversations of few different turns, so that they share prefixes, end inside others, and are equal."""
    rng = random.Random(seed)
    rows = []
    for c in rng.sample(range(count * 2), count):
        for turn in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 9, rng.randrange(longest)])):
            rows.append((c, turn, rng.choice(["user", "user", None]), rng.choice(["a b", "a b", "a b", " c\td  e ", None])))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block_turns", [1, 2, 4, 50])
def test_against_brute_force(make, block_turns):
    rows = talks(block_turns, 70)
    check(make(rows), rows, block_turns=block_turns)


def test_without_shared_starts(make):
    rows = talks(9, 40)
    check(make(rows), rows, shared=False)


def test_long_conversations_in_ranges(make):
    rows = talks(3, 30) + [(c, i, "user", f"t{i if i < 40 or c < 500 else -i}") for c in (500, 499, 333) for i in range(60)]
    check(make(rows), rows, max_group=7)


def test_odd_rows(make):
    rows = [(None, 1, "user", "lost"), (3, None, "user", "b"), (3, None, None, None), (3, 5, "user", "x " * 50000),
            (3, 5, "user", "x " * 50000), (4, 1, "", ""), (-7, 1, "user", "n"), (-7, 2, "user", "m"), (21, 1, "user", "q"),
            (44, 1, "r", "s"), (45, 1, "r", "s"), (1 << 40, 0, "a", "b")]
    # the remainder of a negative id has its sign
    own = sequences(rows)
    moved = {c: own.get(c - (c % 20 if c >= 0 else -(-c % 20)), [])[:zlib.crc32(str(c).encode()) % 4]
             + own[c][zlib.crc32(str(c).encode()) % 4:] for c in own}
    ids, turns = with_shared_starts(ordered_turns(make(rows)))
    assert rows_of(prefix_trie(ids, turns)) == brute(moved)


def test_all_turnless_and_empty(make):
    # ids whose first turns are replaced by those of a conversation that does not exist
    lone = [c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 0][:5]
    rows = [(c, 0, "user", "gone") for c in lone]
    check(make(rows), rows)
    ids, turns = with_shared_starts(ordered_turns(make([])))
    assert prefix_trie(ids, turns).count() == 0


def test_role_and_text_do_not_run_together(make):
    rows = [(40, 0, "ab", "c"), (60, 0, "a", "bc"), (80, 0, "", "abc")]
    check(make(rows), rows, shared=False)


def test_many_ids_end_at_one_node(spark):
    ids = list(range(0, 30000, 7))
    found = end_digests(spark.createDataFrame([("x", i) for i in reversed(ids)] + [("y", 5)], "node string, conv_id bigint"))
    assert {r["node"]: r["ends_sha256"] for r in found.collect()} == {
        n: hashlib.sha256(",".join(map(str, i)).encode()).hexdigest() for n, i in (("x", ids), ("y", [5]))}


def test_prefix_names_follow_content_and_order(make):
    rows = [(1, 0, "u", "a"), (1, 1, "u", "b"), (2, 0, "u", "b"), (2, 1, "u", "a"), (3, 0, "u", "a"), (3, 1, "u", "b")]
    names = {(r["conv_id"], r["depth"]): r["node"] for r in with_prefixes(ordered_turns(make(rows))).collect()}
    assert names[1, 2] == names[3, 2] != names[2, 2] and names[1, 1] == names[3, 1] != names[2, 1]
