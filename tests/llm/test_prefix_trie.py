import hashlib
import random
import zlib

import numpy as np
import pytest

from clickmill.llm import prefix_trie
from clickmill.llm.prefix_trie import Settings

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def brute(rows, splice=True):
    own = {}
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    built = own
    if splice:
        built = {}
        for c, turns in own.items():
            h = zlib.crc32(str(c).encode()) % 6
            built[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    members, ends = {}, {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    found = []

    def below(node):
        leaves, saved = 0 if children.get(node) else 1, (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        for child in children.get(node, []):
            more = below(child)
            leaves, saved = leaves + more[0], saved + more[1]
        found.append((
            min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
            len(children.get(node, [])), leaves, saved,
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()))
        return leaves, saved

    if members:
        below(())
    return sorted(found, key=repr)


def trie(spark, rows, splice=True, schema=SCHEMA, **settings):
    frame = spark.createDataFrame(rows, schema)
    found = prefix_trie.prefix_trie(frame, prefix_trie.by_hundreds() if splice else None, Settings(**settings))
    return sorted(map(tuple, found.collect()), key=repr)


def talk(seed, convs):
    """Conversations of few different turns, a third of them copies of one."""
    rng = random.Random(seed)
    rows = []
    for c in convs:
        if rng.random() < 0.3:
            turns = [("user", "hello"), ("assistant", "héllo 😀"), ("user", "bye"), ("assistant", "so long")]
        else:
            turns = [(rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bb", "", None, "ccc"]))
                     for _ in range(rng.randint(1, 7))]
        rows += [(c, t if t or rng.random() < 0.5 else None, *turn) for t, turn in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed, most", [(1, 4096), (2, 3), (3, 2)])
def test_against_brute_force(spark, seed, most):
    """Also with layers of few conversations, shards of few nodes and short ranges of ids."""
    rows = talk(seed, random.Random(seed).sample(range(700), 150))
    assert trie(spark, rows, most=most, shard=40, ids=7) == brute(rows)
    assert trie(spark, rows, splice=False, most=most, shard=40, ids=7) == brute(rows, splice=False)


def test_leading_conversation_absent_and_turnless_rebuilds(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(101, 140) for t in range(c % 4 + 1)]
    found = trie(spark, rows, most=4)
    assert found == brute(rows)
    assert any(d == 0 and n == 39 for _, d, _, n, *_ in found)


def test_one_very_long_conversation_holds_a_third_of_the_rows(spark):
    rows = [(5, t, "user", f"t{t}") for t in range(3000)] + [(c, t, "user", f"t{t}") for c in range(100, 1100) for t in range(6)]
    found = trie(spark, rows, splice=False, shard=500)
    deepest = max(found, key=lambda r: r[1])
    assert deepest[:6] == (5, 3000, 5, 1, 0, 1)
    root = next(r for r in found if r[1] == 0)
    assert root[3:6] == (1001, 1, 1)
    assert root[6] == sum(1000 * len(f"t{t}") for t in range(6))


def test_ties_repeats_nulls_and_other_columns(spark):
    rows = [(1, 0, "b", "x", 9, 9), (1, 0, "a", "y", 9, 9), (1, 0, "a", "y", 8, 8), (2, None, None, None, 1, 1),
            (None, 0, "user", "lost", 1, 1), (3, 0, "a", "y", 1, 1)]
    schema = SCHEMA + ", n1 bigint, depth bigint"
    assert trie(spark, rows, splice=False, schema=schema) == brute(rows, splice=False)


def test_no_conversations(spark):
    assert trie(spark, []) == []
    assert trie(spark, [(None, 1, "user", "x")]) == []


def test_same_digest_needs_the_same_role_and_text(spark):
    rows = [(1, 0, "ab", "c"), (2, 0, "a", "bc"), (3, 0, "", "abc"), (4, 0, "ab", "c")]
    assert trie(spark, rows, splice=False) == brute(rows, splice=False)


def test_slots_are_minimal_perfect_and_verified():
    rng = np.random.default_rng(3)
    one, two = rng.integers(-(1 << 62), 1 << 62, (2, 50_000))
    two[:1000] = two[0]
    slots = prefix_trie.Slots(one, two)
    assert sorted(slots.slots) == list(range(50_000))
    assert (slots.find(one, two) == slots.slots).all()
    assert (slots.find(one + 1, two) == -1).all()
    assert (slots.find(one, two ^ 1) == -1).all()
