import random
import re

import numpy as np
import pytest

from clickmill.llm import near_dup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_set(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)])


def brute(rows):
    """Component of every id: the least id reachable."""
    ids = sorted({i for i, *_ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t, *_ in rows if i is not None]
    for k, (i, a) in enumerate(sets):
        for j, b in sets[k + 1:]:
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                x, y = find(i), find(j)
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for base in range(12):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([3, 40, 90, 200]))]
        for _ in range(rng.choice([1, 2, 12, 25])):
            copy = list(words)
            for _ in range(rng.choice([0, 1, 2, 3, 5, 9])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy).upper() if rng.random() < 0.3 else "\n ".join(copy)))
    rng.shuffle(rows)
    return [(rng.randrange(10_000), t) if rng.random() < 0.9 else (i, t) for i, t in rows]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_match_brute_force(spark, seed):
    rows = corpus(seed) + [(None, "a b c d e f"), (20_001, None), (20_002, ""), (20_003, "a B"), (20_004, "A b"), (20_005, "a b c d e f")]
    rows += rows[:5] + [(rows[0][0], rows[9][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, kept int").repartition(4)
    # Blocks of four members, so that the last round is put to use.
    found = near_dup.near_duplicates(docs, near_dup.Settings(cell=4)).collect()
    assert len(found) == len(rows)
    expected = brute(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["component_id"] == expected[r["doc_id"]]
            assert r["kept"] == (r["doc_id"] == r["component_id"])
    sizes = sorted(r["n_shingles"] for r in found)
    assert sizes == sorted(len(shingle_set(t)) for _, t in rows)


@pytest.mark.parametrize("settings", [
    near_dup.Settings(cell=4), near_dup.Settings(cell=64), near_dup.Settings(cell_bytes=100)])
def test_last_round_links_all_that_is_near_and_no_more_than_needed(spark, settings):
    """Members of three kinds, none near the bucket's first one."""
    sets = {i: np.unique(np.append(np.arange(40, dtype=np.uint64) + 1000 * (i % 3), [7, i + 50_000]).astype(np.uint64)) for i in range(30)}
    table = spark.createDataFrame([(i, bytes(s)) for i, s in sets.items()], "node long, found binary")
    members = table.selectExpr("1L AS bucket", "node", "node AS component")
    links = [tuple(r) for r in near_dup._across(members, table, settings).collect()]
    found = dict(map(tuple, near_dup.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {i: i % 3 for i in range(30)}
    if settings.cell == 64:
        assert len(links) == 27


def test_a_group_of_2000_near_copies_about_the_limit(spark):
    """Similarities with a median of two thirds, many just above or below the limit."""
    rng, base = random.Random(11), [f"w{i}" for i in range(80)]
    rows = []
    for i in range(2000):
        words = list(base)
        for _ in range(rng.choice([1, 2, 2, 3])):
            words[rng.randrange(len(words))] = f"x{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(words)))
    sets = [shingle_set(t) for _, t in rows]
    sample = [len(a & b) / len(a | b) for a, b in (rng.sample(sets, 2) for _ in range(2000))]
    assert 0.6 < sorted(sample)[1000] < 0.72
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    index, parent = {}, list(range(2000))
    for i, s in enumerate(sets):
        for x in s:
            index.setdefault(x, []).append(i)

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        shared = np.bincount(np.concatenate([index[x] for x in s]), minlength=2000)
        for j in np.flatnonzero(100 * shared >= 75 * (len(s) + np.array([len(t) for t in sets]) - shared)):
            x, y = top(i), top(int(j))
            parent[max(x, y)] = min(x, y)
    assert {r["doc_id"]: r["component_id"] for r in found} == {i: top(i) for i in range(2000)}


def test_a_very_long_text(spark):
    long = " ".join(f"w{i % 60_000}" for i in range(200_000))
    rows = [(1, long), (2, long + " end"), (3, "short text of a few words")]
    found = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["component_id"] for r in found} == {1: 1, 2: 1, 3: 3}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(5000, 4999), (7, 7)]
    found = dict(map(tuple, near_dup.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(found[i] == 0 for i in range(41))
    assert all(found[1000 + i] == 1000 for i in range(60))
    assert found[5000] == found[4999] == 4999


def test_links_join_known_components(spark):
    known = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 3), (9, 8), (8, 8)], "node long, component long")
    links = spark.createDataFrame([(4, 2), (20, 21), (20, 9)], "a long, b long")
    found = sorted(map(tuple, near_dup.joined(known, links).collect()))
    assert found == [(1, 1), (2, 1), (3, 1), (4, 1), (8, 8), (9, 8), (20, 8), (21, 8)]


def test_keep_one(spark):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(5, text, "x"), (3, text.upper(), "y"), (9, "other words", "z"), (None, text, "n"), (4, None, "e")],
        "doc_id long, text string, component_id string")
    kept = near_dup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["component_id"] for r in kept.collect()) == ["e", "n", "y", "z"]
    assert near_dup.near_duplicates(docs.limit(0)).collect() == []
