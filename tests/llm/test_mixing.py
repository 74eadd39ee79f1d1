import random

import pytest

from clickmill.llm import mixing


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by sharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in names}
    for _ in range(1000):
        over = {s for s in names if target[s] >= cap * sizes[s]}
        excess = sum(target[s] - cap * sizes[s] for s in over)
        open_ = [s for s in names if s not in over]
        if excess < 1e-9 or not open_:
            break
        for s in over:
            target[s] = cap * sizes[s]
        for s in open_:
            target[s] += excess * weight[s] / sum(weight[t] for t in open_)
    return target


@pytest.fixture
def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(900):
        source = "big" if i % 3 == 0 else rng.choice(["a", "b", "c", "tiny", None, "é", "z"])
        if source == "tiny" and i % 10:
            source = "z"
        words = rng.choice([0, 1, 5, 20, 20, 60, 60, 300])
        rows.append((i, " ".join("w" * rng.randint(1, 4) for _ in range(words)), source, 0.5))
    rows += [(5000, "same row here", "a", 1.0)] * 40 + [(None, "x y", "b", 1.0)] * 5 + [(6000, None, "a", 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, target double")


def by_source(docs, found):
    source = {}
    for r in docs.collect():
        source[r["doc_id"]] = r["source"]
    out = {}
    for r in found:
        out.setdefault(source[r["doc_id"]], []).append(r)
    return out


def test_targets_and_words_taken(spark, docs):
    found = mixing.mix(docs, block=16).collect()
    assert len(found) == docs.count()
    groups = by_source(docs, found)
    sizes = {s: sum(r["size"] for r in rows) for s, rows in groups.items()}
    expected = water(sizes)
    for source, rows in groups.items():
        assert {r["source_size"] for r in rows} == {sizes[source]}
        assert all(r["target"] == pytest.approx(expected[source]) for r in rows)
        mean = sizes[source] / max(1, sum(r["size"] > 0 for r in rows))
        assert abs(sum(r["taken"] for r in rows) - expected[source]) <= max(4 * mean, 60)
        for r in rows:
            assert r["taken"] <= 3 * r["size"]
            copies = r["taken"] / r["size"] if r["size"] else int(expected[source] / sizes[source])
            assert copies == int(copies) and abs(copies - expected[source] / sizes[source]) < 1


def test_reruns_agree_however_the_rows_lie(spark, docs):
    one = sorted(map(tuple, mixing.mix(docs, block=16).collect()), key=repr)
    two = sorted(map(tuple, mixing.mix(docs.repartition(7), block=16).collect()), key=repr)
    assert one == two


def test_chance_is_fair(spark):
    docs = spark.createDataFrame(
        [(i, " ".join(["w"] * (1 + i % 7)), s) for i in range(200) for s in ("a", "b")], "doc_id long, text string, source string")
    up = {}
    for seed in range(12):
        for r in mixing.mix(docs.where("doc_id < 60"), block=8, seed=1000 * seed).collect():
            up.setdefault((r["doc_id"], r["target"]), []).append(r["taken"] / r["size"])
    for target in {t for _, t in up}:
        rows = [sum(v) / len(v) for (_, t), v in up.items() if t == target]
        size = next(r["source_size"] for r in mixing.mix(docs.where("doc_id < 60"), block=8).collect() if r["target"] == target)
        assert sum(rows) / len(rows) == pytest.approx(target / size, abs=0.1)


def test_pairwise_moves_end_in_whole_numbers(spark):
    units = spark.range(500).selectExpr(
        "'s' AS source", "id AS doc_id", "1 + id % 9 AS size", "0L AS copy", "0.37 AS mass", "500L AS units")
    found = mixing.round_up(units, 500, 16).collect()
    assert sorted(r["doc_id"] for r in found) == list(range(500))
    assert {r["up"] for r in found} == {0, 1}
    goal = 0.37 * sum(1 + i % 9 for i in range(500))
    assert abs(sum(r["up"] * r["size"] for r in found) - goal) <= 9


def test_nothing_to_mix(spark, docs):
    assert mixing.mix(docs.limit(0)).collect() == []
    bare = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["source_size"], r["taken"]) for r in mixing.mix(bare).collect()) == [
        (1, 0, 0, 0), (2, 0, 0, 0)]


def test_no_python_in_the_plan(spark, docs):
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_very_long_text_is_one_unit(spark):
    rows = [(1, "word " * 200_000, "a")] + [(i, "a few words more", "a") for i in range(2, 40)] + [(50, "x " * 100_000, "b")]
    found = {r["doc_id"]: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()}
    assert found[1]["size"] == 200_000 and found[1]["taken"] % 200_000 == 0 and found[1]["taken"] <= 600_000
    assert len(found) == 40


@pytest.mark.parametrize("range_rows", [1, 7, 10_000])
def test_targets_of_many_sources_by_ranges(spark, range_rows):
    """Running sums over ranges of sources give the targets of sharing the excess out, in any number of ranges."""
    rng = random.Random(range_rows)
    names = [None, "", "é", "Z", "z"] + [f"s{rng.randint(0, 9999):04d}" for _ in range(60)]
    sizes = {n: rng.choice([0, 1, 7, 7, 50, 400, 5000]) for n in names}
    frame = spark.createDataFrame([(i, n, s) for i, (n, s) in enumerate(sizes.items())], "doc_id long, source string, size long")
    found = {r["source"]: r for r in mixing.targets(frame, range_rows=range_rows).collect()}
    expected = water(sizes)
    assert found.keys() == sizes.keys()
    assert all(found[s]["target"] == pytest.approx(expected[s], abs=1e-6) for s in sizes)
    assert all(found[s]["source_size"] == sizes[s] for s in sizes)
    assert mixing.targets(frame.limit(0), range_rows=range_rows).collect() == []
