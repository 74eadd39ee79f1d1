import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from clickmill.llm import rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {k + d for k in range(len(words) - 2) for d in range(3) if windows[tuple(words[k:k + 3])] > 1}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(hit))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab# \n\t\r\x0b\x1cß ", max_size=60))
def test_counts_match_brute_force(text):
    assert rules.text_counts(text)[:5] == brute(text)


def planted(n=900):
    rng = np.random.default_rng(0)
    values = {name: rng.random(n) for name in rules.FEATURES}
    bad = (values["symbols_per_word"] > 0.7) & (values["upper_share"] > 0.5)
    bad |= values["repeated_share"] > 0.9
    return values, bad


def test_learns_planted_conjunctions():
    values, bad = planted()
    found = rules.learn(values, bad)
    hit = np.zeros(len(bad), bool)
    for rule in found:
        hit |= rules._covered(values, rule, len(bad))
    assert (hit == bad).mean() > 0.97
    assert any(len(rule) == 2 for rule in found)
    assert rules.learn(values, bad) == found


def test_conditions_are_merged_and_any_may_be_dropped():
    values, bad = planted()
    above = lambda name, cut: rules.Condition(name, True, cut)
    loose, tight, top = above("repeated_share", 0.2), above("repeated_share", 0.9), rules.Condition("repeated_share", False, 0.99)
    merged = rules._merged((loose, top, tight, rules.Condition("repeated_share", False, 0.995)))
    assert merged == (tight, top)
    useless = above("digit_share", 0.3)
    everywhere = np.ones(len(bad), bool)
    for rule in ((useless, tight), (tight, useless), (above("words", 0.1), tight, useless)):
        assert rules._pruned(values, rule, bad, everywhere) == (tight,)
    both = above("symbols_per_word", 0.7), above("upper_share", 0.5)
    assert rules._pruned(values, both, bad, everywhere) == both
    assert all(len({(c.feature, c.above) for c in rule}) == len(rule) for rule in rules.learn(values, bad))


def test_noise_makes_no_rule():
    rng = np.random.default_rng(1)
    values = {name: rng.random(300) for name in rules.FEATURES}
    assert rules.learn(values, rng.random(300) < 0.1) == []
    assert rules.learn(values, np.zeros(300, bool)) == []


@pytest.fixture
def docs(spark):
    clean = [(i, " ".join(f"w{(i * 7 + k * k) % 997}" for k in range(60)), "x") for i in range(120)]
    junk = [(1000 + i, " ".join(f"w{(i * 5 + k * k) % 991}###" for k in range(60)), "x") for i in range(120)]
    return spark.createDataFrame(clean + junk, "doc_id long, text string, kept string")


def test_list_becomes_a_conditional(spark, docs):
    labels = docs.selectExpr("doc_id", "cast(doc_id < 1000 AS int) AS quality")
    found = rules.judge(docs, labels).collect()
    assert len(found) == 240
    assert all(r["kept"] == (r["doc_id"] < 1000) for r in found)
    assert all((r["rule"] is None) == (r["doc_id"] < 1000) for r in found)


def test_held_out_labels_are_not_read(spark, docs):
    labels = docs.selectExpr("doc_id", "cast(doc_id < 1000 AS int) AS quality")
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    stats = rules.statistics(docs)
    assert rules.fit(stats, labels) == rules.fit(stats, flipped)


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame(
        [(None, text), (1, None), (1, ""), (2, " \n"), (3, text), (3, text), (4, "a b c " * 40)], "doc_id long, text string")
    labels = spark.createDataFrame([(None, 1), (3, None), (3, 1), (3, 0)], "doc_id long, quality int")
    found = rules.judge(docs, labels).collect()
    assert len(found) == 7
    assert all(r["kept"] == (r["n_words"] == 60) for r in found)
    assert sorted(r["n_words"] for r in found) == [0, 0, 0, 60, 60, 60, 120]
    assert all(r["base_failed"] for r in found if r["n_words"] != 60)
    assert rules.judge(docs.limit(0), labels.limit(0)).collect() == []


def test_a_very_long_text_is_counted_whole(spark):
    text = "one two three four five\n" * 60_000
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    found = rules.judge(docs, labels).collect()[0]
    assert (found["n_words"], found["n_dup_lines"], found["n_repeat_words"]) == (300_000, 59_999, 300_000)
    assert found["base_failed"] and not found["kept"]
