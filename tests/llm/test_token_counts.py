import json

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from clickmill.llm import token_counts as tc

TEXTS = [
    (1, "Hello  world, it's 2024!"), (2, None), (3, ""), (4, " \n\t"), (None, "Hello world, it's 2024!"),
    (5, "<|endoftext|> a <|startoftext|>x"), (6, "Straße ÉCOLE é ΣΑΣ 😀"), (7, "Hello\nworld, it's 2024!  "),
    (7, "another text of row 7"), (8, "word " * 2500), (8, "word " * 2500), (9, "a b\x1cc d"),
]


@pytest.fixture
def docs(spark):
    return spark.createDataFrame([(i, t, 0) for i, t in TEXTS], "doc_id long, text string, n_tokens int")


def expected(path=None):
    t = Tokenizer.from_file(path or tc.tokenizer_path())
    out = []
    for i, x in TEXTS:
        n = len(t.encode(x or "", add_special_tokens=False))
        out.append((i, len((x or "").encode()), n, n > 2048))
    return sorted(out, key=repr)


def test_counts_are_the_librarys(spark, docs, tmp_path):
    found = tc.count_tokens(docs, str(tmp_path / "c"))
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected()


def test_only_distinct_misses_are_encoded_and_appended(spark, docs, tmp_path):
    cache = str(tmp_path / "c")
    tc.count_tokens(docs, cache).collect()
    stored = spark.read.parquet(cache)
    # Texts that differ in white space only, and repeated ones, share an entry.
    assert stored.count() == stored.select("content", "version").distinct().count() == 7
    tc.count_tokens(docs, cache).collect()
    assert spark.read.parquet(cache).count() == 7
    more = docs.union(spark.createDataFrame([(99, "quite new", 0)], docs.schema))
    assert tc.count_tokens(more, cache).count() == len(TEXTS) + 1
    assert spark.read.parquet(cache).count() == 8


def test_a_stored_count_is_used(spark, docs, tmp_path):
    cache = str(tmp_path / "c")
    tc.count_tokens(docs, cache).collect()
    changed = spark.read.parquet(cache).selectExpr("content", "version", "7L AS n_tokens")
    changed.write.parquet(str(tmp_path / "d"))
    assert {r["n_tokens"] for r in tc.count_tokens(docs, str(tmp_path / "d")).collect()} == {7}


def test_another_tokenizer_file_shares_nothing(spark, docs, tmp_path):
    cache = str(tmp_path / "c")
    tc.count_tokens(docs, cache).collect()
    other = tc.tokenizer_path("byte_bpe_50k.json")
    found = tc.count_tokens(docs, cache, other)
    assert sorted(map(tuple, found.collect()), key=repr) == expected(other)
    assert spark.read.parquet(cache).select("version").distinct().count() == 2


def test_empty_table(spark, docs, tmp_path):
    assert tc.count_tokens(docs.limit(0), str(tmp_path / "c")).collect() == []


def test_a_full_memory_and_long_runs_change_nothing(monkeypatch):
    monkeypatch.setattr(tc, "REMEMBERED", 3)
    monkeypatch.setattr(tc, "SHORT", 4)
    t, counter = Tokenizer.from_file(tc.tokenizer_path()), tc.Counter(tc.tokenizer_path())
    texts = ["a b c d e", "a lengthyword b", "f g h i a", "", "a lengthyword lengthyword é1\x1cx"] * 2
    assert [counter.counts(pa.array([x]))[0] for x in texts] == [len(t.encode(x, add_special_tokens=False)) for x in texts]
    assert not any(len(r) > 4 for r in counter.known)


_SHARED = []


@given(st.lists(st.text(alphabet=st.one_of(
    st.sampled_from(" \t\n\r\x0b\x0c\x1c\x85\xa0.'sΣ<|>"), st.characters(codec="utf-8")), max_size=30), max_size=8))
@settings(max_examples=200, deadline=None)
def test_runs_add_up_to_the_librarys_counts(texts):
    if not _SHARED:
        _SHARED.extend((Tokenizer.from_file(tc.tokenizer_path()), tc.Counter(tc.tokenizer_path())))
    whole, counter = _SHARED
    texts = [*texts, "x <|endoftext|> y"]
    found = counter.counts(pa.array([*texts, None], pa.string())).tolist()
    assert found == [len(whole.encode(t, add_special_tokens=False)) for t in texts] + [0]


def test_a_part_of_a_longer_array():
    counter = tc.Counter(tc.tokenizer_path())
    texts = pa.array(["one two", "three", None, "four five six"])
    assert counter.counts(texts.slice(1, 3)).tolist() == [1, 0, 3]
    assert counter.counts(texts.slice(2, 1)).tolist() == [0] and counter.counts(texts.slice(4)).tolist() == []


def test_whether_a_tokenizer_parts_at_space_is_read_from_its_file():
    with open(tc.tokenizer_path(), encoding="utf-8") as file:
        own = json.load(file)
    assert tc.parts_at_space(json.dumps(own))
    with open(tc.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as file:
        assert not tc.parts_at_space(file.read())
    first = own["pre_tokenizer"]["pretokenizers"][0]
    for change in (
        {"normalizer": {"type": "Strip"}},
        {"pre_tokenizer": None},
        {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [first | {"behavior": "Isolated"}]}},
        {"pre_tokenizer": first | {"pattern": {"Regex": r"\w+ ?"}}},
        {"added_tokens": [own["added_tokens"][0] | {"lstrip": True}]},
    ):
        assert not tc.parts_at_space(json.dumps(own | change))


def test_a_very_long_text(spark, tmp_path):
    text = "alpha beta, gamma\n" * 300_000
    found = tc.count_tokens(spark.createDataFrame([(1, text)], "doc_id long, text string"), str(tmp_path / "c")).collect()
    assert tuple(found[0]) == (1, len(text), 1_200_000, True)
