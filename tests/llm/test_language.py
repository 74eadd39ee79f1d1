import random
import unicodedata
import zlib

import numpy as np
import pytest

from clickmill.llm import language
from clickmill.llm.language import Settings

SF = "/root/testdata/sf0.01"
SMALL = Settings(dim=128)
SCHEMA = "doc_id bigint, text string, lang string"
WORDS = {
    "en": ["the", "of", "and", "thing", "other"], "de": ["die", "und", "schön", "nicht", "über"],
    "el": ["και", "του", "είναι", "αυτό"],
}


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def plain_vector(text, settings):
    """One n-gram after the other."""
    kept = [c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()]
    words = "".join(kept).split(" ")
    if not any(unicodedata.category(c)[0] == "L" for c in kept):
        return None
    line = " " + " ".join(w for w in words if w) + " "
    line += " " * (settings.gram - len(line))
    letter = lambda c: np.random.default_rng((settings.seed, ord(c))).integers(0, 2, settings.dim, dtype=np.int8) * 2 - 1
    total = np.zeros(settings.dim)
    for k in range(len(line) - settings.gram + 1):
        bound = np.ones(settings.dim)
        for j, c in enumerate(line[k:k + settings.gram]):
            bound = bound * np.roll(letter(c), settings.gram - 1 - j)
        total += bound
    return total


def unit(v):
    return v / np.linalg.norm(v)


def brute(rows, settings):
    sums = {}
    for doc_id, text, lang, *_ in rows:
        vector = None if text is None else plain_vector(text, settings)
        if lang is not None and text is not None and not held(doc_id):
            sums.setdefault(lang, np.zeros(settings.dim))
            if vector is not None:
                sums[lang] += unit(vector)
    langs = sorted(sums)
    prototypes = [unit(sums[x]) if sums[x].any() else sums[x] for x in langs]
    common = np.mean(prototypes, axis=0) if len(langs) > 1 else np.zeros(settings.dim)
    prototypes = [p - common for p in prototypes]
    out = []
    for doc_id, text, *_ in rows:
        vector = None if text is None else plain_vector(text, settings)
        if vector is None or not langs:
            out.append((doc_id, held(doc_id), "und", 0.0))
            continue
        v = unit(vector) - common
        cosines = [v @ p / max(np.linalg.norm(v) * np.linalg.norm(p), 1e-30) for p in prototypes]
        best = int(np.argmax(cosines))
        out.append((doc_id, held(doc_id), langs[best], (1 + cosines[best]) / 2))
    return sorted(out, key=repr)


def predicted(spark, rows, settings=SMALL, schema=SCHEMA):
    docs = spark.createDataFrame(rows, schema)
    return sorted(map(tuple, language.identify(docs, language.learn(docs, settings), settings).collect()), key=repr)


def corpus(seed, n=80):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choice([*WORDS, "en", "en"])
        rows.append((i, rng.choice([" ", "\n", ", "]).join(rng.choices(WORDS[lang], k=rng.randint(1, 40))), lang))
    return rows


def same(got, want):
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-4)


@pytest.mark.parametrize("settings", [SMALL, Settings(dim=64, gram=2), Settings(dim=64, gram=5)])
def test_against_brute_force(spark, settings):
    rows = corpus(1) + [
        (500, None, "en"), (501, "", "en"), (502, "12 + 3!", "de"), (503, "A", None), (504, "é", None),
        (505, "THE Thing OF", None), (506, "हिन्दी में", None), (None, "und die", "de"), (507, " \n", None)]
    same(predicted(spark, rows, settings), brute(rows, settings))


def test_numbered_and_sorted_ngrams_agree(monkeypatch):
    texts = [t for _, t, _ in corpus(6)] + ["日本語のテキスト 漢字", "", "a"]
    one, _ = language.Bundler(SMALL).vectors(texts)
    monkeypatch.setattr(language, "CODES", 0)
    two, _ = language.Bundler(SMALL).vectors(texts)
    assert np.array_equal(one, two) and one.any(axis=1).sum() == len(texts) - 1


def test_many_ngrams_and_a_very_long_text(spark, monkeypatch):
    monkeypatch.setattr(language, "GRAMS_AT_ONCE", 10)
    rng = random.Random(4)
    texts = ["".join(rng.choices("abcdefgh ", k=300)), "the of and " * 5]
    vectors, spoken = language.Bundler(SMALL).vectors(texts)
    assert spoken.all() and np.array_equal(vectors, [plain_vector(t, SMALL) for t in texts])
    long = "the other thing and " * 100_000
    rows = corpus(2) + [(900, long, None)]
    got = {r[0]: r[2] for r in predicted(spark, rows)}
    assert got[900] == "en"


def test_languages_are_told_apart_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = language.identify(docs, language.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    tested = [r for r in found if r["held_out"]]
    assert len(tested) > 100
    assert sum(r["lang_pred"] == r["lang"] for r in tested) / len(tested) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found)


def test_labels_ids_and_sources_are_no_inputs(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA)
    profiles = language.learn(docs, SMALL)
    moved = spark.createDataFrame([(i + 7, t, "xx") for i, t, _ in rows], SCHEMA)
    text = {(i, t): p for i, _, p, _ in map(tuple, language.identify(docs, profiles, SMALL).collect()) for j, t, _ in rows if i == j}
    again = {i - 7: p for i, _, p, _ in map(tuple, language.identify(moved, profiles, SMALL).collect())}
    assert {i: p for (i, _), p in text.items()} == again
    changed = [(i, t, "zz" if held(i) else lang) for i, t, lang in rows]
    other = language.learn(spark.createDataFrame(changed, SCHEMA), SMALL)
    assert other.langs == profiles.langs and np.array_equal(other.prototypes, profiles.prototypes)


def test_ties_repeats_and_other_columns(spark):
    rows = [(1, "same words here", "b", 5, 0.5), (3, "same words here", "a", 5, 0.5), (3, "same words here", "a", 6, 0.5)]
    got = predicted(spark, rows, schema=SCHEMA + ", part int, score double")
    learned = {lang for i, _, lang, *_ in rows if not held(i)}
    assert {r[2] for r in got} == {min(learned)} and len(got) == 3


def test_nothing_learned_and_no_rows(spark):
    assert predicted(spark, []) == []
    assert predicted(spark, [(1, "text", None), (2, None, None)]) == [(1, held(1), "und", 0.0), (2, held(2), "und", 0.0)]


def test_one_language(spark):
    rows = [(1, "the thing", "en"), (3, "other thing", "en"), (9, "x", None)]
    assert {r[2] for r in predicted(spark, rows)} == {"en"}
