import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clickmill.llm import alignment

A_PATH, B_PATH = alignment.tokenizer_paths()
ODD = [
    None, "", " ", "  ", "a", " a", "a ", "a  b", "a\tb\n\nc", "\n", "hello world", "<|endoftext|> <s></s> x",
    "a▁b", "▁", "café naïve   x", "　wide 　 wide", "日本語 テキスト", "😀 😀😀 👨‍👩‍👧",
    "don't 's 'S we'll", "x" * 300, "a" + " " * 200 + "b", "=" * 500, "0x1f\x00\x01 \x85 \x1c y", "​ z ᠎ q",
    "مرحبا بالعالم", "﻿bom", "é é", "1234567890 12 34", "word " * 50, "naïve em space",
]


class Plain:
    """The libraries on whole texts, and groups by walking the ends."""

    def __init__(self):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(A_PATH), SentencePieceProcessor(model_file=B_PATH)
        self.a.encode_special_tokens = True
        self.letters = alignment.byte_letters()

    def a_bytes(self, i):
        token = self.a.id_to_token(i)
        return token.encode() if i == 50256 else bytes(self.letters[c] for c in token)

    def b_bytes(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def groups(self, text):
        if not text:
            return []
        a = self.a.encode(" " + text, add_special_tokens=False).ids
        b = self.b.encode(text)
        want = (" " + text).encode()
        if b"".join(map(self.a_bytes, a)) != want or b"".join(map(self.b_bytes, b)) != want:
            return []
        ends_a = np.cumsum([len(self.a_bytes(i)) for i in a]).tolist()
        ends_b = np.cumsum([len(self.b_bytes(i)) for i in b]).tolist()
        found, x, y = [], 0, 0
        for cut in sorted(set(ends_a) & set(ends_b)):
            p, q = ends_a.index(cut) + 1, ends_b.index(cut) + 1
            found.append((a[x:p], b[y:q]))
            x, y = p, q
        return found


@pytest.fixture(scope="module")
def plain():
    return Plain()


def spelled(groups):
    return ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)


def brute(plain, rows):
    links, held = [], Counter()
    for _, text, *_ in rows:
        groups = plain.groups(text)
        found = Counter((x, y) for a, b in groups for x in a for y in b)
        links.append((groups, found))
        held.update(found.keys())
    top = {}
    for (a, _), n in held.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (doc_id, *_), (groups, found) in zip(rows, links, strict=True):
        out.append((
            doc_id, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if held[p] == top[p[0]]), sum(n * held[p] for p, n in found.items()),
            hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else ""))
    return sorted(out, key=repr)


def found(spark, rows, schema="doc_id bigint, text string", **more):
    return sorted(map(tuple, alignment.align(spark.createDataFrame(rows, schema), **more).collect()), key=repr)


def mixed(seed, n=60):
    rng = random.Random(seed)
    words = [t for t in ODD if t] + ["the", "of", "thereby", "Étion", "schön", "ñandú", "x1", ",", "...", "(a)"]
    return [(i, rng.choice(["", " "]) + rng.choice([" ", "  ", "\n", ""]).join(rng.choices(words, k=rng.randint(1, 30))))
            for i in range(n)]


@pytest.mark.parametrize("block_bytes", [alignment.BLOCK_BYTES, 300])
def test_against_brute_force(spark, plain, block_bytes):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(i + 100, t) for i, t in mixed(5)]
    assert found(spark, rows, block_bytes=block_bytes) == brute(plain, rows)


def test_real_texts(spark, plain):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60).collect()]
    assert found(spark, rows) == brute(plain, rows)


def test_groups_are_whole_texts(spark, plain):
    rows = list(enumerate(ODD))
    got = alignment.alignments(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert {r["doc_id"]: r["groups"] for r in got} == {i: spelled(plain.groups(t)) for i, t in rows}


@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from(" \n\t ▁'sab"), st.characters(codec="utf-8")), max_size=40), max_size=6))
@settings(max_examples=150, deadline=None)
def test_pieces_agree_with_whole_texts(texts):
    plain, aligner = _shared()
    solid = [t for t in texts if t]
    if solid:
        pieces, begins = aligner.pieces(solid)
        for k, text in enumerate(solid):
            end = begins[k + 1] if k + 1 < len(begins) else len(pieces)
            parts = [aligner.groups[p] for p in pieces[begins[k]:end]]
            assert ("" if None in parts else ";".join(parts)) == spelled(plain.groups(text))


_SHARED = []


def _shared():
    if not _SHARED:
        _SHARED.extend((Plain(), alignment.Aligner(A_PATH, B_PATH)))
    return _SHARED


def test_wide_groups_are_counted_like_listed_ones(spark, plain, monkeypatch):
    rng = random.Random(1)
    a, b = rng.choices([1, 2, 3], k=20), rng.choices([4, 5], k=30)
    one = alignment.Aligner._expand(*_arrays(a, b))
    monkeypatch.setattr(alignment, "WIDE", 10)
    two = alignment.Aligner._expand(*_arrays(a, b))
    count = lambda x: Counter({p: int(x[2][x[1] == p].sum()) for p in set(x[1].tolist())})
    assert count(one) == count(two)


def _arrays(a, b):
    ones = lambda *x: np.array(x, np.int64)
    return ones(*a), ones(*b), ones(0), ones(0), ones(len(a)), ones(len(b)), ones(len(a) * len(b))


def test_forgetting_changes_nothing(spark, plain, monkeypatch):
    rows = mixed(9)
    monkeypatch.setattr(alignment, "REMEMBERED", 5)
    aligner = alignment.Aligner(A_PATH, B_PATH)
    for _, text in rows:
        pieces, _ = aligner.pieces([text])
        parts = [aligner.groups[p] for p in pieces]
        assert ("" if None in parts else ";".join(parts)) == spelled(plain.groups(text))


def test_very_long_text_repeats_nulls_and_other_columns(spark, plain):
    long = " ".join(random.Random(2).choices(["alpha", "beta", "Étion", "gamma", "x\ty"], k=200_000))
    rows = [(1, long, 0, 0), (1, "alpha beta", 1, 1), (1, "alpha beta", 1, 1), (None, "beta", 1, 1), (2, None, 1, 1)]
    got = found(spark, rows, "doc_id bigint, text string, n_a bigint, block bigint", block_bytes=1 << 16)
    short = brute(plain, [(1, "alpha beta"), (1, "alpha beta"), (None, "beta"), (2, None)])
    assert [r[:5] for r in got if r[1] < 100] == [r[:5] for r in short]
    assert max(r[1] for r in got) >= 200_000


def test_no_rows(spark):
    assert found(spark, []) == []
