import hashlib
import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from clickmill.llm import decontaminate as dc

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items):
    windows = {}
    for i, text in items:
        w = words(text)
        for k in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[k:k + 10]), set()).add(i)
    out = []
    for doc_id, text in docs:
        w, hit, ids = words(text), set(), set()
        for size in {len(x) for x in windows}:
            for k in range(len(w) - size + 1):
                if tuple(w[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    ids |= windows[tuple(w[k:k + size])]
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]


def corpus():
    rng = random.Random(5)
    make = lambda n: " ".join(rng.choice("abcdef") for _ in range(n))
    items = [(i, make(rng.choice([3, 9, 10, 11, 30]))) for i in range(12)]
    items += [(20, ""), (21, None), (None, make(14)), (3, make(25)), (22, items[4][1]), (23, "É1 ß,x-Y z")]
    docs = [(i, make(rng.randint(0, 80))) for i in range(60)]
    for i in range(30):
        text = rng.choice(items)[1] or ""
        docs.append((100 + i, make(7) + " " + text.upper().replace(" ", ", ") + " " + make(5)))
    docs += [(None, items[4][1]), (1, None), (1, ""), (2, "!!"), (100, docs[-1][1]), (100, docs[-1][1])]
    return docs, items


def test_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = corpus()
    rows = spark.createDataFrame([(*d, 9) for d in docs], "doc_id long, text string, n_hit int").repartition(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    for block in (1 << 20, 60):
        found = dc.report(dc.matches(rows, bench, block)).select(*COLUMNS).collect()
        assert sorted(map(tuple, found), key=repr) == brute(docs, items)


def test_clean_drops_exactly_the_hit_rows(spark):
    docs, items = corpus()
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    good = {text for doc_id, text in docs if not brute([(doc_id, text)], items)[0][-1]}
    for block in (1 << 20, 60):
        kept = dc.clean(rows, bench, block).collect()
        assert {r["text"] for r in kept} == good
        assert len(kept) == sum(text in good for _, text in docs)


def test_longest_match(spark):
    item = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"w{i}" for i in range(5, 30)) + " z")], "doc_id long, text string")
    bench = spark.createDataFrame([(7, item)], "item_id long, text string")
    row = dc.report(dc.matches(docs, bench)).first()
    assert (row["longest_words"], row["longest_start"], row["longest_item"], row["n_hit"]) == (25, 2, "7", 25)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    bench = spark.createDataFrame([], "item_id long, text string")
    assert dc.report(dc.matches(docs, bench)).first()["contaminated"] is False
    assert dc.clean(docs, bench).count() == 1
    assert dc.report(dc.matches(docs.limit(0), bench)).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 12))
def test_suffix_array(tokens, depth):
    tokens = np.array([*tokens, 0])
    found = dc.suffix_array(tokens, depth)

    def upto(i):
        end = next(j for j in range(i, len(tokens)) if tokens[j] == 0)
        return tuple(tokens[i:min(end, i + depth)])

    assert sorted(found) == [i for i in range(len(tokens)) if tokens[i] > 0]
    assert [upto(i) for i in found] == sorted(upto(i) for i in found)


def test_a_document_longer_than_a_shard(spark):
    passage = " ".join(f"q{i}" for i in range(12))
    text = "filler word " * (dc.SHARD_WORDS // 2) + passage + " end"
    docs = spark.createDataFrame([(1, text), (2, "other")], "doc_id long, text string")
    bench = spark.createDataFrame([("b", passage), ("c", None), ("d", "")], "item_id string, text string")
    found = {r["doc_id"]: r for r in dc.report(dc.matches(docs, bench)).collect()}
    assert (found[1]["n_hit"], found[1]["n_items"], found[1]["n_words"]) == (12, 1, dc.SHARD_WORDS + 13)
    assert not found[2]["contaminated"]


def test_blocks_hold_all_items_once(spark):
    bench = spark.createDataFrame([(f"i{k}", f"word{k} " * 30) for k in range(40)] + [("x", "..."), ("y", None)], "item_id string, text string")
    whole = [i for b in dc.item_blocks(bench) for i in b.item_ids]
    parted = list(dc.item_blocks(bench, 1000))
    assert len(parted) > 5 and sorted(i for b in parted for i in b.item_ids) == whole == sorted(f"i{k}" for k in range(40))
