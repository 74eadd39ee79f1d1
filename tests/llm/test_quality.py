import random
import zlib

import numpy as np
from hypothesis import given, settings, strategies as st

from clickmill.llm import quality

SMALL = quality.Settings(buckets_log2=12, epochs=4, sample_rows=500)


def corpus(spark, n=240):
    rng = random.Random(1)
    good = ["the", "house", "river", "stone", "walks", "slowly", "green", "table"]
    docs, labels = [], []
    for i in range(n):
        junk = i % 4 == 0
        words = [rng.choice(good) + ("$$$" if junk else "") for _ in range(rng.randint(20, 60))]
        docs.append((i, " ".join(words), "x"))
        labels.append((i, 0 if junk else 1))
    return (spark.createDataFrame(docs, "doc_id long, text string, score string"),
            spark.createDataFrame(labels, "doc_id long, quality int"))


def test_held_out_accuracy(spark):
    docs, labels = corpus(spark)
    found = quality.score(docs, quality.train(docs, labels, SMALL)).join(labels, "doc_id").collect()
    out = [r for r in found if r["held_out"]]
    assert len(out) > 30
    assert {r["doc_id"]: r["held_out"] for r in found} == {
        i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(240)}
    assert sum(r["predicted"] == r["quality"] for r in out) / len(out) > 0.97
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 for r in found)


def test_accept_agrees_with_score_and_keeps_columns(spark):
    docs, labels = corpus(spark)
    model = quality.train(docs, labels, SMALL)
    good = {r["doc_id"] for r in quality.score(docs, model).where("predicted = 1").collect()}
    kept = quality.accept(docs, model)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == good


def test_training_is_repeatable_and_reads_no_held_out_label(spark):
    docs, labels = corpus(spark, 80)
    one = quality.train(docs, labels, SMALL)
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality")
    two = quality.train(docs.repartition(5), flipped, SMALL)
    assert np.array_equal(one.weights, two.weights) and one.bias == two.bias


def test_odd_rows(spark):
    docs, labels = corpus(spark, 80)
    model = quality.train(docs, labels, SMALL)
    odd = spark.createDataFrame(
        [(None, "the house"), (1, None), (1, ""), (2, " \n\t "), (2, "x" * 700_000), (2, "x" * 700_000)],
        "doc_id long, text string")
    found = quality.score(odd, model).collect()
    assert len(found) == 6
    assert len({r["score"] for r in found[1:4]}) == 1
    assert found[4]["score"] == found[5]["score"]
    assert found[0]["held_out"] is False
    assert quality.score(odd.limit(0), model).collect() == []
    assert quality.train(docs, labels.limit(0), SMALL).weights.any() == np.False_
    assert quality.train(docs.limit(0), labels, SMALL).weights.any() == np.False_


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(alphabet="ab \nß😀", max_size=40), min_size=1, max_size=6))
def test_texts_are_scored_alike_alone_and_together(texts):
    rng = np.random.default_rng(0)
    model = quality.Model(rng.normal(size=1 << 12).astype(np.float32), 0.25, SMALL)
    together = quality.logits(texts, model)
    for text, whole in zip(texts, together, strict=True):
        buckets, counts = quality.features(text, SMALL)
        mean = (model.weights[buckets] * counts).sum() / max(1, counts.sum())
        assert np.isclose(whole, mean + model.bias, atol=1e-5)


def test_features_of_a_long_text_do_not_depend_on_blocks(monkeypatch):
    text = " ".join(f"w{i % 17}" for i in range(400))
    whole = quality.features(text, SMALL)
    monkeypatch.setattr(quality, "BLOCK", 256)
    parts = quality.features(text, SMALL)
    # Only pairs of words across a cut are not seen.
    assert whole[1].sum() - parts[1].sum() <= len(text) // 100
