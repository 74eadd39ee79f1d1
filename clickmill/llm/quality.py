"""Quality classifier: supervised subword embeddings.

Every word, pair of words and character n-gram of a text is hashed to a learned vector; the mean of a
document's vectors goes through a softmax layer. Vectors and layer are trained by stochastic
gradient descent in numpy, on a bounded sample of labelled documents. A trained model is linear in
the vectors, so scoring only needs one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import held_out, labelled_ids, text_rows

BLOCK = 1 << 19  # characters hashed at once
PRIME = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xD6E8FEB86659FD93)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled documents that the model is fitted on."""

    buckets_log2: int = 17
    dim: int = 8
    grams: tuple[int, ...] = (2, 3, 4)
    epochs: int = 6
    rate: float = 0.6
    sample_rows: int = 4000
    seed: int = 7


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one logit difference per bucket
    bias: float
    settings: Settings


def _powers() -> tuple[np.ndarray, np.ndarray]:
    inverse = np.uint64(pow(int(PRIME), -1, 1 << 64))
    ups = np.full(BLOCK + 2, PRIME, np.uint64)
    downs = np.full(BLOCK + 2, inverse, np.uint64)
    ups[0] = downs[0] = 1
    return np.multiply.accumulate(ups), np.multiply.accumulate(downs)


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def _buckets(chars: np.ndarray, texts: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and buckets of the features of a block of characters, one kind after the other.

    ``texts`` are the places where its texts start.

    The block starts and ends with a space. A word is its characters between spaces, a pair the
    next two words; an n-gram may begin or end with a space, which marks the word's edge, but has
    none inside.
    """
    if not _POWERS:
        _POWERS.append(_powers())
    ups, downs = _POWERS[0]
    shift = np.uint64(64 - settings.buckets_log2)
    solid = chars != 32
    wide = chars.astype(np.uint64)
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    starts, ends = edge[0::2], edge[1::2]
    total = np.zeros(len(chars) + 1, np.uint64)
    np.cumsum(wide * ups[: len(chars)], out=total[1:])
    words = (total[ends] - total[starts]) * downs[starts] * MIX
    yield starts, words >> shift
    # A pair of words is the difference of their hashes: a word said twice is the same for all words.
    owner = np.searchsorted(texts, starts, "right")
    pair = np.flatnonzero(owner[1:] == owner[:-1])
    yield starts[pair + 1], ((words[pair + 1] - words[pair]) * PRIME) >> shift
    rolled, inside = wide, np.ones(len(chars), bool)
    for n in range(2, max(settings.grams) + 1):
        rolled = rolled[:-1] * PRIME + wide[n - 1:]
        if n > 2:
            inside = inside[:-1] & solid[n - 2: n - 2 + len(rolled)]
        else:
            inside = solid[:-1] | solid[1:]
        if n in settings.grams:
            at = np.flatnonzero(inside)
            yield at, ((rolled[at] + np.uint64(n)) * MIX) >> shift


def _pieces(text: str) -> Iterator[str]:
    """The text in blocks, cut at white space where there is any."""
    start, room = 0, BLOCK - 2
    while len(text) - start > room:
        cut = max(text.rfind(c, start + room // 2, start + room) for c in " \n\t")
        cut = cut if cut > 0 else start + room
        yield text[start:cut]
        start = cut
    yield text[start:]


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Blocks of characters with the numbers of their texts and where those start."""
    parts, owners, starts, size = [" "], [], [], 1
    for number, text in enumerate(texts):
        for piece in _pieces(text):
            if size + len(piece) + 1 > BLOCK and owners:
                yield _joined(parts), np.array(owners), np.array(starts)
                parts, owners, starts, size = [" "], [], [], 1
            owners.append(number)
            starts.append(size)
            parts += [piece, " "]
            size += len(piece) + 1
    if owners:
        yield _joined(parts), np.array(owners), np.array(starts)


def _joined(parts: list[str]) -> np.ndarray:
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    chars[(chars >= 9) & (chars <= 13)] = 32
    return chars


def features(text: str, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a text and how often each occurs."""
    counts = np.zeros(1 << settings.buckets_log2, np.int64)
    for chars, _, starts in _blocks([text]):
        for _, buckets in _buckets(chars, starts, settings):
            counts += np.bincount(buckets.astype(np.int64), minlength=len(counts))
    found = np.flatnonzero(counts)
    return found, counts[found]


def logits(texts: list[str], model: Model) -> np.ndarray:
    sums, counts = np.zeros(len(texts)), np.zeros(len(texts))
    for chars, owners, starts in _blocks(texts):
        for at, buckets in _buckets(chars, starts, model.settings):
            summed = np.concatenate(([0.0], np.cumsum(model.weights[buckets.astype(np.int64)], dtype=np.float64)))
            # A text's features start at its leading space or later.
            first = np.searchsorted(at, starts - 1)
            last = np.append(first[1:], len(at))
            np.add.at(sums, owners, summed[last] - summed[first])
            np.add.at(counts, owners, last - first)
    return sums / np.maximum(counts, 1) + model.bias


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Train on (buckets, counts, label) rows; without two classes every score is the share of 1."""
    size, rng = 1 << settings.buckets_log2, np.random.default_rng(settings.seed)
    labels = np.array([label for _, _, label in rows])
    share = (labels.sum() + 1) / (len(labels) + 2)
    prior = float(np.log(share / (1 - share)))
    if len(set(labels.tolist())) < 2:
        return Model(np.zeros(size, np.float32), prior, settings)
    vectors = rng.normal(0, 0.1, (size, settings.dim))
    layer, offset = rng.normal(0, 0.5, (2, settings.dim)), np.array([0.0, prior])
    steps, step = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for number in rng.permutation(len(rows)):
            buckets, counts, label = rows[number]
            rate = settings.rate * (1 - step / steps)
            step += 1
            if not len(buckets):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[buckets]
            scores = layer @ mean + offset
            chances = np.exp(scores - scores.max())
            chances /= chances.sum()
            chances[label] -= 1
            back = chances @ layer
            layer -= rate * np.outer(chances, mean)
            offset -= 0.1 * rate * chances
            # A step moves the mean as far as the gradient says, however many features share it.
            vectors[buckets] -= (rate / (share @ share)) * np.outer(share, back)
    line = layer[1] - layer[0]
    return Model((vectors @ line).astype(np.float32), float(offset[1] - offset[0]), settings)


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows of ``docs`` that are not held out, at most ``settings.sample_rows``.

    One task holds the sample as bucket counts and returns the model, whose size is fixed.
    """
    def counted(batches):
        for part, texts in text_rows(batches):
            found = [features(t, settings) for t in texts]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column("doc_id"),
                "label": part.column("label"),
                "buckets": pa.array([f.astype(np.int32) for f, _ in found], pa.list_(pa.int32())),
                "counts": pa.array([c.astype(np.int32) for _, c in found], pa.list_(pa.int32())),
            })

    def trained(batches):
        rows = []
        for batch in batches:
            for i in range(batch.num_rows):
                rows.append((
                    batch.column("doc_id")[i].as_py(),
                    batch.column("buckets")[i].values.to_numpy(),
                    batch.column("counts")[i].values.to_numpy(),
                    min(1, max(0, batch.column("label")[i].as_py())),
                ))
        rows.sort(key=lambda r: (r[0], len(r[1]), r[3]))
        model = fit([r[1:] for r in rows], settings)
        yield pa.RecordBatch.from_pydict({
            "weights": pa.array([model.weights.tobytes()], pa.binary()), "bias": [model.bias]})

    # Of several texts of one id the least stands for it, so that the bound holds.
    sample = docs.select("doc_id", "text").join(labelled_ids(labels, settings.sample_rows), "doc_id").groupBy(
        "doc_id", "label").agg(F.min("text").alias("text"))
    counts = sample.select("doc_id", "label", "text").mapInArrow(
        counted, "doc_id bigint, label int, buckets array<int>, counts array<int>")
    row = counts.coalesce(1).mapInArrow(trained, "weights binary, bias double").first()
    if row is None:
        return fit([], settings)
    return Model(np.frombuffer(row["weights"], np.float32), row["bias"], settings)


def score(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted``, one row per row of ``docs`` (``doc_id, text``).

    A null text counts as empty; an empty text has no features and gets the score of the bias
    alone. Rows with null or repeated ids are scored each on its own. Other columns are not read.
    An unbroken run of over half a million characters is hashed in pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches):
        for part, texts in text_rows(batches):
            chance = 1 / (1 + np.exp(-np.clip(logits(texts, shared.value), -50, 50)))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(chance)], ["doc_id", "score"])

    found = docs.select("doc_id", "text").mapInArrow(scored, "doc_id bigint, score double")
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= threshold, 1).otherwise(0).alias("predicted"),
    )


def accept(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def passed(batches):
        for part, texts in text_rows(batches):
            chance = 1 / (1 + np.exp(-np.clip(logits(texts, shared.value), -50, 50)))
            yield part.filter(pa.array(chance >= threshold))

    return docs.mapInArrow(passed, docs.schema)
