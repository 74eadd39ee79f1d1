"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds those of its letters, each
permuted by its place (shifted in a circle), by multiplication; a text's vector bundles its n-grams
by addition. A language's prototype bundles the unit vectors of its documents. A document belongs to
the prototype with the greatest cosine.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import held_out, text_rows

SPACE = 32
#: Documents bundled at once, and distinct n-grams held as vectors at once.
DOCS_AT_ONCE = 64
GRAMS_AT_ONCE = 8192
#: N-grams are numbered through a table where the alphabet's all fit into it, and sorted elsewhere.
CODES = 1 << 21
#: Unit vectors are added up as whole numbers of this part, so that no order of adding matters.
GRAIN = 1 << 20
UNDETERMINED = "und"
PARTS = 64


@dataclass(frozen=True)
class Settings:
    """``most`` bounds the languages whose prototypes go to every task: 8 KB each. The world's
    registered language codes are fewer than 8,000."""

    dim: int = 1024
    gram: int = 3
    seed: int = 13
    most: int = 16_384


@dataclass(frozen=True)
class Profiles:
    """Languages in order, and their prototypes with what all have in common taken out."""

    langs: list[str]
    prototypes: np.ndarray
    common: np.ndarray


@cache
def _kinds() -> np.ndarray:
    """Of every code point: 2 a letter, 1 a mark that goes with letters, 0 anything else."""
    first = [unicodedata.category(chr(c))[0] for c in range(0x110000)]
    return np.array([{"L": 2, "M": 1}.get(k, 0) for k in first], np.uint8)


def letters(text: str) -> np.ndarray:
    """Code points of the lower-cased letters, words parted by single spaces and within spaces.

    Empty where there is no letter.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kinds()[points]
    if not (kinds == 2).any():
        return np.zeros(0, np.uint32)
    points = np.concatenate(([SPACE], np.where(kinds > 0, points, SPACE), [SPACE])).astype(np.uint32)
    gap = points == SPACE
    return points[~(gap & np.append(False, gap[:-1]))]


class Bundler:
    """Vectors of texts. Letter vectors depend on the code point and the seed alone."""

    def __init__(self, settings: Settings) -> None:
        self.settings = settings
        self.known: dict[int, np.ndarray] = {}

    def _letter(self, point: int) -> np.ndarray:
        if point not in self.known:
            if len(self.known) > 20_000:
                self.known.clear()
            draw = np.random.default_rng((self.settings.seed, point))
            self.known[point] = draw.integers(0, 2, self.settings.dim, dtype=np.int8) * 2 - 1
        return self.known[point]

    def bind(self, grams: np.ndarray) -> np.ndarray:
        """Vectors of n-grams, given a row of code points each."""
        points, places = np.unique(grams, return_inverse=True)
        table = np.stack([self._letter(int(p)) for p in points])
        places = places.reshape(grams.shape)
        n = grams.shape[1]
        bound = table[places[:, n - 1]]
        for k in range(n - 1):
            bound = bound * np.roll(table, n - 1 - k, axis=1)[places[:, k]]
        return bound

    def _distinct(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of each distinct n-gram, and the number of every row's n-gram."""
        n = rows.shape[1]
        there = np.zeros(0x110000, bool)
        for k in range(n):
            there[rows[:, k]] = True
        alphabet = np.cumsum(there) - 1
        size = int(alphabet[-1]) + 1
        direct = size ** n <= CODES
        codes = alphabet[rows[:, 0]] if direct else rows[:, 0].astype(np.uint64)
        # Few letters are numbered; three of any fit side by side; longer n-grams are hashed to 64 bits.
        step = size if direct else np.uint64(1 << 21 if n <= 3 else 0x9E3779B97F4A7C15)
        for k in range(1, n):
            codes = codes * step + (alphabet[rows[:, k]] if direct else rows[:, k])
        if not direct:
            _, first, gram = np.unique(codes, return_index=True, return_inverse=True)
            return first, gram
        place = np.full(size ** n, -1)
        place[codes] = np.arange(len(codes))
        found = np.flatnonzero(place >= 0)
        first = place[found]
        place[found] = np.arange(len(found))
        return first, place[codes]

    def vectors(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """A vector a text, and whether it has a letter at all; without one all is 0."""
        n = self.settings.gram
        found = [letters(t) for t in texts]
        out = np.zeros((len(texts), self.settings.dim))
        windows, owners = [], []
        for k, points in enumerate(found):
            if len(points):
                padded = np.append(points, np.full(max(n - len(points), 0), SPACE, np.uint32))
                rows = np.lib.stride_tricks.sliding_window_view(padded, n)
                windows.append(rows)
                owners.append(np.full(len(rows), k))
        if not windows:
            return out, np.zeros(len(texts), bool)
        rows, owner = np.concatenate(windows), np.concatenate(owners)
        first, gram = self._distinct(rows)
        for start in range(0, len(first), GRAMS_AT_ONCE):
            part = first[start:start + GRAMS_AT_ONCE]
            mine = (gram >= start) & (gram < start + len(part)) if len(first) > GRAMS_AT_ONCE else slice(None)
            counts = np.bincount(owner[mine] * len(part) + gram[mine] - start, minlength=len(texts) * len(part))
            counts = counts.reshape(len(texts), len(part)).astype(np.float32)
            out += counts @ self.bind(rows[part]).astype(np.float32)
        return out, np.fromiter((len(p) > 0 for p in found), bool, len(found))


def _units(vectors: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(vectors, axis=-1, keepdims=True)
    return np.divide(vectors, size, out=np.zeros_like(vectors), where=size > 0)


SUMS = "lang string, part int, total array<bigint>"


def _bundled(settings: Settings):
    def bundled(batches):
        bundler, totals = Bundler(settings), {}

        def told(part):
            return pa.RecordBatch.from_arrays(
                [pa.array(list(totals)), pa.array([part] * len(totals), pa.int32()),
                 pa.array([t.tolist() for t in totals.values()], pa.list_(pa.int64()))], ["lang", "part", "total"])

        from pyspark import TaskContext

        part = TaskContext.get().partitionId() % PARTS
        for rows, texts in text_rows(batches):
            langs = rows.column("lang").to_pylist()
            for start in range(0, len(texts), DOCS_AT_ONCE):
                vectors, _ = bundler.vectors(texts[start:start + DOCS_AT_ONCE])
                whole = np.rint(_units(vectors) * GRAIN).astype(np.int64)
                for lang, vector in zip(langs[start:start + DOCS_AT_ONCE], whole, strict=True):
                    totals[lang] = totals[lang] + vector if lang in totals else vector
            if len(totals) > 1000:
                yield told(part)
                totals.clear()
        if totals:
            yield told(part)

    return bundled


def _added(table: pa.Table) -> pa.Table:
    total = np.sum(np.stack([np.asarray(x, np.int64) for x in table.column("total").to_pylist()]), axis=0)
    return pa.table({"lang": table.column("lang").slice(0, 1), "part": pa.array([0], pa.int32()),
                     "total": pa.array([total.tolist()], pa.list_(pa.int64()))})


def learn(docs: DataFrame, settings: Settings = Settings()) -> Profiles:
    """Prototypes of the languages of all of ``docs`` (``doc_id, text, lang``) but those held out.

    Rows with a null ``lang`` or ``text`` teach nothing. Tasks add their documents up; sums of a
    language meet in two steps, so that a language on most rows is no hot key.
    """
    told = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sums = told.select("lang", "text").mapInArrow(_bundled(settings), SUMS)
    for keys in (["lang", "part"], ["lang"]):
        sums = sums.groupBy(*keys).applyInArrow(_added, SUMS)
    rows = sums.limit(settings.most + 1).collect()
    if len(rows) > settings.most:
        raise ValueError(f"more than {settings.most} languages")
    rows = sorted((r["lang"], r["total"]) for r in rows)
    totals = np.array([t for _, t in rows], np.float64).reshape(len(rows), settings.dim)
    prototypes = _units(totals)
    common = prototypes.mean(axis=0) if len(rows) > 1 else np.zeros(settings.dim)
    return Profiles([lang for lang, _ in rows], _units(prototypes - common), common)


def similarities(vectors: np.ndarray, profiles: Profiles) -> np.ndarray:
    """Cosine of each text with each prototype, both without what all languages have in common."""
    units = _units(vectors)
    return _units(units - units.any(axis=1, keepdims=True) * profiles.common) @ profiles.prototypes.T


def _judge(profiles: Profiles, settings: Settings):
    def judged(batches):
        bundler = Bundler(settings)
        for rows, texts in text_rows(batches):
            langs, scores = [], []
            for start in range(0, len(texts), DOCS_AT_ONCE):
                vectors, spoken = bundler.vectors(texts[start:start + DOCS_AT_ONCE])
                if not profiles.langs:
                    spoken[:] = False
                    best, score = np.zeros(len(vectors), int), np.zeros(len(vectors))
                else:
                    near = similarities(vectors, profiles)
                    best = np.argmax(near, axis=1)
                    score = np.clip((1 + near[np.arange(len(best)), best]) / 2, 0, 1)
                langs += [profiles.langs[b] if ok else UNDETERMINED for b, ok in zip(best.tolist(), spoken.tolist(), strict=True)]
                scores += np.where(spoken, score, 0.0).tolist()
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"])

    return judged


def identify(docs: DataFrame, profiles: Profiles, settings: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs`` (``doc_id, text``).

    The whole text is read, however long, in bounded memory besides the text. ``und`` with a score
    of 0 where it is null or has no letter, or where no language was learned. Of prototypes that
    tie the first in the order of code points is taken. The score is half of one plus the cosine.
    Null ids are not held out; repeated rows give repeated rows; other columns are not read.
    """
    judged = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(
        _judge(profiles, settings), "doc_id bigint, lang_pred string, score double")
    return judged.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
