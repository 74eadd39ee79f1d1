"""Quality rules: learned decision lists over text statistics.

Statistics of every text are computed once. From labelled statistics, sequential covering grows
conjunctions of thresholds that pick out low quality, prunes each on rows it was not grown on, and
stops when no rule is precise enough. The list becomes one ordered Spark conditional.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.llm.common import SPACES, kept, labelled_ids, text_rows

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_digits")
#: Shares the rules may test, as Spark SQL over the counts; each is 0 for a text without words.
FEATURES = {
    "words": "cast(n_words as double)",
    "mean_word": "word_chars / greatest(n_words, 1)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "dup_lines_per_word": "n_dup_lines / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "upper_share": "n_upper / greatest(word_chars, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "digit_share": "n_digits / greatest(word_chars, 1)",
}
UPPER = bytes(range(65, 91))
LINE_EDGE = " \t\x0b\x0c\r"


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the labelled statistics that the list is learned from."""

    sample_rows: int = 20_000
    thresholds: int = 64
    max_conditions: int = 4
    max_rules: int = 10
    min_precision: float = 0.9
    min_covered: int = 5
    seed: int = 11


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def column(self) -> Column:
        value = F.expr(FEATURES[self.feature])
        return value > self.threshold if self.above else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>' if self.above else '<='} {self.threshold:.6g}"


Rule = tuple[Condition, ...]


def repeated_words(words: list[bytes]) -> int:
    """Words in 3-word windows found twice or more, the first time included."""
    if len(words) < 4:
        return 0
    windows = list(zip(words, words[1:], words[2:], strict=False))
    seen = Counter(windows)
    if len(seen) == len(windows):
        return 0
    again = np.fromiter(map(seen.__getitem__, windows), np.int64, len(windows)) > 1
    hit = np.zeros(len(words), bool)
    for shift in range(3):
        hit[shift: shift + len(again)] |= again
    return int(hit.sum())


def text_counts(text: str) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [line for line in text.split("\n") if line.strip(LINE_EDGE)]
    return (
        len(words),
        len(text) - sum(text.count(chr(c)) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(raw) - len(raw.translate(None, UPPER)),
        text.count("!") + text.count("?"),
        len(raw) - len(raw.translate(None, b"0123456789")),
    )


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of every row's whole text; a null text has none of anything."""
    def counted(batches):
        for part, texts in text_rows(batches):
            found = zip(*map(text_counts, texts), strict=True)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), *(pa.array(c, pa.int64()) for c in found)], ["doc_id", *COUNTS])

    return docs.select("doc_id", "text").mapInArrow(
        counted, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in COUNTS))


def _covered(values: dict[str, np.ndarray], rule: Rule, size: int) -> np.ndarray:
    hit = np.ones(size, bool)
    for c in rule:
        hit &= values[c.feature] > c.threshold if c.above else values[c.feature] <= c.threshold
    return hit


def _grow(values: dict[str, np.ndarray], bad: np.ndarray, live: np.ndarray, settings: Settings) -> Rule:
    """Add the condition of most information gain until the rule covers no good row."""
    rule: Rule = ()
    hit = live.copy()
    while len(rule) < settings.max_conditions and (hit & ~bad).any():
        p, n = (hit & bad).sum(), (hit & ~bad).sum()
        best, gain = None, 1e-9
        for name, column in values.items():
            cuts = np.unique(np.quantile(column[hit], np.linspace(0, 1, settings.thresholds), method="lower"))
            order = np.sort(column[hit & bad]), np.sort(column[hit & ~bad])
            low = [np.searchsorted(side, cuts, "right") for side in order]
            for above, ps, ns in ((False, *low), (True, p - low[0], n - low[1])):
                gains = ps * (np.log2((ps + 1e-9) / (ps + ns + 1e-9)) - np.log2(p / (p + n)))
                gains[ps < settings.min_covered] = -1
                at = int(np.argmax(gains))
                if gains[at] > gain:
                    # Half way to the next value, so that no row sits on the threshold.
                    after = column[hit][column[hit] > cuts[at]]
                    cut = (cuts[at] + after.min()) / 2 if len(after) else cuts[at]
                    best, gain = Condition(name, above, float(cut)), gains[at]
        if best is None:
            break
        rule += (best,)
        hit &= _covered(values, (best,), len(hit))
    return rule


def _precision(hit: np.ndarray, bad: np.ndarray) -> float:
    return ((hit & bad).sum() + 0.5) / (hit.sum() + 1)


def _merged(rule: Rule) -> Rule:
    """The same rows with one condition, the tightest, for each side of a feature."""
    sides: dict[tuple[str, bool], Condition] = {}
    for c in rule:
        old = sides.get((c.feature, c.above))
        if old is None or (c.threshold > old.threshold) == c.above:
            sides[c.feature, c.above] = c
    return tuple(sides.values())


def _pruned(values: dict[str, np.ndarray], rule: Rule, bad: np.ndarray, test: np.ndarray) -> Rule:
    """Without the conditions, first the one of least use, that do not make the rule better on ``test`` rows.

    Of equally useless ones the last grown goes first.
    """
    def worth(some: Rule) -> float:
        return _precision(_covered(values, some, len(bad)) & test, bad)

    while len(rule) > 1:
        shorter = max((rule[:i] + rule[i + 1:] for i in reversed(range(len(rule)))), key=worth)
        if worth(shorter) < worth(rule):
            break
        rule = shorter
    return rule


def learn(values: dict[str, np.ndarray], bad: np.ndarray, settings: Settings = Settings()) -> list[Rule]:
    """An ordered list of rules for ``bad`` rows; empty without rows of both kinds."""
    rules: list[Rule] = []
    if not bad.any() or bad.all():
        return rules
    growing = np.random.default_rng(settings.seed).random(len(bad)) < 2 / 3
    live = np.ones(len(bad), bool)
    while len(rules) < settings.max_rules and (live & growing & bad).sum() >= settings.min_covered:
        rule = _grow(values, bad, live & growing, settings)
        test = live & ~growing
        rule = _pruned(values, _merged(rule), bad, test)
        hit = _covered(values, rule, len(bad))
        if not rule or _precision(hit & live, bad) < settings.min_precision or _precision(
                hit & test, bad) < settings.min_precision - 0.1:
            break
        rules.append(rule)
        live &= ~hit
    return rules


def labelled_statistics(stats: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of shares with a label that is not held out, one for each id."""
    shares = [F.expr(sql).alias(name) for name, sql in FEATURES.items()]
    found = stats.join(labelled_ids(labels, rows), "doc_id").groupBy("doc_id", "label").agg(
        F.min(F.struct(*shares)).alias("shares"))
    return found.select("doc_id", "label", "shares.*")


def fit(stats: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> list[Rule]:
    """Learn a list from statistics and labels; rows of at most ``sample_rows`` numbers are collected."""
    sample = labelled_statistics(stats, labels, settings.sample_rows).toPandas().sort_values("doc_id", ignore_index=True)
    values = {name: sample[name].to_numpy(float) for name in FEATURES}
    return learn(values, sample["label"].to_numpy() == 0, settings)


def verdict(rules: list[Rule]) -> Column:
    """The list as one conditional: the number and text of the first rule met, null if none is."""
    cases = [
        (reduce(lambda a, b: a & b, (c.column() for c in rule)), f"{i + 1}: " + " and ".join(map(str, rule)))
        for i, rule in enumerate(rules)
    ]
    if not cases:
        return F.lit(None).cast("string")
    chain = F.when(*(cases[0][0], F.lit(cases[0][1])))
    for met, name in cases[1:]:
        chain = chain.when(met, F.lit(name))
    return chain


def judge(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Statistics, ``base_failed``, ``kept`` and the ``rule`` that rejected, per row of ``docs``.

    A text without words fails the base rules. Rows with null or repeated ids are judged each on
    its own; of several labels of a document the lowest counts, and null ones are ignored. Without
    labels of both kinds the list is empty and the base rules decide. A very long text is counted
    whole, by one task. No rows give no rows. Other columns are not read.
    """
    stats = kept(statistics(docs), "rule-statistics")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (
        stats.withColumn("base_failed", failed)
        .withColumn("rule", verdict(fit(stats, labels, settings)))
        .withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
        .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                "base_failed", "kept", "rule")
    )
