"""Token counts through a digest cache.

Counts are stored under the digest of a text's normalised content and the digest of the tokenizer
file. Texts are joined to the stored counts, only distinct misses are encoded, and their counts are
appended to the cache.
"""

from __future__ import annotations

import hashlib
import json
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm.common import SPACES, kept
from clickmill.session import scratch_dir

CACHE_SCHEMA = "content binary, version binary, n_tokens bigint"
#: Rows of a batch split into runs at once, runs handed to the tokenizer at once, and those of them that make one text.
ROWS_AT_ONCE = 1024
RUNS_AT_ONCE = 4096
JOINED = 64
#: Longest run remembered, in bytes, and the runs a worker remembers.
SHORT = 64
REMEMBERED = 600_000


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> bytes:
    """Digest of the tokenizer file: another file never shares counts with this one."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).digest()


def parts_at_space(tokenizer: str) -> bool:
    """Whether a tokenizer, given as JSON, drops ASCII white space and only cuts at it.

    So it is where normalisation looks at single characters, or combining ones after them, and the
    text is first split into the matches of a pattern that takes no white space, the rest being
    removed; and where no added token holds or strips white space. Any other is taken not to.
    """
    import regex

    file = json.loads(tokenizer)
    normal = file["normalizer"] or {"type": "Sequence", "normalizers": []}
    steps = normal["normalizers"] if normal["type"] == "Sequence" else [normal]
    spaces = {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}
    if any(step["type"] not in ("NFC", "NFD", "Lowercase") and step != spaces for step in steps):
        return False
    split = file["pre_tokenizer"] or {}
    first = (split.get("pretokenizers") or [split])[0] if split else {}
    if (first.get("type"), first.get("behavior"), first.get("invert")) != ("Split", "Removed", True):
        return False
    if "Regex" not in first["pattern"]:
        return False
    pattern = regex.compile(first["pattern"]["Regex"])
    around = ["a", "Z", "é", "1", ".", "'", "'s", "_", "\u3000", ""]
    for space in SPACES.decode():
        if any(space in m.group() for x in around for y in around for m in pattern.finditer(x + space + y)):
            return False
    return not any(t["lstrip"] or t["rstrip"] or set(t["content"]) & set(SPACES.decode()) for t in file["added_tokens"])


def normal_form(text: str | None, parted: bool) -> bytes:
    """What a text's count depends on; runs of ASCII white space count as one space, and those at the
    ends as none, if the tokenizer only parts there."""
    raw = (text or "").encode("utf-8")
    return b" ".join(raw.split()) if parted else raw


def open_cache(spark: SparkSession, path: str) -> DataFrame:
    """The counts stored at ``path``; an empty table there if there is none yet."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(hadoop):
        spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


class Counter:
    """Token counts of texts, each distinct run of other than ASCII white space encoded once.

    If the tokenizer only parts at white space, the count of a text is the sum over such runs, special
    strings included, and many runs are encoded as one text. Runs up to ``SHORT`` bytes are
    remembered, at most ``REMEMBERED`` at a time.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.parted = parts_at_space(self.tokenizer.to_str())
        self.known: dict[str, int] = {}

    def _learn(self, runs: list[str]) -> dict[str, int]:
        found = {}
        for start in range(0, len(runs), RUNS_AT_ONCE):
            part = runs[start:start + RUNS_AT_ONCE]
            if not self.parted:
                coded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
                found.update(zip(part, map(len, coded), strict=True))
                continue
            groups = [part[k:k + JOINED] for k in range(0, len(part), JOINED)]
            coded = self.tokenizer.encode_batch([" ".join(g) for g in groups], add_special_tokens=False)
            for group, code in zip(groups, coded, strict=True):
                sizes = np.fromiter(map(len, group), np.int64, len(group)) + 1
                starts = np.cumsum(sizes) - sizes
                tokens = np.array(code.offsets, np.int64).reshape(-1, 2)[:, 0]
                counts = np.bincount(np.searchsorted(starts, tokens, "right") - 1, minlength=len(group))
                found.update(zip(group, counts.tolist(), strict=True))
        return found

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Counts of an Arrow array of texts, null the empty one."""
        texts = texts.fill_null("")
        if self.parted:
            lists = pc.ascii_split_whitespace(texts)
            ends, runs = lists.offsets.to_numpy(), lists.flatten().dictionary_encode()
        else:
            ends, runs = np.arange(len(texts) + 1), texts.dictionary_encode()
        distinct = runs.dictionary.to_pylist()
        fresh = self._learn([r for r in distinct if r and r not in self.known])
        known = self.known
        if len(known) + len(fresh) > REMEMBERED:
            known = {r: known[r] for r in distinct if r in known}
        known.update(fresh)
        known[""] = 0
        of_run = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
        total = np.append(0, np.cumsum(of_run[runs.indices.to_numpy()]))
        for run in fresh:
            if len(run) > SHORT:
                del known[run]
        self.known = known
        return total[ends[1:] - ends[0]] - total[ends[:-1] - ends[0]]


@cache
def counter_of(path: str) -> Counter:
    """A worker's counter; what it remembers serves its later tasks too."""
    return Counter(path)


def _slices(batches):
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _digest(parted: bool, with_text: bool):
    def digest(batches):
        for part in _slices(batches):
            texts = part.column("text")
            sums = [hashlib.sha256(normal_form(t, parted)).digest() for t in texts.to_pylist()]
            last = texts.fill_null("") if with_text else pc.binary_length(texts.fill_null("")).cast(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(sums, pa.binary()), last],
                ["doc_id", "content", "text" if with_text else "n_bytes"])

    return digest


def _encode(path: str, version: bytes):
    def encode(batches):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        counter = counter_of(path)
        for part in _slices(batches):
            yield pa.RecordBatch.from_arrays(
                [part.column("content"), pa.array([version] * part.num_rows, pa.binary()),
                 pa.array(counter.counts(part.column("text")))],
                ["content", "version", "n_tokens"])

    return encode


def count_tokens(docs: DataFrame, cache_path: str, path: str | None = None, limit: int = 2048) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row of ``docs`` (``doc_id, text``).

    The counts are those of the tokenizer file at ``path`` without added special tokens. Special
    strings inside a text are handled as the library does by default. Null texts are empty and
    have no tokens. A very long text is counted whole, in one task. Null and repeated ids, repeated
    rows and empty tables need nothing special; other columns are not read. Counts missing in
    the cache at ``cache_path`` are appended to it; two runs appending the same count do no harm,
    as the cache is read as one count per key.
    """
    spark = docs.sparkSession
    path = path or tokenizer_path()
    version = tokenizer_version(path)
    with open(path, encoding="utf-8") as file:
        parted = parts_at_space(file.read())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    sizes = kept(texts.mapInArrow(_digest(parted, False), "doc_id bigint, content binary, n_bytes bigint"), "token-keys")

    def stored() -> DataFrame:
        rows = open_cache(spark, cache_path).where(F.col("version") == F.lit(bytearray(version)))
        return rows.groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))

    # One row stands for all with the same content. Only its text is moved, and by id, so that a
    # content holding a third of all rows is moved once.
    distinct = sizes.groupBy("content").agg(F.min("doc_id").alias("doc_id"))
    misses = distinct.join(stored().select("content"), "content", "left_anti")
    keyed = texts.mapInArrow(_digest(parted, True), "doc_id bigint, content binary, text string")
    first = keyed.alias("k").join(
        misses.alias("m"),
        F.col("k.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("k.content") == F.col("m.content")), "left_semi")
    # Rows that agree in id and text are encoded once each, and stored once.
    coded = first.select("content", "text").mapInArrow(_encode(path, version), CACHE_SCHEMA)
    coded.groupBy("content", "version").agg(F.max("n_tokens").alias("n_tokens")).write.mode("append").parquet(cache_path)
    # Joined from files, so that a content on a third of all rows can be split at run time.
    return sizes.join(kept(stored(), "token-counts"), "content").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


def new_cache(spark: SparkSession) -> str:
    """A place for a cache of its own in the shared folder."""
    return f"{scratch_dir(spark, 'token-cache')}/counts"
