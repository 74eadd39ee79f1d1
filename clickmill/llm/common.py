"""What several operators share: tables kept in the shared folder, text batches, word rules."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.session import scratch, scratch_dir

#: ASCII white space; a word is a run of anything else.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows of one Arrow batch turned into Python objects at a time.
SLICE_ROWS = 256
#: Rows of a join's side, of a few longs each, up to which it may be broadcast.
BROADCAST_ROWS = 1_000_000
#: A to Z in lower case, for ``bytes.translate``.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_KEEPING: ContextVar[str | None] = ContextVar("keeping", default=None)


@contextmanager
def keeping(spark: SparkSession) -> Iterator[None]:
    """Tables ``kept`` meanwhile are removed at the end, when what is made of them has been written."""
    with scratch(spark, "kept") as folder:
        token = _KEEPING.set(folder)
        try:
            yield
        finally:
            _KEEPING.reset(token)


def kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there.

    Later steps then start from files any executor can read, whichever executors are lost.
    """
    spark, folder = df.sparkSession, _KEEPING.get()
    path = f"{folder}/{purpose}-{uuid.uuid4().hex}" if folder else f"{scratch_dir(spark, purpose)}/rows"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """The rows with a broadcast hint if there are at most ``limit`` of them; else as they are."""
    return F.broadcast(df) if df.count() <= limit else df


def text_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their ``text`` as strings; null is the empty text."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part, [t or "" for t in part.column(at).to_pylist()]


def held_out(doc_id: Column) -> Column:
    """Whether labels of this document are kept for testing; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def labelled_ids(labels: DataFrame, rows: int) -> DataFrame:
    """``doc_id, label`` of at most ``rows`` labelled documents that are not held out.

    Those whose ids hash lowest are taken, up to a hash that leaves about that many, so that no
    task and not the driver sees more. Labels without a quality or id are ignored; of several
    labels of one document the lowest counts.
    """
    known = (
        labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("label"))
        .withColumn("place", F.shiftrightunsigned(F.xxhash64("doc_id"), 1))
    )
    there = known.count()
    if there > rows:
        known = known.where(F.col("place") < int((1 << 63) * (0.95 * rows / there)))
    return F.broadcast(known.orderBy("place", "doc_id").limit(rows).select("doc_id", "label"))
