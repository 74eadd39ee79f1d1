"""Payloads to the landing table, as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming import StreamingQuery

from clickmill.sources.landing import PARTITIONS, STREAM, to_landed
from clickmill.sources.readers import is_present
from clickmill.streaming.kpi_stream import EVERY, trigger


def start_ingest_stream(
    payloads: DataFrame, raw: Column, arrived_at: Column, identity: Column, landing_path: str,
    checkpoint: str, once: bool = False, every: str = EVERY, tasks: int | None = None,
) -> StreamingQuery:
    """Land every payload exactly once, in one pass over the stream, next to landed batches.

    Spark's file sink lists what each batch has committed, and readers go by that list. ``tasks``
    bounds the files per batch where the source has many small partitions. A landing place takes one
    stream; another, or the same with a new checkpoint, is refused.
    """
    spark, path = payloads.sparkSession, f"{landing_path}/{STREAM}"
    if is_present(spark, path) and not is_present(spark, checkpoint):
        raise ValueError(f"{path} was written under another checkpoint")
    landed = to_landed(payloads, raw, arrived_at, identity)
    if tasks:
        landed = landed.coalesce(tasks)
    return (
        landed.writeStream.queryName("ingest")
        .format("parquet")
        .partitionBy(*PARTITIONS)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, every))
        .start()
    )
