"""KPIs kept current by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StringType, StructField, StructType

from clickmill.functions.time_uuid import utc_date, utc_hour
from clickmill.operators.kpis import MEASURES, finish_partials, hourly_partials, merge_partials
from clickmill.operators.tracking import fill_ids, tracking_events
from clickmill.schemas import COUNTS, GRAIN, IDS, KINDS, PARTIALS
from clickmill.sources.readers import read_if_present
from clickmill.sources.writers import replace_partitions
from clickmill.streaming.progress import with_progress

EVERY = "3 minutes"
# Streams that this process has found to be alone at a table.
_KNOWN: set[tuple[str, str]] = set()
BatchWriter = Callable[[DataFrame, int], None]


def trigger(once: bool, every: str = EVERY) -> dict[str, bool | str]:
    """Work off what is there and end, or go on at a steady pace."""
    return {"availableNow": True} if once else {"processingTime": every}


def replace_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one batch's rows as its partition, in place of what an earlier try left there.

    Partitions carry the id of their stream, as batch ids restart with each checkpoint. A table
    that another stream writes is refused, since both would count the same log.
    """
    spark = df.sparkSession
    stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
    if (stream, path) not in _KNOWN:
        there = read_if_present(spark, path, StructType([StructField("stream", StringType())]))
        if not there.where(F.col("stream") != stream).isEmpty():
            raise ValueError(f"{path} was written under another checkpoint")
        _KNOWN.add((stream, path))
    named = df.withColumns({"stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
    replace_partitions(named, path, "stream", "batch_id")


def read_batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of all batches, with their ``batch_id``.

    A batch is there as a whole or not at all, and one that is delivered again has the same rows.
    """
    keyed = StructType([*schema.fields, StructField("stream", StringType()), StructField("batch_id", LongType())])
    return read_if_present(spark, path, keyed).drop("stream")


def write_partials(path: str) -> BatchWriter:
    """A ``foreachBatch`` sink for events: the batch's partials in a partition of their own.

    A batch delivered again replaces its partition, so each event counts once. Nothing is kept
    between batches: any lateness is welcome, and the work grows with the batch alone.
    """
    return lambda events, batch_id: replace_batch(hourly_partials(events), batch_id, path)


def late_dropped(query: StreamingQuery) -> int:
    """Events that a limit on lateness has dropped, over the batches the query still reports."""
    return sum(
        state.get("numRowsDroppedByWatermark", 0)
        for report in query.recentProgress for state in report["stateOperators"]
    )


def start_kpi_stream(
    log: DataFrame, partials_path: str, checkpoint: str, once: bool = False, every: str = EVERY,
    distinct_within: str | None = None, write: BatchWriter | None = None,
) -> StreamingQuery:
    """Count a streamed event log into additive partials, each event exactly once.

    Progress is the checkpoint's alone. If the log itself may hold an event twice,
    ``distinct_within`` keeps the ids of that span as state and drops repeats; events later than
    that are then dropped too, and ``late_dropped`` tells how many (``late_split`` keeps them).
    Without it there is no state and no event is ever too late.
    """
    events = with_progress(tracking_events(log))
    if distinct_within:
        timed = events.filter(F.col("ts").isNotNull()).withWatermark("ts", distinct_within)
        events = timed.dropDuplicatesWithinWatermark(["create_time"])
    return (
        events.writeStream.queryName("hourly_kpis")
        .foreachBatch(write or write_partials(partials_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, every))
        .start()
    )


def start_state_stream(
    log: DataFrame, closed_path: str, checkpoint: str, delay: str, once: bool = False,
    every: str = EVERY,
) -> StreamingQuery:
    """The same KPIs as totals of hourly windows held in state.

    An hour's totals are written once, when it is closed: ``delay`` after it has passed. Those of open
    hours are in the state only, from where ``state_totals`` serves them. Events later than the
    delay are dropped and counted by ``late_dropped``; ``late_split`` keeps them.
    """
    kind = F.col("custom_track")
    events = fill_ids(with_progress(tracking_events(log)).filter(kind.isin(*KINDS) & F.col("ts").isNotNull()))
    click_bid = F.when(kind == "click", F.coalesce(F.col("bid"), F.lit(0)))
    totals = (
        events.withWatermark("ts", delay)
        .groupBy(F.window("ts", "1 hour").alias("window"), *IDS)
        .agg(
            *[F.count_if(kind == k).alias(name) for k, name in KINDS.items()],
            F.sum(click_bid).cast("bigint").alias("bid_sum"),
        )
    )
    return (
        _by_grain(totals, F.col("window.start")).writeStream.queryName("hourly_kpis_state")
        .outputMode("append")
        .foreachBatch(lambda closed, batch_id: replace_batch(closed, batch_id, closed_path))
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, every))
        .start()
    )


def _by_grain(totals: DataFrame, start: Column) -> DataFrame:
    return totals.select(
        "job_id", utc_date(start).alias("date"), utc_hour(start).alias("hour"),
        "publisher_id", "campaign_id", "group_id", *COUNTS, "bid_sum")


def state_totals(spark: SparkSession, closed_path: str, checkpoint: str) -> DataFrame:
    """Totals per grain key as of the last committed batch: closed hours as written, open ones from state.

    Both are read as of that batch, so that an hour that is just being closed is in one of them.
    They are additive as partials are, without ``max_ts``.
    """
    newest = spark.read.format("state-metadata").load(checkpoint).agg(F.max("maxBatchId")).first()[0]
    fields = ", ".join(f"{c}: bigint" for c in [*COUNTS, "bid_sum"])
    state = spark.read.format("statestore").option("batchId", newest).load(checkpoint)
    opened = state.select("key.*", F.col("value").cast(f"struct<{fields}>").alias("value"))
    schema = StructType([f for f in PARTIALS if f.name != "max_ts"])
    closed = read_batches(spark, closed_path, schema).where(F.col("batch_id") <= newest)
    return _by_grain(opened.select("*", "value.*"), F.col("window.start")).unionByName(closed.select(*schema.names))


def kpis_of_totals(totals: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """KPIs of ``state_totals`` and, if given, of partials such as those of late events."""
    parts = totals.withColumn("max_ts", F.lit(None).cast("timestamp"))
    if more is not None:
        parts = parts.unionByName(more.select(*parts.columns))
    return finish_partials(merge_partials(parts)).select(*GRAIN, *MEASURES)
