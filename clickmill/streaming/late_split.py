"""Events that come too late for a stateful step, kept to the side instead of dropped by it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

from clickmill.operators.tracking import LOG_TIME, tracking_events
from clickmill.schemas import EVENT_COLUMNS, struct
from clickmill.sources.readers import read_if_present
from clickmill.sources.writers import replace_partitions
from clickmill.streaming.kpi_stream import EVERY, read_batches, replace_batch, trigger
from clickmill.streaming.progress import with_progress

MARKS = struct("newest timestamp")
SIDES = StructType([
    *struct("create_time string, job_id int, custom_track string, bid int, campaign_id int, "
            f"group_id int, publisher_id int, {LOG_TIME} timestamp").fields,
    StructField("late", BooleanType()), StructField("stream", StringType()), StructField("batch_id", LongType()),
])


def start_late_split(
    log: DataFrame, path: str, checkpoint: str, delay: str, once: bool = False, every: str = EVERY,
) -> StreamingQuery:
    """Part a streamed log into events in time and late ones, all of them kept.

    An event is late if it is more than ``delay`` (an SQL interval) older than the newest event up
    to and including its batch. A stateful stream over ``read_kept`` with the same delay as its watermark
    therefore drops none, however it cuts the kept events into batches, as long as it reads
    them in the order they were written in, as file streams do. Events without a time are kept.

    A batch delivered again replaces its rows and its mark. Each batch is read twice: for its
    newest event, and to be written.
    """
    def split(events: DataFrame, batch_id: int) -> None:
        spark = events.sparkSession
        replace_batch(events.agg(F.max("ts").alias("newest")), batch_id, f"{path}/marks")
        marks = read_batches(spark, f"{path}/marks", MARKS).where(F.col("batch_id") <= batch_id)
        newest = marks.agg(F.unix_micros(F.max("newest"))).first()[0]
        limit = F.timestamp_micros(F.lit(newest)) - F.expr(f"INTERVAL {delay}")
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        parted = events.select(*EVENT_COLUMNS, F.col("ts").alias(LOG_TIME)).withColumns({
            "late": F.coalesce(F.col(LOG_TIME) < limit, F.lit(False)),
            "stream": F.lit(stream), "batch_id": F.lit(batch_id).cast("bigint")})
        replace_partitions(parted, f"{path}/events", "late", "stream", "batch_id")

    return (
        with_progress(tracking_events(log)).writeStream.queryName("late_split")
        .foreachBatch(split)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, every))
        .start()
    )


def _side(rows: DataFrame, late: bool) -> DataFrame:
    return rows.where(F.col("late") == late).select(*EVENT_COLUMNS, LOG_TIME)


def read_kept(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The events in time, as a log for the streams of ``kpi_stream``."""
    reader = spark.readStream if stream else spark.read
    return _side(reader.schema(SIDES).parquet(f"{path}/events"), late=False)


def read_late(spark: SparkSession, path: str) -> DataFrame:
    return _side(read_if_present(spark, f"{path}/events", SIDES), late=True)
