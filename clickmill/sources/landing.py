"""The landing table: every payload once, accepted or refused, by event date."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from clickmill.functions.time_uuid import utc_date
from clickmill.operators.ingest import ACCEPTED, classify
from clickmill.operators.tracking import LOG_DATE, LOG_TIME
from clickmill.schemas import struct
from clickmill.sources.readers import is_present
from clickmill.sources.writers import by_partition, replace_partitions

PARTITIONS = ["status", LOG_DATE]
#: A landing place holds what batches have landed and what a stream has, each under a name of its own.
BATCHES, STREAM, PART = "batches", "stream", "part"
LANDED = struct(
    "create_time string, bid int, campaign_id int, custom_track string, group_id int, "
    "job_id int, publisher_id int, ts string, raw string, reason string, "
    f"{LOG_TIME} timestamp, status string, {LOG_DATE} date"
)


def to_landed(payloads: DataFrame, raw: Column, arrived_at: Column, identity: Column) -> DataFrame:
    """Classified payloads as they are landed, of a batch or of a stream.

    Both sides go to one table partitioned by status and event date: readers of either, and of a
    range of dates, skip the rest. Time and date are those of the id minted with them.
    """
    fine = F.col("reason").isNull()
    return classify(payloads, raw, arrived_at, identity).select(
        *ACCEPTED,
        F.when(~fine, F.col("raw")).alias("raw"),
        "reason",
        F.date_trunc("second", "arrived_at").alias(LOG_TIME),
        F.when(fine, F.lit("accepted")).otherwise(F.lit("rejected")).alias("status"),
        utc_date(F.col("arrived_at")).alias(LOG_DATE),
    )


def land_payloads(
    payloads: DataFrame, raw: Column, arrived_at: Column, identity: Column, path: str,
    in_order: bool = False, name: str | None = None,
) -> None:
    """Classify a batch of payloads in one pass and add it to the landing table.

    Batches and a stream may land at one place. A batch that is landed again under its ``name``
    replaces itself.

    Payloads ``in_order`` of arrival are written where they are, as a task holds few dates then;
    others are first brought together by partition.
    """
    landed = to_landed(payloads, raw, arrived_at, identity)
    if not in_order:
        landed = by_partition(landed, *PARTITIONS)
    named = landed.withColumn(PART, F.lit(name or uuid.uuid4().hex))
    replace_partitions(named, f"{path}/{BATCHES}", PART, *PARTITIONS)


def _read(spark: SparkSession, path: str, stream: bool, status: str) -> DataFrame:
    """Landed rows of one side; of a stream's files those that its sink lists as committed."""
    schemas = {BATCHES: StructType([*LANDED.fields, StructField(PART, StringType())]), STREAM: LANDED}
    reader = spark.readStream if stream else spark.read
    sides = [reader.schema(schema).parquet(f"{path}/{side}").select(*LANDED.names)
             for side, schema in schemas.items() if is_present(spark, f"{path}/{side}")]
    rows = reduce(DataFrame.unionByName, sides) if sides else spark.createDataFrame([], LANDED)
    return rows.filter(F.col("status") == status)


def read_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """The accepted events, with their time and date; the KPI stream's source."""
    return _read(spark, path, stream, "accepted").select(*ACCEPTED, LOG_TIME, LOG_DATE)


def read_refused(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    return _read(spark, path, stream, "rejected").select("raw", "reason", LOG_DATE)
