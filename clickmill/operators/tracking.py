"""From the raw event log to the events the KPIs are counted on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.time_uuid import decode_time_uuid, utc_date, utc_instant
from clickmill.schemas import EVENT_COLUMNS, IDS

# Columns of a log kept with its event times: the decoded time and its UTC date, a partition.
LOG_TIME = "event_time"
LOG_DATE = "event_date"


def with_event_time(log: DataFrame) -> DataFrame:
    """A log with the time and date its ids tell, to be written once and not decoded again."""
    timed = log.withColumn(LOG_TIME, decode_time_uuid(F.col("create_time")))
    return timed.withColumn(LOG_DATE, utc_date(F.col(LOG_TIME)))


def tracking_events(log: DataFrame) -> DataFrame:
    """Events of a known job, cut to the columns read, with event time decoded from the id.

    The text column ``ts`` of a raw log is never trusted. A log kept with its event times gives
    those, so that ids need not be read at all, and its date for pruning.
    """
    kept = [c for c in (LOG_TIME, LOG_DATE) if c in log.columns]
    known = log.filter(F.col("job_id").isNotNull()).select(*EVENT_COLUMNS, *kept)
    decoded = F.col(LOG_TIME) if LOG_TIME in kept else decode_time_uuid(F.col("create_time"))
    return known.withColumn("ts", decoded).drop(LOG_TIME)


def incremental_slice(
    events: DataFrame, watermark: int | dt.datetime | str | Column, inclusive: bool = True
) -> DataFrame:
    """Events from the watermark on; events without a time are never in it.

    A watermark given as a value (microseconds, text or time; UTC) also prunes the partitions of a
    log kept by event date. Of a raw log every id is decoded, below the filter and above it.
    """
    known = not isinstance(watermark, Column)
    mark = utc_instant(watermark)
    fresh = events.filter(F.col("ts") >= mark if inclusive else F.col("ts") > mark)
    if known and LOG_DATE in events.columns:
        fresh = fresh.filter(F.col(LOG_DATE) >= utc_date(mark))
    return fresh


def fill_ids(events: DataFrame) -> DataFrame:
    """A missing id becomes 0, so an unknown id and a real 0 share one bucket."""
    return events.na.fill(0, subset=IDS)


def filled_events(events: DataFrame) -> DataFrame:
    """Ids filled, and a click's missing bid too; other kinds keep theirs as it is."""
    bid = F.when(
        (F.col("custom_track") == "click") & F.col("bid").isNull(), F.lit(0)
    ).otherwise(F.col("bid"))
    return fill_ids(events).withColumn("bid", bid)


def late_events(arrived: DataFrame, watermark: Column | dt.datetime | str) -> DataFrame:
    """How many events a watermark leaves behind, by kind and whole hours of lateness."""
    mark = utc_instant(watermark)
    behind = F.unix_seconds(mark) - F.unix_seconds(F.col("ts"))
    hours = F.call_function("div", behind, F.lit(3600))
    return (
        arrived.filter(F.col("ts") < mark)
        .groupBy("custom_track", hours.alias("hours_late"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
