"""The incremental batch: from the sink's watermark to new rows in the sink."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.time_uuid import utc_instant
from clickmill.operators.enrich import SINK_NAMES, company_enriched, sink_rows
from clickmill.operators.kpis import batch_high_mark, finish_partials, hourly_partials
from clickmill.operators.tracking import LOG_DATE, incremental_slice
from clickmill.schemas import DEFAULT_SOURCE, TAILS
from clickmill.session import observed
from clickmill.sources.sinks import Run, Sink


def stage(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Computed once however often it is used next, with no lineage left to recompute when executors
    are lost.
    """
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_partials(events: DataFrame, path: str) -> DataFrame:
    """Hourly partials of a batch, with what ``rows_of`` needs to know of its other events.

    The only pass over the events: whatever follows reads the staged rows, a small fraction, and
    so the same snapshot of a log that keeps growing.
    """
    return stage(hourly_partials(events, carry_other_kinds=True), path)


def rows_of(partials: DataFrame, jobs: DataFrame, source: str = DEFAULT_SOURCE) -> DataFrame:
    """Sink rows of staged partials, each with the newest event time of the whole batch."""
    mark = batch_high_mark(partials, "max_ts")
    kpis = company_enriched(finish_partials(partials), jobs)
    # One row by construction: an aggregate without grouping.
    return sink_rows(kpis.crossJoin(F.broadcast(mark)), F.col("high_mark"), source)


def tails_of(events: DataFrame, mark: int) -> DataFrame:
    """Partials of the second ``mark`` (microseconds), which an inclusive run counts again.

    A log read from files is the same one that the run has read, as they were listed before."""
    last = incremental_slice(events, mark).where(F.unix_micros("ts") == mark)
    named = hourly_partials(last).withColumnsRenamed(SINK_NAMES).withColumnRenamed("bid_sum", "spend_hour")
    stamped = named.withColumn("updated_at", F.timestamp_micros(F.lit(mark)))
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TAILS])


def run_incremental(
    events: DataFrame, jobs: DataFrame, sink: Sink, source: str = DEFAULT_SOURCE,
    inclusive: bool = True, since: int | dt.datetime | str | None = None, name: str | None = None,
) -> bool:
    """Publish the KPIs of events at or after the sink's mark; tells whether there were any to count.

    ``events`` come from a log kept by date (``write_log``), so that a run reads the dates and row
    groups it needs and decodes no id; a raw log is refused. One job goes from the events to
    the sink's rows; the newest event time, and whether anything was counted, are observed on the
    way. A run that fails leaves nothing to be seen and is simply run again; under a ``name`` of
    the caller's it replaces what a lost try has left, and does nothing once published. A run that
    finds only the newest second of the one before, or no event of a counted kind, leaves the sink
    as it is.

    As the comparison is inclusive, the last second of a run is read again by the next; what is
    counted twice is kept next to the rows (``reports.sink_merged``). Events older than the mark
    are never read. ``streaming.kpi_stream`` has neither limit.
    """
    if LOG_DATE not in events.columns:
        raise ValueError("bring the log's new events into one kept by date first, with write_log")
    if name is not None and sink.has(name):
        return True
    start = sink.mark() if since is None else _micros(events.sparkSession, since)
    name = name or f"{start}-{uuid.uuid4().hex}"
    seen = Observation()
    partials = hourly_partials(incremental_slice(events, start, inclusive), carry_other_kinds=True).observe(
        seen, F.max(F.unix_micros("max_ts")).alias("mark"), F.count("job_id").alias("counted"))
    kpis = company_enriched(finish_partials(partials), jobs)
    try:
        # Each row's mark is that of its run, which is known when all are written.
        sink.write(sink_rows(kpis, F.lit(None), source), name)
        mark, counted = observed(seen, "mark", "counted")
        if counted and mark > start:
            sink.publish(Run(name, start, mark, inclusive, tails_of(events, mark)))
        else:
            sink.discard(name)
    except BaseException:
        sink.discard(name)
        raise
    return bool(counted)


def _micros(spark: SparkSession, moment: int | dt.datetime | str) -> int:
    return spark.range(1).select(F.unix_micros(utc_instant(moment))).first()[0]
