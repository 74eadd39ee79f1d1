"""The event log to the sink's own rows, as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from clickmill.operators.enrich import to_sink_types
from clickmill.operators.tracking import tracking_events
from clickmill.plans.incremental import rows_of, stage_partials
from clickmill.schemas import DEFAULT_SOURCE, HOURLY_KPI
from clickmill.session import scratch
from clickmill.sources.writers import jdbc_write_options
from clickmill.streaming.kpi_stream import EVERY, read_batches, replace_batch, trigger
from clickmill.streaming.progress import with_progress

RowWriter = Callable[[DataFrame, int], None]


def to_files(path: str) -> RowWriter:
    """A batch's rows as a partition of their own, in place of what an earlier try left there."""
    return lambda rows, batch_id: replace_batch(rows, batch_id, path)


def replace_statements(table: str, columns: list[str]) -> list[str]:
    """One transaction that puts a batch's staged rows in place of those of an earlier try.

    The markers stand for the batch number. The table has a column ``batch_id`` besides the sink's.
    """
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE batch_id = ?",
        f"INSERT INTO {table} ({names}, batch_id) SELECT {names}, ? FROM {table}_staging",
    ]


def to_database(
    url: str, table: str, transact: Callable[[list[str], int], None], **connection: str
) -> RowWriter:
    """Rows to ``<table>_staging``, then into the table by ``transact``, which runs statements with
    the batch number in one transaction. A batch delivered again replaces its rows."""
    columns = [f.name for f in HOURLY_KPI if f.name != "id"]

    def write(rows: DataFrame, batch_id: int) -> None:
        options = jdbc_write_options(url=url, table=f"{table}_staging", **connection)
        rows.select(*columns).write.format("jdbc").options(**options).option("truncate", "true").mode("overwrite").save()
        transact(replace_statements(table, columns), batch_id)

    return write


def start_sink_stream(
    log: DataFrame, jobs: DataFrame, sink_path: str, checkpoint: str, once: bool = False,
    every: str = EVERY, source: str = DEFAULT_SOURCE, write: RowWriter | None = None,
) -> StreamingQuery:
    """Sink rows of every batch, with companies and the batch's newest event time.

    Each event is in one batch's rows, so ``reports.sink_merged`` adds them up as they are. Without
    ``write`` they go to files below ``sink_path``.
    """
    put = write or to_files(sink_path)

    def add(events: DataFrame, batch_id: int) -> None:
        with scratch(events.sparkSession, "batch") as folder:
            partials = stage_partials(events, folder)
            put(to_sink_types(rows_of(partials, jobs, source)), batch_id)

    return (
        with_progress(tracking_events(log)).writeStream.queryName("sink_rows")
        .foreachBatch(add)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger(once, every))
        .start()
    )


def streamed_rows(spark: SparkSession, sink_path: str) -> DataFrame:
    """The rows of all batches."""
    return read_batches(spark, sink_path, HOURLY_KPI).drop("batch_id")
