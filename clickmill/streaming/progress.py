"""What running streams report: batches, rows and how far they lag behind."""

from __future__ import annotations

import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

OBSERVED = "events"
RECORDS = "query string, batch_id bigint, at timestamp, rows bigint, newest timestamp, lag_seconds double, seconds double"


def with_progress(events: DataFrame) -> DataFrame:
    """Events whose number and newest time each batch reports."""
    return events.observe(OBSERVED, F.count(F.lit(1)).alias("rows"), F.max(F.unix_micros("ts")).alias("newest"))


@dataclass(frozen=True)
class Record:
    """One batch. ``rows`` are events of known jobs; the lag is from the newest of them to the batch's start."""

    query: str
    batch_id: int
    at: str
    rows: int
    newest: int | None
    seconds: float


class ProgressRecorder(StreamingQueryListener):
    """Keeps the last ``most`` records of all streams of a session; ``spark.streams.addListener`` starts it.

    ``ended`` has the error, or none, of each query that has ended.
    """

    def __init__(self, most: int = 10_000) -> None:
        self.most, self.kept, self.ended = most, [], {}
        self._names, self._lock = {}, threading.Lock()

    def onQueryStarted(self, event) -> None:
        self._names[str(event.id)] = event.name

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        seen = progress.observedMetrics.get(OBSERVED)
        record = Record(
            progress.name, progress.batchId, progress.timestamp, seen["rows"] if seen else progress.numInputRows,
            seen["newest"] if seen else None, progress.batchDuration / 1000)
        with self._lock:
            self.kept = [*self.kept, record][-self.most:]

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended[self._names.get(str(event.id))] = event.exception

    def records(self, spark: SparkSession) -> DataFrame:
        """The records as a table; a batch without events has no newest event and no lag."""
        with self._lock:
            rows = [(r.query, r.batch_id, r.at, r.rows, r.newest, r.seconds) for r in self.kept]
        given = spark.createDataFrame(
            rows, "query string, batch_id bigint, began string, rows bigint, micros bigint, seconds double")
        at, newest = F.to_timestamp("began"), F.timestamp_micros("micros")
        lag = (F.unix_micros(at) - F.col("micros")) / 1e6
        return given.select("query", "batch_id", at.alias("at"), "rows", newest.alias("newest"), lag.alias("lag_seconds"), "seconds")
