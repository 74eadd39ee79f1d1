"""Every query by name, over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clickmill.functions.time_uuid import decode_time_uuid
from clickmill.operators import enrich, kpis, reports
from clickmill.operators import tracking as track
from clickmill.operators.ingest import ACCEPTED
from clickmill.plans.incremental import rows_of, run_incremental, stage_partials
from clickmill.schemas import DEFAULT_SOURCE, HOURLY_KPI, JOB, PUBLISHER, TRACKING
from clickmill.session import scratch_dir
from clickmill.sources import landing, sample
from clickmill.sources.contract import schema_contract
from clickmill.sources.readers import read_if_present, sink_watermark
from clickmill.sources.sinks import ParquetSink, Run, Sink, parquet_sink
from clickmill.sources.writers import bootstrap_if_empty, by_partition, create_table_if_missing, write_log
from clickmill.streaming import compaction, ingest_stream, kpi_stream, late_split, sink_stream

Query = Callable[[SparkSession, str], DataFrame]


def _without_zone(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as the given tables have them: UTC, without a zone."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return track.tracking_events(sample.tracking(spark, sf_dir))


def _arrived(log: DataFrame, early: bool) -> DataFrame:
    """The events that reached the log before the cut, or those from then on."""
    before = F.col("arrived_at") < F.lit(sample.CUT).cast("timestamp")
    return track.tracking_events(log.filter(before if early else ~before))


# --- scans and event preparation ---------------------------------------------------------------


def tracking_events(spark, sf_dir):
    return _without_zone(_events(spark, sf_dir), "ts")


def job_dim(spark, sf_dir):
    return enrich.job_dim(sample.jobs(spark, sf_dir))


def publisher_ids(spark, sf_dir):
    return enrich.publisher_ids(sample.publishers(spark, sf_dir))


def job_group_ids(spark, sf_dir):
    return enrich.job_group_ids(sample.jobs(spark, sf_dir))


def filled_events(spark, sf_dir):
    return _without_zone(track.filled_events(_events(spark, sf_dir)), "ts")


def decode_ids(spark, sf_dir):
    ids = sample.spelled_ids(spark, sf_dir)
    return _without_zone(ids.withColumn("ts", decode_time_uuid(F.col("create_time"))), "ts")


def _kept_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, decoded once and kept by date."""
    path = scratch_dir(spark, "log")
    write_log(sample.tracking(spark, sf_dir), path)
    return spark.read.parquet(path)


def incremental_slice(spark, sf_dir):
    return _without_zone(track.incremental_slice(_events(spark, sf_dir), sample.CUT), "ts")


def log_replayed(spark, sf_dir):
    """A log written in two calls that overlap, the second of them twice: each event once."""
    path, log = scratch_dir(spark, "log"), sample.tracking(spark, sf_dir)
    write_log(log.where(F.col("arrived_at") < F.lit(sample.CUT).cast("timestamp")), path)
    for _ in range(2):
        write_log(log, path)
    return kpis.hourly_kpis(track.tracking_events(spark.read.parquet(path)))


# --- aggregates and joins ----------------------------------------------------------------------


def clicks_hourly(spark, sf_dir):
    return kpis.clicks_hourly(_events(spark, sf_dir))


def _kind_query(kind: str) -> Query:
    return lambda spark, sf_dir: kpis.kind_hourly(_events(spark, sf_dir), kind)


def hourly_kpis(spark, sf_dir):
    return kpis.hourly_kpis(_events(spark, sf_dir))


def hourly_kpis_join(spark, sf_dir):
    return kpis.hourly_kpis_join(_events(spark, sf_dir))


def company_enriched(spark, sf_dir):
    return enrich.company_enriched(hourly_kpis(spark, sf_dir), sample.jobs(spark, sf_dir))


def company_salted(spark, sf_dir):
    """The same where the jobs are too many to broadcast."""
    return enrich.company_enriched(
        hourly_kpis(spark, sf_dir), sample.jobs(spark, sf_dir), broadcast_bytes=-1)


def company_bucketed(spark, sf_dir):
    """The same from tables kept in buckets of the job, joined where they lie."""
    named = {n: f"clickmill_{n}_{uuid.uuid4().hex}" for n in ("kpis", "jobs")}
    kept = {"kpis": hourly_kpis(spark, sf_dir), "jobs": enrich.job_dim(sample.jobs(spark, sf_dir))}
    tables = [enrich.keep_bucketed(kept[n], table, scratch_dir(spark, n), buckets=8) for n, table in named.items()]
    joined = enrich.company_bucketed(*tables)
    for table in named.values():
        spark.sql(f"DROP TABLE {table}")  # the catalog's entry; the files stay for the result
    return joined


def fractional_bids(spark, sf_dir):
    """Clicks priced in quarters; sums of decimals do not depend on the order of events."""
    raw = sample.events(spark, sf_dir).select("event_id", (F.col("k").cast("decimal(10,2)") / 4).cast("decimal(10,2)").alias("bid"))
    log = sample.tracking(spark, sf_dir).drop("bid").join(raw, "event_id")
    priced = kpis.clicks_hourly(track.tracking_events(log))
    return priced.withColumns({c: F.col(c).cast("double") for c in ("bid_set", "spend_hour")})


def batch_high_mark(spark, sf_dir):
    return _without_zone(kpis.batch_high_mark(_events(spark, sf_dir)), "high_mark")


# --- the sink and incremental runs -------------------------------------------------------------


def _sink_rows(spark: SparkSession, events: DataFrame, sf_dir: str) -> DataFrame:
    partials = stage_partials(events, scratch_dir(spark, "batch"))
    return rows_of(partials, sample.jobs(spark, sf_dir))


def sink_rows(spark, sf_dir):
    return _without_zone(_sink_rows(spark, _events(spark, sf_dir), sf_dir), "updated_at")


def watermark(spark, sf_dir):
    early = _sink_rows(spark, _arrived(sample.tracking(spark, sf_dir), early=True), sf_dir)
    return _without_zone(sink_watermark(early), "watermark")


def watermark_of_empty_sink(spark, sf_dir):
    """A batch with no event of a counted kind leaves the sink, and the watermark, as it was."""
    others = _events(spark, sf_dir).filter(~F.col("custom_track").isin(*kpis.KINDS))
    return _without_zone(sink_watermark(_sink_rows(spark, others, sf_dir)), "watermark")


def late_events(spark, sf_dir):
    """Events that reach the log after a run and are older than its high mark."""
    mark = kpis.batch_high_mark(_arrived(sample.tracking(spark, sf_dir), early=True))
    arrivals = _arrived(sample.tracking(spark, sf_dir), early=False).crossJoin(F.broadcast(mark))
    return track.late_events(arrivals, F.col("high_mark"))


def _plain_money(rows: DataFrame) -> DataFrame:
    types = {"bid_set": "double", "spend_hour": "bigint"}
    return rows.withColumns({c: F.col(c).cast(kind) for c, kind in types.items()})


class _Lossy(ParquetSink):
    """A sink whose runs get half of their dates in and end."""

    def write(self, rows: DataFrame, name: str) -> None:
        super().write(rows.where(F.dayofmonth("dates") % 2 == 0), name)
        raise RuntimeError("the run was lost")

    def discard(self, name: str) -> None:
        """A lost run takes nothing away."""


def _two_runs(spark: SparkSession, sf_dir: str, fail: bool = False) -> Sink:
    """Two runs over a log kept by event date, the second when all events have arrived."""
    log, jobs = _kept_log(spark, sf_dir), sample.jobs(spark, sf_dir)
    path = scratch_dir(spark, "sink")
    sink = parquet_sink(spark, path)
    run_incremental(_arrived(log, early=True), jobs, sink)
    if fail:
        try:
            run_incremental(track.tracking_events(log), jobs, _Lossy(spark, path), name="second")
        except RuntimeError:
            pass
    run_incremental(track.tracking_events(log), jobs, sink, name="second")
    return sink


def empty_batch(spark, sf_dir):
    """A run that finds no events leaves the sink and its mark as they were."""
    log, jobs = _kept_log(spark, sf_dir), sample.jobs(spark, sf_dir)
    sink = parquet_sink(spark, scratch_dir(spark, "sink"))
    run_incremental(_arrived(log, early=True), jobs, sink)
    before, nothing = sink.mark(), _arrived(log, early=True)
    found = run_incremental(nothing, jobs, sink, inclusive=False)
    rows = _plain_money(sink.rows().drop("id")).withColumns({
        "found": F.lit(found), "mark_kept": F.lit(sink.mark() == before)})
    return _without_zone(rows, "updated_at")


def incremental_run(spark, sf_dir):
    rows = _two_runs(spark, sf_dir).rows().drop("id")
    return _without_zone(_plain_money(rows), "updated_at")


def incremental_retry(spark, sf_dir):
    """The same after a second run that was lost halfway."""
    rows = _two_runs(spark, sf_dir, fail=True).rows().drop("id")
    return _without_zone(_plain_money(rows), "updated_at")


def _merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = _two_runs(spark, sf_dir)
    return reports.sink_merged(sink.rows(), sink.recounted())


def sink_merged(spark, sf_dir):
    """One row per key of a sink of two runs, the second they share counted once."""
    return _plain_money(_merged(spark, sf_dir)).drop("updated_at")


def sink_by_job_day(spark, sf_dir):
    report = reports.kpi_by_job_day(reports.kpis_of_sink(_merged(spark, sf_dir)))
    return report.withColumn("spend", F.col("spend").cast("bigint"))


def sink_by_publisher(spark, sf_dir):
    return reports.kpi_by_publisher(
        reports.kpis_of_sink(_merged(spark, sf_dir)), sample.publishers(spark, sf_dir))


def sink_by_campaign(spark, sf_dir):
    report = reports.kpi_by_campaign(reports.kpis_of_sink(_merged(spark, sf_dir)))
    return report.withColumns({
        "spend": F.col("spend").cast("bigint"),
        "cost_per_conversion": F.try_divide(F.col("spend").cast("double"), F.col("conversions"))})


# --- reports -----------------------------------------------------------------------------------


def kpi_merged(spark, sf_dir):
    """Partials of two batches, added up."""
    log = sample.tracking(spark, sf_dir)
    first, second = (kpis.hourly_partials(_arrived(log, early)) for early in (True, False))
    return reports.kpi_merged(first.unionByName(second))


def kpi_by_job_day(spark, sf_dir):
    return reports.kpi_by_job_day(hourly_kpis(spark, sf_dir))


def kpi_by_publisher(spark, sf_dir):
    return reports.kpi_by_publisher(hourly_kpis(spark, sf_dir), sample.publishers(spark, sf_dir))


def kpi_by_campaign(spark, sf_dir):
    return reports.kpi_by_campaign(hourly_kpis(spark, sf_dir))


def kpi_reports(spark, sf_dir):
    return reports.kpi_reports(hourly_kpis(spark, sf_dir), sample.publishers(spark, sf_dir))


# --- streams -----------------------------------------------------------------------------------


def _streamed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it would arrive: landed by day of arrival, several micro-batches long."""
    path = scratch_dir(spark, "log")
    log = sample.tracking(spark, sf_dir).withColumn("arrival_date", F.to_date("arrived_at"))
    by_partition(log, "arrival_date").write.partitionBy("arrival_date").parquet(path)
    return spark.readStream.schema(log.schema).option("maxFilesPerTrigger", 8).parquet(path)


def stream_kpis(spark, sf_dir):
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "progress")
    log = _streamed_log(spark, sf_dir)
    kpi_stream.start_kpi_stream(log, partials, checkpoint, once=True).awaitTermination()
    return reports.kpi_merged(compaction.served_partials(spark, partials))


def stream_distinct(spark, sf_dir):
    """A log that holds every event twice."""
    path, log = scratch_dir(spark, "log"), sample.tracking(spark, sf_dir)
    log.unionAll(log).write.parquet(path)
    twice = spark.readStream.schema(log.schema).parquet(path)
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "progress")
    kpi_stream.start_kpi_stream(
        twice, partials, checkpoint, once=True, distinct_within="60 days").awaitTermination()
    return reports.kpi_merged(compaction.served_partials(spark, partials))


def stream_sink_rows(spark, sf_dir):
    """The log to sink rows as a stream, merged."""
    sink, checkpoint = scratch_dir(spark, "sink"), scratch_dir(spark, "progress")
    sink_stream.start_sink_stream(
        _streamed_log(spark, sf_dir), sample.jobs(spark, sf_dir), sink, checkpoint, once=True).awaitTermination()
    rows = reports.sink_merged(sink_stream.streamed_rows(spark, sink))
    return _plain_money(rows).drop("updated_at")


def stream_kpis_stateful(spark, sf_dir):
    """Totals of hours still open, served from the stream's state."""
    closed, checkpoint = scratch_dir(spark, "closed"), scratch_dir(spark, "progress")
    kpi_stream.start_state_stream(
        _streamed_log(spark, sf_dir), closed, checkpoint, delay="40 days", once=True
    ).awaitTermination()
    return kpi_stream.kpis_of_totals(kpi_stream.state_totals(spark, closed, checkpoint))


def _split_log(spark: SparkSession, sf_dir: str, delay: str) -> str:
    """The streamed log parted into events in time and late ones; the place of both."""
    path = scratch_dir(spark, "split")
    late_split.start_late_split(
        _streamed_log(spark, sf_dir), path, scratch_dir(spark, "progress"), delay, once=True).awaitTermination()
    return path


def _late_partials(spark: SparkSession, path: str) -> DataFrame:
    return kpis.hourly_partials(track.tracking_events(late_split.read_late(spark, path)))


def stream_late_side(spark, sf_dir):
    """Events in time through a stateful step, late ones from the side: together all of them."""
    path = _split_log(spark, sf_dir, "12 hours")
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "progress")
    kpi_stream.start_kpi_stream(
        late_split.read_kept(spark, path, stream=True), partials, checkpoint, once=True,
        distinct_within="12 hours").awaitTermination()
    served = compaction.served_partials(spark, partials)
    return reports.kpi_merged(served.unionByName(_late_partials(spark, path)))


def stream_state_totals(spark, sf_dir):
    """Closed hours as written, open ones from the state, and late events from the side."""
    path = _split_log(spark, sf_dir, "2 days")
    closed, checkpoint = scratch_dir(spark, "closed"), scratch_dir(spark, "progress")
    kept = late_split.read_kept(spark, path, stream=True)
    kpi_stream.start_state_stream(kept, closed, checkpoint, delay="2 days", once=True).awaitTermination()
    totals = kpi_stream.state_totals(spark, closed, checkpoint)
    return kpi_stream.kpis_of_totals(totals, _late_partials(spark, path))


def stream_replay(spark, sf_dir):
    """Every batch delivered twice and the stream started again: nothing counts twice."""
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "progress")
    log, write = _streamed_log(spark, sf_dir), kpi_stream.write_partials(partials)

    def twice(events: DataFrame, batch_id: int) -> None:
        write(events, batch_id)
        write(events, batch_id)

    for _ in range(2):
        kpi_stream.start_kpi_stream(
            log, partials, checkpoint, once=True, write=twice
        ).awaitTermination()
    return reports.kpi_merged(compaction.served_partials(spark, partials))


def stream_compacted(spark, sf_dir):
    """Streamed partials, compacted while the stream goes on, once for dates compacted before."""
    partials, compacted = scratch_dir(spark, "partials"), scratch_dir(spark, "compacted")
    log, checkpoint = _streamed_log(spark, sf_dir), scratch_dir(spark, "progress")
    write = kpi_stream.write_partials(partials)

    def write_and_compact(events: DataFrame, batch_id: int) -> None:
        write(events, batch_id)
        if batch_id % 2:
            compaction.compact_partials(spark, partials, compacted)

    kpi_stream.start_kpi_stream(
        log, partials, checkpoint, once=True, write=write_and_compact).awaitTermination()
    return reports.kpi_merged(compaction.served_partials(spark, partials, compacted))


# --- ingestion ---------------------------------------------------------------------------------


def _payload_columns():
    return F.col("raw"), F.col("arrived_at"), F.col("event_id")


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """The payloads as one landed batch; the place it was landed at."""
    path = scratch_dir(spark, "landing")
    landing.land_payloads(sample.payloads(spark, sf_dir), *_payload_columns(), path)
    return path


def _streamed(spark: SparkSession, sf_dir: str, some: str = "true", path: str | None = None) -> str:
    """The payloads landed by the ingest stream; the place they were landed at."""
    inbox, path = scratch_dir(spark, "inbox"), path or scratch_dir(spark, "landing")
    raw = sample.payloads(spark, sf_dir).where(some)
    raw.write.parquet(inbox)
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", 8).parquet(inbox)
    ingest_stream.start_ingest_stream(
        stream, *_payload_columns(), path, scratch_dir(spark, "progress"), once=True
    ).awaitTermination()
    return path


def _accepted(spark: SparkSession, path: str) -> DataFrame:
    return landing.read_log(spark, path).select(*ACCEPTED)


def _refused(spark: SparkSession, path: str) -> DataFrame:
    return landing.read_refused(spark, path).select("raw", "reason")


def ingest_mixed(spark, sf_dir):
    """Half of the payloads landed by a stream and half as a batch, at one place."""
    path = _streamed(spark, sf_dir, "event_id % 2 = 0")
    rest = sample.payloads(spark, sf_dir).where("event_id % 2 = 1")
    landing.land_payloads(rest, *_payload_columns(), path)
    return _accepted(spark, path)


def ingest_accepted(spark, sf_dir):
    return _accepted(spark, _landed(spark, sf_dir))


def ingest_rejected(spark, sf_dir):
    return _refused(spark, _landed(spark, sf_dir))


def stream_ingest(spark, sf_dir):
    return _accepted(spark, _streamed(spark, sf_dir))


def stream_ingest_refused(spark, sf_dir):
    return _refused(spark, _streamed(spark, sf_dir))


def stream_ingest_to_kpis(spark, sf_dir):
    """Payloads to the log and on to KPIs, both as streams."""
    log = landing.read_log(spark, _streamed(spark, sf_dir), stream=True)
    partials, checkpoint = scratch_dir(spark, "partials"), scratch_dir(spark, "progress")
    kpi_stream.start_kpi_stream(log, partials, checkpoint, once=True).awaitTermination()
    return reports.kpi_merged(compaction.served_partials(spark, partials))


# --- schemas and reference tables --------------------------------------------------------------


def _declared(schema: StructType, *columns: str) -> StructType:
    return StructType([schema[c] for c in columns])


def contract(spark, sf_dir):
    checks = [
        schema_contract(
            sample.tracking(spark, sf_dir), "tracking",
            _declared(TRACKING, *track.EVENT_COLUMNS, "ts", "uid"), counts=True,
        ),
        schema_contract(
            sample.jobs(spark, sf_dir), "job",
            _declared(JOB, "id", "company_id", "group_id", "campaign_id"), counts=True,
        ),
        schema_contract(
            sample.publishers(spark, sf_dir), "publisher",
            _declared(PUBLISHER, "id", "publisher_name"), counts=True,
        ),
    ]
    return checks[0].unionByName(checks[1]).unionByName(checks[2])


def bootstrapped(spark, sf_dir):
    """A reference table filled on the first call and left alone by the second."""
    path = scratch_dir(spark, "job")
    jobs = sample.jobs(spark, sf_dir)
    for _ in range(2):
        bootstrap_if_empty(spark, jobs, path)
    return read_if_present(spark, path, jobs.schema)


def create_if_missing(spark, sf_dir):
    """A table made once, with defaults for the columns that the rows leave out."""
    name, path = f"clickmill_sink_{uuid.uuid4().hex}", scratch_dir(spark, "created")
    rows = _sink_rows(spark, _events(spark, sf_dir), sf_dir).drop("impression", "sources")
    typed = enrich.to_sink_types(rows.withColumns({"impression": F.lit(0), "sources": F.lit(None)}))
    given = typed.drop("impression", "sources")
    for early in (True, False):
        create_table_if_missing(
            spark, name, HOURLY_KPI, {"impression": "0", "sources": f"'{DEFAULT_SOURCE}'"}, "dates", path)
        half = F.col("hours") < 12
        given.where(half if early else ~half).createOrReplaceTempView(f"{name}_rows")
        columns = ", ".join(given.columns)
        spark.sql(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {name}_rows")
    spark.catalog.dropTempView(f"{name}_rows")
    spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
    found = read_if_present(spark, path, HOURLY_KPI).drop("id")
    return _without_zone(_plain_money(found), "updated_at")


QUERIES: dict[str, Query] = {
    "tracking_events": tracking_events,
    "job_dim": job_dim,
    "publisher_ids": publisher_ids,
    "job_group_ids": job_group_ids,
    "filled_events": filled_events,
    "decode_time_uuid": decode_ids,
    "incremental_slice": incremental_slice,
    "log_replayed": log_replayed,
    "clicks_hourly": clicks_hourly,
    "conversions_hourly": _kind_query("conversion"),
    "qualified_hourly": _kind_query("qualified"),
    "unqualified_hourly": _kind_query("unqualified"),
    "hourly_kpis": hourly_kpis,
    "hourly_kpis_join": hourly_kpis_join,
    "company_enriched": company_enriched,
    "company_salted": company_salted,
    "company_bucketed": company_bucketed,
    "fractional_bids": fractional_bids,
    "batch_high_mark": batch_high_mark,
    "sink_rows": sink_rows,
    "sink_watermark": watermark,
    "sink_watermark_empty": watermark_of_empty_sink,
    "late_events": late_events,
    "incremental_run": incremental_run,
    "incremental_retry": incremental_retry,
    "empty_batch": empty_batch,
    "sink_merged": sink_merged,
    "sink_by_job_day": sink_by_job_day,
    "sink_by_publisher": sink_by_publisher,
    "sink_by_campaign": sink_by_campaign,
    "kpi_merged": kpi_merged,
    "kpi_by_job_day": kpi_by_job_day,
    "kpi_by_publisher": kpi_by_publisher,
    "kpi_by_campaign": kpi_by_campaign,
    "kpi_reports": kpi_reports,
    "stream_hourly_kpis": stream_kpis,
    "stream_hourly_kpis_stateful": stream_kpis_stateful,
    "stream_state_totals": stream_state_totals,
    "stream_late_side": stream_late_side,
    "stream_replay": stream_replay,
    "stream_distinct": stream_distinct,
    "stream_sink_rows": stream_sink_rows,
    "stream_compacted": stream_compacted,
    "ingest_accepted": ingest_accepted,
    "ingest_rejected": ingest_rejected,
    "ingest_mixed": ingest_mixed,
    "stream_ingest": stream_ingest,
    "stream_ingest_rejected": stream_ingest_refused,
    "stream_ingest_to_kpis": stream_ingest_to_kpis,
    "schema_contract": contract,
    "bootstrap_if_empty": bootstrapped,
    "create_if_missing": create_if_missing,
}
