import random
import time

import pytest
from pyspark.sql import functions as F

from clickmill.operators import kpis, reports
from clickmill.operators.tracking import LOG_DATE, tracking_events
from clickmill.schemas import TRACKING
from clickmill.sources.landing import land_payloads, read_log, read_refused
from clickmill.streaming import compaction, ingest_stream, kpi_stream, late_split, sink_stream
from clickmill.streaming.progress import ProgressRecorder
from tests.helpers import at, event, rows


class Feed:
    """An event log that grows file by file, each file one micro-batch."""

    def __init__(self, spark, log, root):
        self.spark, self.log, self.root = spark, log, root
        self.inbox, self.partials = str(root / "inbox"), str(root / "partials")
        self.checkpoint = str(root / "checkpoint")
        (root / "inbox").mkdir()

    def put(self, *events):
        self.log(*events).coalesce(1).write.mode("append").parquet(self.inbox)

    def stream(self):
        reader = self.spark.readStream.schema(TRACKING).option("maxFilesPerTrigger", 1)
        return reader.parquet(self.inbox)

    def run(self, **options):
        kpi_stream.start_kpi_stream(
            self.stream(), self.partials, self.checkpoint, once=True, **options
        ).awaitTermination()

    def served(self, compacted=None):
        return rows(reports.kpi_merged(
            compaction.served_partials(self.spark, self.partials, compacted)
        ))

    def batch(self):
        return rows(kpis.hourly_kpis(tracking_events(self.spark.read.parquet(self.inbox))))


@pytest.fixture
def feed(spark, log, tmp_path):
    return Feed(spark, log, tmp_path)


def _events(seed, n=120):
    rng = random.Random(seed)
    kinds = ["click", "conversion", "qualified", "unqualified", "view"]
    return [
        event(at(rng.randint(1, 2), rng.randint(0, 2)), rng.choice(kinds), rng.choice([None, 1, 2]),
              node=i, bid=rng.choice([None, 1, 2]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(2))
def test_any_order_and_split_gives_the_batch_result(feed, seed):
    events = _events(seed)
    random.Random(seed).shuffle(events)
    for start in (0, 50, 70):
        feed.put(*events[start:{0: 50, 50: 70, 70: 120}[start]])
    feed.run()
    assert feed.served() == feed.batch()


def test_a_restart_goes_on_where_the_stream_ended(feed):
    feed.put(*_events(1))
    feed.run()
    before = feed.served()
    feed.run()
    assert feed.served() == before
    feed.put(*_events(2, 30))
    feed.run()
    assert feed.served() == feed.batch() != before


def test_batches_delivered_twice_count_once(feed):
    write = kpi_stream.write_partials(feed.partials)
    feed.put(*_events(3))
    feed.put(*_events(4, 20))
    feed.run(write=lambda df, batch_id: [write(df, batch_id) for _ in range(2)])
    assert feed.served() == feed.batch()


def test_a_batch_that_fails_halfway_is_repeated(feed):
    write = kpi_stream.write_partials(feed.partials)
    feed.put(*_events(5))

    def fails(df, batch_id):
        write(df, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        feed.run(write=fails)
    feed.run()
    assert feed.served() == feed.batch()


def test_a_new_checkpoint_does_not_take_over_a_table(feed):
    feed.put(event(at(1, 8)))
    feed.run()
    feed.checkpoint += "-new"
    with pytest.raises(Exception, match="another checkpoint"):
        feed.run()


def test_a_log_with_repeated_events(feed):
    twice = event(at(1, 8))
    feed.put(twice, event(at(1, 8), node=5))
    feed.put(twice)
    feed.run(distinct_within="1 hour")
    clicks = sorted([*kpis.GRAIN, *kpis.MEASURES]).index("clicks")
    assert [r[clicks] for r in feed.served()] == [2]


def test_totals_in_state_equal_the_batch_unless_an_event_is_too_late(feed, spark, tmp_path):
    feed.put(*_events(6, 60))
    feed.put(*_events(7, 60))
    closed = str(tmp_path / "closed")

    def run():
        query = kpi_stream.start_state_stream(feed.stream(), closed, feed.checkpoint, delay="3 days", once=True)
        query.awaitTermination()
        return rows(kpi_stream.kpis_of_totals(kpi_stream.state_totals(spark, closed, feed.checkpoint))), query

    assert run()[0] == feed.batch()
    feed.put(event(at(20, 8)))
    assert run()[0] == feed.batch()
    # The hours of the first days are closed now: written once, and no longer in the state.
    assert spark.read.format("statestore").load(feed.checkpoint).count() == 1
    in_time = feed.batch()
    feed.put(event(at(1, 0), node=999))
    found, query = run()
    assert found == in_time and kpi_stream.late_dropped(query) == 1


def test_an_hour_being_closed_counts_once(feed, spark, tmp_path):
    """Closed hours written by a batch that is not committed are still served from the state."""
    closed = str(tmp_path / "closed")
    for when in (at(1, 8), at(9, 8), at(20, 8)):
        feed.put(event(when))
    kpi_stream.start_state_stream(feed.stream(), closed, feed.checkpoint, delay="1 day", once=True).awaitTermination()
    before = feed.batch()
    served = lambda: rows(kpi_stream.kpis_of_totals(kpi_stream.state_totals(spark, closed, feed.checkpoint)))
    assert served() == before
    newest = spark.read.format("state-metadata").load(feed.checkpoint).first()["maxBatchId"]
    ahead = spark.read.parquet(closed).limit(1).drop("batch_id")
    ahead.write.parquet(f"{closed}/stream=x/batch_id={newest + 1}")
    assert served() == before


@pytest.mark.parametrize("delay, late", [("1 hour", 2), ("30 days", 0)])
def test_late_events_are_kept_aside(feed, spark, tmp_path, delay, late):
    path = str(tmp_path / "split")
    for number, when in enumerate((at(1, 8), at(9, 8), at(9, 9), at(1, 8), at(9, 8, 30))):
        feed.put(event(when, node=number))
    feed.put(event(at(9, 10), node=50), event(at(2, 8), node=51))

    def split():
        late_split.start_late_split(feed.stream(), path, str(tmp_path / "cp"), delay, once=True).awaitTermination()

    split()
    assert late_split.read_late(spark, path).count() == late
    kept = late_split.read_kept(spark, path, stream=True)
    query = kpi_stream.start_kpi_stream(kept, feed.partials, feed.checkpoint, once=True, distinct_within=delay)
    query.awaitTermination()
    assert kpi_stream.late_dropped(query) == 0
    parts = compaction.served_partials(spark, feed.partials).unionByName(
        kpis.hourly_partials(tracking_events(late_split.read_late(spark, path))))
    assert rows(reports.kpi_merged(parts)) == feed.batch()
    split()
    assert late_split.read_late(spark, path).count() + late_split.read_kept(spark, path).count() == 7


def test_a_running_stream_reports_its_periods(feed, spark):
    recorder = ProgressRecorder()
    spark.streams.addListener(recorder)
    try:
        feed.put(event(at(1, 8)), event(at(1, 9)))
        query = kpi_stream.start_kpi_stream(feed.stream(), feed.partials, feed.checkpoint, every="1 second")

        def until(batches):
            for _ in range(300):
                if len({r.batch_id for r in recorder.kept if r.rows}) >= batches:
                    return
                time.sleep(0.1)

        try:
            until(1)
            feed.put(event(at(2, 8)))
            until(2)
        finally:
            query.stop()
    finally:
        spark.streams.removeListener(recorder)
    found = [r for r in recorder.records(spark).orderBy("batch_id").collect() if r.rows]
    assert [(r.query, r.batch_id, r.rows) for r in found] == [("hourly_kpis", 0, 2), ("hourly_kpis", 1, 1)]
    assert [r.newest.replace(tzinfo=None) for r in found] == [at(1, 9), at(2, 8)]
    assert all(r.lag_seconds == pytest.approx((r.at - r.newest).total_seconds()) and r.seconds > 0 for r in found)
    assert feed.served() == feed.batch()


def test_compaction_keeps_the_result_and_spares_the_batches(feed, spark, tmp_path):
    for seed in range(4):
        feed.put(*_events(seed, 30))
    feed.run()
    whole, compacted = feed.served(), str(tmp_path / "compacted")
    for through in (0, 2, 1, 2):
        compaction.compact_partials(spark, feed.partials, compacted, through)
        assert feed.served(compacted) == whole
    # Compacted batches are not read any more.
    batches = spark.read.parquet(feed.partials)
    batches.filter("batch_id > 2").write.partitionBy("stream", "batch_id").parquet(feed.partials + "-left")
    feed.partials += "-left"
    assert feed.served(compacted) == whole
    merged = spark.read.parquet(compacted)
    assert merged.groupBy(*kpis.GRAIN).count().where("count > 1").isEmpty()


def test_batches_written_after_compaction_are_served(feed, spark, tmp_path):
    compacted = str(tmp_path / "compacted")
    feed.put(*_events(1, 30))
    feed.put(*_events(2, 30))
    for seed in (3, 4):
        feed.run()
        compaction.compact_partials(spark, feed.partials, compacted, 1000)
        assert feed.served(compacted) == feed.batch()
        feed.put(*_events(seed, 30))
    feed.run()
    assert feed.served(compacted) == feed.batch()


def test_a_compaction_lost_halfway_is_never_seen(feed, spark, tmp_path):
    """Some dates are merged through a later batch than others."""
    feed.put(*_events(8, 30))
    feed.put(*_events(9, 30))
    feed.run()
    compacted, whole = tmp_path / "compacted", str(tmp_path / "whole")
    compaction.compact_partials(spark, feed.partials, str(compacted), 0)
    compaction.compact_partials(spark, feed.partials, whole, 0)
    compaction.compact_partials(spark, feed.partials, whole)
    one = spark.read.parquet(whole).where("date = '2024-03-01'").drop("date")
    one.write.mode("overwrite").parquet(str(compacted / "date=2024-03-01"))
    assert feed.served(str(compacted)) == feed.batch()
    compaction.compact_partials(spark, feed.partials, str(compacted))
    assert feed.served(str(compacted)) == feed.batch()
    assert spark.read.parquet(str(compacted)).select("through").distinct().count() == 1


def test_a_batch_that_is_lost_and_repeated_counts_once_at_any_time(feed, spark):
    write = kpi_stream.write_partials(feed.partials)
    feed.put(*_events(5))
    feed.run()
    feed.put(*_events(6))

    def fails(df, batch_id):
        write(df, batch_id)
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        feed.run(write=fails)
    assert feed.served() == feed.batch()
    feed.run()
    assert feed.served() == feed.batch()


def test_a_second_stream_with_a_checkpoint_of_its_own_is_refused(feed):
    feed.put(event(at(1, 8)))
    feed.run()
    first, other = feed.partials, feed.checkpoint + "-other"
    feed.partials, feed.checkpoint = feed.partials + "-other", other
    feed.run()
    feed.partials = first
    feed.put(event(at(1, 9)))
    with pytest.raises(Exception, match="another checkpoint"):
        feed.run()


def test_dropped_events_are_counted(feed):
    # An event is measured against the limit that the batch before the last one has set.
    for number, when in enumerate((at(1, 8), at(9, 8), at(9, 9), at(1, 8))):
        feed.put(event(when, node=number))
    query = kpi_stream.start_kpi_stream(
        feed.stream(), feed.partials, feed.checkpoint, once=True, distinct_within="1 hour")
    query.awaitTermination()
    assert kpi_stream.late_dropped(query) == 1


def test_streamed_sink_rows(feed, spark, tmp_path):
    jobs = spark.createDataFrame([(1, 10, 1, 1)], "id int, company_id int, group_id int, campaign_id int")
    path, checkpoint, tries = str(tmp_path / "sink"), str(tmp_path / "progress"), []
    put = sink_stream.to_files(path)

    def fails_once(rows, batch_id):
        put(rows, batch_id)
        tries.append(batch_id)
        if tries == [0, 1]:
            raise RuntimeError("lost")

    def run():
        sink_stream.start_sink_stream(
            feed.stream(), jobs, path, checkpoint, once=True, write=fails_once).awaitTermination()

    for seed in range(3):
        feed.put(*_events(seed, 30))
    with pytest.raises(Exception, match="lost"):
        run()
    run()
    assert tries == [0, 1, 1, 2]
    merged = reports.sink_merged(sink_stream.streamed_rows(spark, path))
    found = {(r.job_id, str(r.dates), r.hours): (r.clicks, r.conversion, r.company_id) for r in merged.collect()}
    whole = kpis.hourly_kpis(tracking_events(spark.read.parquet(feed.inbox))).collect()
    assert found == {
        (r.job_id, str(r.date), r.hour): (r.clicks, r.conversions, 10 if r.job_id == 1 else None) for r in whole}


def test_replacing_a_batch_in_a_database():
    assert sink_stream.replace_statements("kpi", ["job_id", "clicks"]) == [
        "DELETE FROM kpi WHERE batch_id = ?",
        "INSERT INTO kpi (job_id, clicks, batch_id) SELECT job_id, clicks, ? FROM kpi_staging",
    ]


PAYLOADS = [(i, t) for i, t in enumerate([
    '{"job_id":1,"bid":2}', '{"job_id":1}', '{"job_id":2,"custom_track":"qualified"}', "nope", "[]",
    '{"custom_track":"view"}',
])]


def _columns():
    at_eight = F.lit("2024-03-01 08:00:00").cast("timestamp")
    return F.col("body"), at_eight, F.col("offset")


@pytest.mark.parametrize("streamed", [False, True])
def test_payloads_are_landed_once_on_the_side_they_belong(spark, tmp_path, streamed):
    inbox, landing = str(tmp_path / "inbox"), str(tmp_path / "landing")
    payloads = spark.createDataFrame(PAYLOADS, "offset bigint, body string")
    payloads.repartition(3).write.parquet(inbox)
    if streamed:
        source = spark.readStream.schema(payloads.schema).option("maxFilesPerTrigger", 1)
        for _ in range(2):
            ingest_stream.start_ingest_stream(
                source.parquet(inbox), *_columns(), landing, str(tmp_path / "progress"), once=True,
                tasks=1,
            ).awaitTermination()
    else:
        land_payloads(payloads, *_columns(), landing)
    log = read_log(spark, landing)
    assert log.count() == 4 and read_refused(spark, landing).count() == 2
    assert {str(r[0]) for r in log.select(LOG_DATE).collect()} == {"2024-03-01"}
    plan = log._jdf.queryExecution().executedPlan().toString()
    assert "status" in plan.split("PartitionFilters: [")[1].split("]")[0]
    if streamed:
        checkpoint, partials = str(tmp_path / "kpi"), str(tmp_path / "partials")
        kpi_stream.start_kpi_stream(
            read_log(spark, landing, stream=True), partials, checkpoint, once=True
        ).awaitTermination()
        found = reports.kpi_merged(compaction.served_partials(spark, partials))
        assert sorted((r.job_id, r.clicks, r.spend_hour, r.qualified) for r in found.collect()) == [
            (1, 2, 2, None), (2, None, None, 1),
        ]


def test_a_batch_and_a_stream_land_at_one_place(spark, tmp_path):
    inbox, landing = str(tmp_path / "inbox"), str(tmp_path / "landing")
    payloads = spark.createDataFrame(PAYLOADS, "offset bigint, body string")
    assert read_log(spark, landing).count() == 0
    for _ in range(2):
        land_payloads(payloads.where("offset = 0"), *_columns(), landing, name="first")
    payloads.where("offset IN (1, 2, 3)").write.parquet(inbox)

    def run(checkpoint):
        ingest_stream.start_ingest_stream(
            spark.readStream.schema(payloads.schema).parquet(inbox), *_columns(), landing, checkpoint,
            once=True).awaitTermination()

    for _ in range(2):
        run(str(tmp_path / "progress"))
        payloads.where("offset = 4").write.mode("append").parquet(inbox)
    land_payloads(payloads.where("offset = 5"), *_columns(), landing)
    assert read_log(spark, landing).count() == 4 and read_refused(spark, landing).count() == 2
    with pytest.raises(ValueError, match="another checkpoint"):
        run(str(tmp_path / "other"))
