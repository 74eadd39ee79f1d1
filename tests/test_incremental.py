import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickmill.operators import kpis
from clickmill.operators.reports import sink_merged
from clickmill.operators.tracking import LOG_DATE, incremental_slice, tracking_events, with_event_time
from clickmill.plans.incremental import run_incremental
from clickmill.schemas import FIRST_WATERMARK, HOURLY_KPI
from clickmill.sources.readers import read_events, read_if_present, sink_watermark, watermark_value
from clickmill.session import scratch_dir
from clickmill.sources.sinks import ParquetSink, Run, parquet_sink, publish_statements
from clickmill.sources.writers import write_log
from tests.helpers import at, event, rows


def micros(moment):
    return (moment - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)


@pytest.fixture
def jobs(spark):
    return spark.createDataFrame(
        [(1, 10, 1, 1)], "id int, company_id int, group_id int, campaign_id int"
    )


@pytest.fixture
def zone(spark):
    """Sets the session's time zone for one test."""
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.fixture
def sink(tmp_path):
    return str(tmp_path / "sink")


def _run(spark, raw, jobs, sink, **options):
    events = tracking_events(with_event_time(raw))
    return run_incremental(events, jobs, parquet_sink(spark, sink), **options)


def _sink(spark, sink):
    columns = ["dates", "hours", "clicks", "conversion", "company_id", "updated_at"]
    found = parquet_sink(spark, sink).rows().select(*columns)
    return sorted(
        (r.hours, r.clicks, r.conversion, r.company_id, r.updated_at.replace(tzinfo=None))
        for r in found.collect()
    )


def test_the_boundary_second_is_read_again_and_late_events_never(spark, log, jobs, sink):
    first = [event(at(1, 8)), event(at(1, 9))]
    assert _run(spark, log(*first), jobs, sink)
    later = [event(at(1, 7), node=1), event(at(1, 9, 30)), event(at(1, 10))]
    assert _run(spark, log(*first, *later), jobs, sink)
    assert _sink(spark, sink) == [
        (8, 1, None, 10, at(1, 9)),
        (9, 1, None, 10, at(1, 9)),
        (9, 2, None, 10, at(1, 10)),
        (10, 1, None, 10, at(1, 10)),
    ]


def test_an_exclusive_run_without_news_writes_nothing(spark, log, jobs, sink):
    raw = log(event(at(1, 8)))
    assert _run(spark, raw, jobs, sink, inclusive=False)
    before = _sink(spark, sink)
    assert not _run(spark, raw, jobs, sink, inclusive=False)
    assert _sink(spark, sink) == before
    # An inclusive run without news finds the last second again, and adds nothing.
    assert _run(spark, raw, jobs, sink) and _sink(spark, sink) == before


def test_kinds_not_counted_move_the_mark_only_with_others(spark, log, jobs, sink):
    assert not _run(spark, log(event(at(1, 9), "view")), jobs, sink)
    assert parquet_sink(spark, sink).mark() == micros(dt.datetime.fromisoformat(FIRST_WATERMARK))
    assert _run(spark, log(event(at(1, 8)), event(at(1, 9), "view")), jobs, sink)
    assert _sink(spark, sink) == [(8, 1, None, 10, at(1, 9))]


def test_only_a_missing_sink_gives_the_first_watermark(spark, sink):
    missing = sink_watermark(read_if_present(spark, sink, HOURLY_KPI)).first().watermark
    assert missing.replace(tzinfo=None) == dt.datetime(1998, 1, 1, 23, 59, 59)
    with pytest.raises(Exception, match="nosuchscheme"):
        read_if_present(spark, "nosuchscheme://x/y", HOURLY_KPI)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_kept_log_is_pruned_by_date_and_time_and_its_ids_are_not_read(spark, log, tmp_path):
    path, mark = str(tmp_path / "log"), "2024-03-02 08:00:00"
    raw = log(*[event(at(d, 8)) for d in (1, 2, 3)], event(at(2, 7)), event(at(3, 8)) | {"create_time": "x"})
    write_log(raw, path)
    events = tracking_events(read_events(spark, kept=True, path=path))
    fresh = incremental_slice(events, mark)
    assert rows(fresh.drop(LOG_DATE)) == rows(incremental_slice(tracking_events(raw), mark))
    assert len({r.f for r in fresh.select(F.input_file_name().alias("f")).collect()}) == 2
    plan = _plan(kpis.hourly_kpis(fresh))
    assert LOG_DATE in plan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "GreaterThanOrEqual(event_time" in plan and "create_time" not in plan
    assert rows(kpis.hourly_kpis(events)) == rows(kpis.hourly_kpis(tracking_events(raw)))


def test_pruning_goes_by_utc_dates_in_any_session_zone(spark, log, tmp_path, zone):
    path = str(tmp_path / "log")
    write_log(log(event(at(1, 20)), event(at(1, 23)), event(at(2, 1))), path)
    zone("Asia/Tokyo")
    fresh = incremental_slice(tracking_events(spark.read.parquet(path)), "2024-03-02 05:00:00+09:00")
    assert fresh.count() == 3


@pytest.mark.parametrize("name, moment", [
    ("Europe/Berlin", "2024-10-27 00:30:00"), ("Europe/Berlin", "2024-10-27 01:30:00"), ("Asia/Tokyo", "2024-03-02 05:00:00"),
])
def test_a_mark_comes_back_as_it_was_in_any_session_zone(spark, log, jobs, sink, zone, name, moment):
    zone(name)
    when = dt.datetime.fromisoformat(moment)
    assert _run(spark, log(event(when), event(when - dt.timedelta(hours=3))), jobs, sink)
    table = parquet_sink(spark, sink)
    assert table.mark() == watermark_value(table.rows()) == micros(when)
    assert incremental_slice(tracking_events(log(event(when))), table.mark()).count() == 1
    assert incremental_slice(tracking_events(log(event(when))), moment).count() == 1
    assert incremental_slice(tracking_events(log(event(when - dt.timedelta(seconds=1)))), when).count() == 0
    empty = parquet_sink(spark, sink + "-none")
    assert empty.mark() == micros(dt.datetime.fromisoformat(FIRST_WATERMARK))


class Lost(ParquetSink):
    """Breaks down in one of its steps, and takes nothing away when it has."""

    def __init__(self, spark, path, step):
        super().__init__(spark, path)
        self.step = step

    def write(self, rows, name):
        super().write(rows.where("hours <> 8") if self.step == "write" else rows, name)
        if self.step == "write":
            raise RuntimeError("lost")

    def _put(self, df, name, part, *partitions):
        super()._put(df, name, part, *partitions)
        if self.step == part:
            raise RuntimeError("lost")

    def discard(self, name):
        pass


@pytest.mark.parametrize("step", ["write", "tails", "recounted"])
@pytest.mark.parametrize("name", [None, "nightly"])
def test_a_run_lost_halfway_is_not_seen_and_is_made_good(spark, log, jobs, sink, step, name):
    first, later = [event(at(1, 8)), event(at(1, 9))], [event(at(1, 10)), event(at(2, 8)), event(at(3, 8))]
    assert _run(spark, log(*first), jobs, sink)
    before = _sink(spark, sink)
    with pytest.raises(RuntimeError, match="lost"):
        events = tracking_events(with_event_time(log(*first, *later)))
        run_incremental(events, jobs, Lost(spark, sink, step), name=name)
    assert _sink(spark, sink) == before
    more = event(at(3, 9))
    assert _run(spark, log(*first, *later, more), jobs, sink, name=name)
    assert len(_sink(spark, sink)) == 2 + 5
    merged = sink_merged(parquet_sink(spark, sink).rows(), parquet_sink(spark, sink).recounted())
    assert sum(r.clicks for r in merged.collect()) == 6


def test_a_named_run_is_published_once(spark, log, jobs, sink):
    first = [event(at(1, 8)), event(at(1, 9))]
    for _ in range(2):
        assert _run(spark, log(*first), jobs, sink, name="2024-03-01T10.00")
    before = _sink(spark, sink)
    assert _run(spark, log(*first, event(at(1, 11))), jobs, sink, name="2024-03-01T10.00")
    assert _sink(spark, sink) == before
    with pytest.raises(ValueError, match="no name of a run"):
        _run(spark, log(*first, event(at(1, 11))), jobs, sink, name="a/b")


def test_of_two_writers_from_one_mark_the_first_counts(spark, log, jobs, sink):
    """Both have read the mark; one sees fewer events, and whichever publishes second adds nothing."""
    first = [event(at(1, 8)), event(at(1, 9))]
    assert _run(spark, log(*first), jobs, sink)
    start = parquet_sink(spark, sink).mark()
    assert _run(spark, log(*first, event(at(1, 10)), event(at(1, 11))), jobs, sink)
    before, mark = _sink(spark, sink), parquet_sink(spark, sink).mark()
    slow = log(*first, event(at(1, 10)))
    assert _run(spark, slow, jobs, sink, since=start)
    assert _sink(spark, sink) == before and parquet_sink(spark, sink).mark() == mark
    assert _run(spark, log(*first, event(at(1, 10)), event(at(1, 11)), event(at(1, 12))), jobs, sink)
    table = parquet_sink(spark, sink)
    merged = sink_merged(table.rows(), table.recounted()).collect()
    assert {r.hours: r.clicks for r in merged} == {h: 1 for h in (8, 9, 10, 11, 12)}


def test_a_failed_or_idle_run_takes_its_rows_away(spark, log, jobs, sink, tmp_path):
    raw = log(event(at(1, 8)))
    assert _run(spark, raw, jobs, sink)
    folders = sorted(p.name for p in (tmp_path / "sink" / "rows").glob("run=*"))
    assert _run(spark, raw, jobs, sink) and not _run(spark, raw, jobs, sink, inclusive=False)
    with pytest.raises(Exception):
        _run(spark, log(event(at(1, 9))), jobs.drop("company_id"), sink)
    assert sorted(p.name for p in (tmp_path / "sink" / "rows").glob("run=*")) == folders


def test_a_run_reads_the_events_once(spark, log, jobs, tmp_path):
    """The mark is observed while rows are written; only the newest second is read again."""
    path, sink = str(tmp_path / "log"), parquet_sink(spark, str(tmp_path / "sink"))
    write_log(log(*[event(at(d, 8), node=d) for d in (1, 2, 3)]), path)
    jobs_seen = []
    written = sink.write

    def write(rows, name):
        jobs_seen.append(_plan(rows).count("FileScan parquet"))
        written(rows, name)

    sink.write = write
    run_incremental(tracking_events(read_events(spark, kept=True, path=path)), jobs, sink)
    assert jobs_seen == [1]
    assert sink.mark() == micros(at(3, 8))


def test_merged_rows_count_the_shared_second_once(spark, log, jobs, sink):
    first = [event(at(1, 8), bid=1), event(at(1, 9), bid=2), event(at(1, 9), node=1, bid=4)]
    _run(spark, log(*first), jobs, sink)
    later = [event(at(1, 9), node=2, bid=6), event(at(1, 9, 30), bid=8), event(at(1, 9, 40), "conversion")]
    _run(spark, log(*first, *later), jobs, sink)
    _run(spark, log(*first, *later), jobs, sink)
    _run(spark, log(*first, *later, event(at(1, 10), bid=3)), jobs, sink)
    table = parquet_sink(spark, sink)
    found = {r.hours: (r.clicks, float(r.spend_hour or 0), r.conversion, r.company_id) for r in sink_merged(
        table.rows(), table.recounted()).collect()}
    assert found == {8: (1, 1.0, None, 10), 9: (4, 20.0, 1, 10), 10: (1, 3.0, None, 10)}
    assert {float(r.bid_set) for r in sink_merged(table.rows(), table.recounted()).collect()} == {1.0, 5.0, 3.0}


def test_a_raw_log_is_refused(spark, log, jobs, sink):
    with pytest.raises(ValueError, match="write_log"):
        run_incremental(tracking_events(log(event(at(1, 8)))), jobs, parquet_sink(spark, sink))


def test_writing_the_log_leaves_nothing_in_the_shared_folder(spark, log, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    shared.mkdir()
    monkeypatch.setattr("clickmill.session.scratch_dir", lambda s, p: f"{shared}/{p}")
    write_log(log(event(at(1, 8))), str(tmp_path / "log"))
    assert list(shared.iterdir()) == []
    with pytest.raises(Exception):
        write_log(log(event(at(1, 8))), "nosuchscheme://x")
    assert list(shared.iterdir()) == []


def test_events_are_added_to_the_log_once(spark, log, tmp_path):
    path = str(tmp_path / "log")
    first = [event(at(1, 8)), event(at(2, 8)), event(at(2, 8)), event(at(3, 8), node=7)]
    undated = [{"create_time": "x", "custom_track": "click", "job_id": 1}, {"create_time": None, "custom_track": "click", "job_id": 1}]
    write_log(log(*first, *undated[:1]), path)
    assert spark.read.parquet(path).count() == 4
    for _ in range(2):
        write_log(log(*first, event(at(2, 9)), undated[0]), path)
    found = spark.read.parquet(path)
    assert found.count() == found.select("create_time").distinct().count() == 5
    # Without an id nothing tells an event from another.
    write_log(log(undated[1], undated[1]), path)
    assert spark.read.parquet(path).count() == 7
    write_log(log(), path)
    assert spark.read.parquet(path).count() == 7


def test_a_lost_append_is_made_good(spark, log, tmp_path):
    path, events = str(tmp_path / "log"), [event(at(d, 8), node=d) for d in range(1, 6)]
    write_log(log(*events[:2]), path)
    write_log(log(*events), path)
    assert sorted(str(r[0]) for r in spark.read.parquet(path).select(LOG_DATE).collect()) == [
        f"2024-03-0{d}" for d in range(1, 6)]


def test_only_the_dates_of_new_events_are_read(spark, log, tmp_path, monkeypatch):
    path, plans = str(tmp_path / "log"), []
    write_log(log(*[event(at(d, 8), node=d) for d in range(1, 9)]), path)
    from clickmill.sources import writers

    rebalance = writers.by_partition
    monkeypatch.setattr(writers, "by_partition", lambda df, *c: plans.append(_plan(df)) or rebalance(df, *c))
    write_log(log(event(at(3, 8), node=3), event(at(4, 9))), path)
    scans = [line for line in plans[0].splitlines() if "FileScan" in line and LOG_DATE in line]
    assert any("2024-03-03" in line and "2024-03-04" in line for line in scans)


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda *_: None)

        class sparkContext:
            master = "local-cluster[2,1,1024]"
            getCheckpointDir = staticmethod(lambda: None)

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session, "x")


def test_publishing_to_a_database(spark):
    """Two runs from one mark, in a database of this process: one of them is moved, whole."""
    duckdb = pytest.importorskip("duckdb")
    base = duckdb.connect()
    tails = "job_id INT, dates DATE, hours INT, publisher_id INT, campaign_id INT, group_id INT, clicks BIGINT, " \
        "conversion BIGINT, qualified_application BIGINT, disqualified_application BIGINT, spend_hour DECIMAL(21,2)"
    rows_ = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in HOURLY_KPI if f.name not in ("id", "updated_at"))
    for name in ("kpi_tails", "kpi_recounted"):
        base.execute(f"CREATE TABLE {name} ({tails}, updated_at TIMESTAMP)")
    base.execute(f"CREATE TABLE kpi ({rows_}, updated_at TIMESTAMP)")
    base.execute(f"CREATE TABLE kpi_staging ({rows_}, run TEXT)")
    base.execute(f"CREATE TABLE kpi_tails_staging ({tails}, run TEXT)")

    def publish(name, since, mark, inclusive=True):
        base.execute("BEGIN")
        for text, values in publish_statements("kpi", Run(name, since, mark, inclusive, None)):
            base.execute(text, [v if isinstance(v, str) else dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=v) for v in values])
        base.execute("COMMIT")

    def stage(name, *clicks):
        for n in clicks:
            base.execute("INSERT INTO kpi_staging (job_id, clicks, run) VALUES (1, ?, ?)", [n, name])
        base.execute("INSERT INTO kpi_tails_staging (job_id, clicks, run) VALUES (1, 1, ?)", [name])

    count = lambda table: base.execute(f"SELECT count(*), sum(clicks) FROM {table}").fetchone()
    stage("a", 1, 2)
    stage("b", 10, 20, 30)  # staged side by side
    publish("b", 100, 200)
    assert count("kpi") == (3, 60) and count("kpi_tails") == (1, 1) and count("kpi_recounted")[0] == 0
    publish("a", 100, 190)
    assert count("kpi") == (3, 60) and count("kpi_tails") == (1, 1)
    assert count("kpi_staging")[0] == count("kpi_tails_staging")[0] == 0
    stage("c", 5)
    publish("c", 200, 300)
    publish("c", 200, 300)
    assert count("kpi") == (4, 65) and count("kpi_recounted") == (1, 1)
