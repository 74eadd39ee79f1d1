import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from clickmill.operators import kpis, reports
from clickmill.operators.tracking import (
    filled_events, incremental_slice, late_events, tracking_events,
)
from tests.helpers import at, event, rows

DAY = dt.date(2024, 3, 1)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _mixed_log(log, rng, n=400):
    kinds = ["click", "conversion", "qualified", "unqualified", "view", None]
    return log(*[
        event(
            at(rng.randint(1, 3), rng.randint(0, 4), rng.randint(0, 59), rng.randint(0, 59)),
            rng.choice(kinds), rng.choice([None, 0, 1, 2]), node=i,
            bid=rng.choice([None, 0, 1, 2, 5]), publisher_id=rng.choice([None, 0, 1]),
            campaign_id=rng.choice([None, 3]), group_id=rng.choice([None, 4]),
        )
        for i in range(n)
    ] + [{"create_time": "no id", "job_id": 1, "custom_track": "click", "bid": 9}])


def test_events_are_those_of_a_job_with_their_time_decoded_anew(log):
    raw = log(event(at(1, 8), ts="1999-01-01 00:00:00"), event(at(1, 9), job=None))
    found = tracking_events(raw)
    assert found.columns == [
        "create_time", "job_id", "custom_track", "bid", "campaign_id", "group_id",
        "publisher_id", "ts",
    ]
    assert [r.ts for r in found.select(F.col("ts").cast("timestamp_ntz")).collect()] == [at(1, 8)]


def test_missing_ids_and_click_bids_are_filled(log):
    nothing = {"publisher_id": None, "campaign_id": None, "group_id": None, "bid": None}
    raw = log(event(at(1, 8), **nothing), event(at(1, 8), "conversion", **nothing))
    found = {r.custom_track: r for r in filled_events(tracking_events(raw)).collect()}
    assert [found["click"][c] for c in nothing] == [0, 0, 0, 0]
    assert [found["conversion"][c] for c in nothing] == [0, 0, 0, None]


def test_kinds_not_seen_stay_null_and_money_is_rounded_once(log):
    events = tracking_events(log(
        *[event(at(1, 8, m), bid=b) for m, b in enumerate([1, 1, None, 5, 5, 5])],
        event(at(1, 8), "conversion", job=2, bid=7),
    ))
    found = {r.job_id: r for r in kpis.hourly_kpis(events).collect()}
    assert (found[1].clicks, found[1].bid_set, found[1].spend_hour) == (6, 2.83, 17)
    assert found[1].conversions is found[1].qualified is found[1].unqualified is None
    assert (found[2].conversions, found[2].clicks, found[2].spend_hour) == (1, None, None)


def test_unknown_ids_share_the_bucket_of_0(log):
    events = tracking_events(log(event(at(1, 8), publisher_id=None), event(at(1, 8), publisher_id=0)))
    assert [(r.publisher_id, r.clicks) for r in kpis.hourly_kpis(events).collect()] == [(0, 2)]


def test_unknown_kinds_and_untimed_events_make_no_rows(log):
    raw = log(event(at(1, 8), "view"), event(at(1, 8), "Click"), event(at(1, 8), None),
              event(at(1, 8)) | {"create_time": "x"})
    events = tracking_events(raw)
    assert kpis.hourly_kpis(events).isEmpty() and kpis.hourly_kpis_join(events).isEmpty()


@pytest.mark.parametrize("seed", range(3))
def test_one_pass_equals_four_joined_branches(log, seed):
    events = tracking_events(_mixed_log(log, random.Random(seed)))
    assert rows(kpis.hourly_kpis(events)) == rows(kpis.hourly_kpis_join(events))


@pytest.mark.parametrize("parts", [2, 5])
def test_partials_add_up_in_any_split(log, parts):
    raw = _mixed_log(log, random.Random(parts))
    split = F.pmod(F.xxhash64("create_time"), F.lit(parts))
    partials = None
    for i in range(parts):
        part = kpis.hourly_partials(tracking_events(raw.filter(split == i)))
        partials = part if partials is None else part.unionByName(partials)
    assert rows(reports.kpi_merged(partials)) == rows(kpis.hourly_kpis(tracking_events(raw)))


@pytest.mark.parametrize("bid_type, bids, mean, total", [
    ("double", [1.5, 2.0, None], 1.17, 3.5),
    ("decimal(10,2)", [Decimal("1.50"), Decimal("2.00"), None], Decimal("1.17"), Decimal("3.50")),
])
def test_fractional_bids(log, bid_type, bids, mean, total):
    raw = log(*[event(at(1, 8, m), bid=b) for m, b in enumerate(bids)], bid_type=bid_type)
    for query in (kpis.hourly_kpis, kpis.clicks_hourly):
        row = query(tracking_events(raw)).first()
        assert (row.bid_set, row.spend_hour) == (mean, total)


def test_the_high_mark_covers_kinds_not_counted(log):
    events = tracking_events(log(event(at(1, 8)), event(at(1, 9), "view")))
    assert kpis.batch_high_mark(events).first().high_mark.replace(tzinfo=None) == at(1, 9)
    staged = kpis.hourly_partials(events, carry_other_kinds=True)
    assert kpis.batch_high_mark(staged, "max_ts").first().high_mark.replace(tzinfo=None) == at(1, 9)
    assert rows(kpis.finish_partials(staged)) == rows(kpis.hourly_kpis(events))


def test_slices_start_at_the_watermark_or_after_it(log):
    events = tracking_events(log(event(at(1, 8)), event(at(1, 9)), event(at(1, 9)) | {"create_time": ""}))
    mark = "2024-03-01 08:00:00"
    assert incremental_slice(events, mark).count() == 2
    assert incremental_slice(events, mark, inclusive=False).count() == 1


def test_late_events_by_whole_hours(log):
    events = tracking_events(log(event(at(1, 8)), event(at(1, 9, 59)), event(at(1, 10))))
    found = late_events(events, "2024-03-01 10:00:00")
    assert rows(found) == [("click", 1, 0), ("click", 1, 2)]


def test_reports(log, spark):
    events = tracking_events(log(
        event(at(1, 8), bid=3), event(at(1, 9), bid=2), event(at(1, 9), "qualified"),
        event(at(1, 9), "unqualified"), event(at(1, 9), "conversion", campaign_id=2),
        event(at(1, 9), "qualified", publisher_id=2, campaign_id=2),
    ))
    hourly = kpis.hourly_kpis(events)
    day = reports.kpi_by_job_day(hourly).first().asDict()
    assert day == {"job_id": 1, "dates": DAY, "clicks": 2, "conversions": 1, "qualified": 2,
                   "unqualified": 1, "spend": 5}
    names = spark.createDataFrame([(1, "one")], "id int, publisher_name string")
    quality = {r.publisher_id: (r.quality, r.publisher_name)
               for r in reports.kpi_by_publisher(hourly, names).collect()}
    assert quality == {1: (0.5, "one"), 2: (1.0, None)}
    cost = {r.campaign_id: r.cost_per_conversion for r in reports.kpi_by_campaign(hourly).collect()}
    assert cost == {1: None, 2: None}


def test_one_scan_one_shuffle_no_join_no_python(log, spark, tmp_path):
    path = str(tmp_path / "log")
    log(event(at(1, 8))).write.parquet(path)
    one_pass = _plan(kpis.hourly_kpis(tracking_events(spark.read.parquet(path))))
    assert one_pass.count("FileScan") == one_pass.count("Exchange hashpartitioning") == 1
    assert "Join" not in one_pass and "Python" not in one_pass
    assert "IsNotNull(job_id), In(custom_track, [click,conversion,qualified,unqualified])" in one_pass
    assert "utm_source" not in one_pass
    branches = _plan(kpis.hourly_kpis_join(tracking_events(spark.read.parquet(path))))
    assert branches.count("FileScan") == 4


def test_the_three_reports_in_one_pass(log, spark, tmp_path):
    events = tracking_events(log(
        event(at(1, 8), bid=3), event(at(1, 9), bid=2), event(at(2, 9), "qualified"), event(at(2, 9), "unqualified", publisher_id=None),
        event(at(1, 9), "conversion", campaign_id=2), event(at(1, 9), "qualified", publisher_id=2, campaign_id=0, job=0),
    ))
    path = str(tmp_path / "kpis")
    kpis.hourly_kpis(events).write.parquet(path)
    hourly, names = spark.read.parquet(path), spark.createDataFrame([(1, "one")], "id int, publisher_name string")
    whole = reports.kpi_reports(hourly, names)
    for name, single in {
        "job_day": reports.kpi_by_job_day(hourly), "publisher": reports.kpi_by_publisher(hourly, names),
        "campaign": reports.kpi_by_campaign(hourly),
    }.items():
        part = whole.where(F.col("report") == name)
        assert rows(part.select(*single.columns)) == rows(single)
        rest = [c for c in whole.columns if c not in (*single.columns, "report")]
        assert rest and all(part.where(F.col(c).isNotNull()).isEmpty() for c in rest)
    plan = _plan(whole)
    assert plan.count("FileScan parquet") == plan.count("Exchange hashpartitioning") == 1
