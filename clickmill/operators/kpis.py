"""Counting and pricing events per hour.

Everything rests on one additive row per grain key, the *partial*: four counts, the sum of click
bids and the newest event time. Partials come from a single pass over the events, are combined
before the shuffle, and can be added up again in any split and order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.time_uuid import date_of, gregorian_hours, hour_of
from clickmill.operators.tracking import fill_ids
from clickmill.schemas import COUNTS, GRAIN, IDS, KINDS

PARTIAL_COLUMNS = [*GRAIN, *COUNTS, "bid_sum", "max_ts"]
MEASURES = ["bid_set", "clicks", "spend_hour", "conversions", "qualified", "unqualified"]


def _split_hours(df: DataFrame) -> DataFrame:
    """UTC date and hour from the hours grouped by, whatever the session's time zone."""
    hours = F.col("hours")
    return df.withColumns({"date": date_of(hours), "hour": hour_of(hours)}).drop("hours")


def _by_hour(events: DataFrame, hours: Column, *measures: Column) -> DataFrame:
    """Aggregate per grain key, with the hour as one number; ``_split_hours`` takes it apart.

    Events without a time form groups without a newest time. They are left out only here, as a
    filter on each event would decode its id twice.
    """
    grouped = events.withColumn("hours", hours).groupBy(*IDS, "hours")
    return grouped.agg(*measures, F.max("ts").alias("max_ts")).filter(F.col("max_ts").isNotNull())


def _of_kind(events: DataFrame, kind: str, *measures: Column) -> DataFrame:
    filled = fill_ids(events.filter(F.col("custom_track") == kind))
    return _by_hour(filled, gregorian_hours(F.col("ts")), *measures).drop("max_ts")


def _clicks(events: DataFrame) -> DataFrame:
    bid = F.coalesce(F.col("bid"), F.lit(0))
    return _of_kind(
        events, "click",
        F.round(F.avg(bid), 2).alias("bid_set"),
        F.count(F.lit(1)).alias("clicks"),
        F.round(F.sum(bid), 2).alias("spend_hour"),
    )


def _count(events: DataFrame, kind: str) -> DataFrame:
    return _of_kind(events, kind, F.count(F.lit(1)).alias(KINDS[kind]))


def clicks_hourly(events: DataFrame) -> DataFrame:
    """Clicks, mean bid and spend per grain key; a missing bid counts as 0."""
    return _split_hours(_clicks(events)).select(*GRAIN, "bid_set", "clicks", "spend_hour")


def kind_hourly(events: DataFrame, kind: str) -> DataFrame:
    """Number of events of one kind per grain key."""
    return _split_hours(_count(events, kind)).select(*GRAIN, KINDS[kind])


def hourly_kpis_join(events: DataFrame) -> DataFrame:
    """All KPIs as four aggregates joined in full; the same rows as ``hourly_kpis``, for checking.

    Joined on the columns grouped by, so that the aggregates' partitioning serves the joins.
    """
    branches = [_clicks(events)] + [_count(events, k) for k in KINDS if k != "click"]
    joined = reduce(lambda left, right: left.join(right, [*IDS, "hours"], "full"), branches)
    return _split_hours(joined).select(*GRAIN, *MEASURES)


def hourly_partials(events: DataFrame, carry_other_kinds: bool = False) -> DataFrame:
    """One additive row per grain key, from one scan and one shuffle.

    ``carry_other_kinds`` adds a single row with a NULL key for all events of other kinds, so that
    ``batch_high_mark`` of the result is the newest time of the whole batch.
    """
    kind = F.col("custom_track")
    known = kind.isin(*KINDS)
    hours = gregorian_hours(F.col("ts"))
    if carry_other_kinds:
        filled = fill_ids(events).withColumns({c: F.when(known, F.col(c)) for c in IDS})
        hours = F.when(known, hours)
    else:
        filled = fill_ids(events.filter(known))
    partials = _by_hour(
        filled, hours,
        *[F.count_if(kind == k).alias(name) for k, name in KINDS.items()],
        F.sum(F.when(kind == "click", F.coalesce(F.col("bid"), F.lit(0)))).alias("bid_sum"),
    )
    return _split_hours(partials).select(*PARTIAL_COLUMNS)


def merge_partials(partials: DataFrame) -> DataFrame:
    """Add up partials of one key; associative, so any split of the events gives the same rows."""
    return partials.groupBy(*GRAIN).agg(
        *[F.sum(c).alias(c) for c in COUNTS],
        F.sum("bid_sum").alias("bid_sum"),
        F.max("max_ts").alias("max_ts"),
    )


def finish_partials(partials: DataFrame, *more: str) -> DataFrame:
    """Partials, one per key, as KPIs: a kind not seen is NULL, and money is rounded once."""
    mean = F.try_divide(F.col("bid_sum"), F.col("clicks"))
    measures = {
        "bid_set": F.round(mean, 2),
        "spend_hour": F.round("bid_sum", 2),
        **{c: F.nullif(F.col(c), F.lit(0)) for c in COUNTS},
    }
    return (
        partials.filter(F.col("job_id").isNotNull())
        .select(*GRAIN, *[measures[m].alias(m) for m in MEASURES], *more)
    )


def hourly_kpis(events: DataFrame) -> DataFrame:
    """All KPIs per grain key in a single pass."""
    return finish_partials(hourly_partials(events))


def batch_high_mark(events: DataFrame, column: str = "ts") -> DataFrame:
    """One row: the newest event time over all events, whatever their kind."""
    return events.agg(F.max(column).alias("high_mark"))
