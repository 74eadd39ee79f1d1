"""Roll-ups of hourly KPIs for reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.operators.enrich import SINK_NAMES, attach
from clickmill.operators.kpis import finish_partials, merge_partials
from clickmill.schemas import COUNTS, GRAIN


def kpi_merged(partials: DataFrame) -> DataFrame:
    """One row per grain key from partials of any number of batches."""
    return finish_partials(merge_partials(partials))


def sink_merged(rows: DataFrame, recounted: DataFrame | None = None) -> DataFrame:
    """One row per key from sink rows of many runs, each second of events counted once.

    ``recounted`` has the partials of seconds that two runs counted (``Sink.recounted``). Means
    are money over clicks of the whole hour, not means of means.
    """
    keys = [SINK_NAMES.get(c, c) for c in GRAIN]
    counts = [SINK_NAMES.get(c, c) for c in COUNTS]
    parts = rows.select(*keys, *counts, "spend_hour", "company_id", "updated_at")
    if recounted is not None:
        less = [(-F.col(c)).alias(c) for c in [*counts, "spend_hour"]]
        parts = parts.unionByName(recounted.select(*keys, *less), allowMissingColumns=True)
    totals = parts.groupBy(*keys).agg(
        *[F.nullif(F.sum(c), F.lit(0)).alias(c) for c in counts],
        F.sum("spend_hour").alias("spend_hour"),
        F.max("company_id").alias("company_id"), F.max("updated_at").alias("updated_at"),
    )
    spend = F.when(F.col("clicks").isNotNull(), F.col("spend_hour"))
    return totals.withColumns({
        "bid_set": F.round(F.try_divide(spend, F.col("clicks")), 2), "spend_hour": spend,
    })


def kpis_of_sink(merged: DataFrame) -> DataFrame:
    """Merged sink rows under the KPIs' own names, for the reports below."""
    return merged.withColumnsRenamed({sink: name for name, sink in SINK_NAMES.items()})


def kpi_by_job_day(kpis: DataFrame) -> DataFrame:
    return kpis.groupBy("job_id", F.col("date").alias("dates")).agg(
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.sum("qualified").alias("qualified"),
        F.sum("unqualified").alias("unqualified"),
        F.sum("spend_hour").alias("spend"),
    )


def kpi_by_publisher(kpis: DataFrame, publishers: DataFrame, **join: int) -> DataFrame:
    """Candidate quality per publisher: the share of qualified among all judged applications."""
    judged = F.coalesce("qualified", F.lit(0)) + F.coalesce("unqualified", F.lit(0))
    totals = kpis.groupBy("publisher_id").agg(
        F.sum("clicks").alias("clicks"),
        F.sum("qualified").alias("qualified"),
        F.sum("unqualified").alias("unqualified"),
        F.sum(judged).alias("judged"),
    )
    names = publishers.select(F.col("id").alias("publisher_id"), "publisher_name")
    rated = totals.withColumn("quality", F.try_divide(F.coalesce("qualified", F.lit(0)), F.col("judged")))
    # One row per publisher, so no key is hot.
    return attach(rated.drop("judged"), names, "publisher_id", ["publisher_id"], salts=1, **join)


def kpi_by_campaign(kpis: DataFrame) -> DataFrame:
    """Spend per campaign and what one conversion cost."""
    totals = kpis.groupBy("campaign_id").agg(
        F.sum("clicks").alias("clicks"),
        F.sum("conversions").alias("conversions"),
        F.sum("spend_hour").alias("spend"),
    )
    return totals.withColumn("cost_per_conversion", F.try_divide(F.col("spend"), F.col("conversions")))


# A report's name by the bits of its grouping id: of publisher, campaign, job and date, those left out.
_REPORTS = {0b1100: "job_day", 0b0111: "publisher", 0b1011: "campaign"}


def kpi_reports(kpis: DataFrame, publishers: DataFrame, **join: int) -> DataFrame:
    """The three reports above as one table, from one pass over the KPIs and one shuffle.

    ``report`` names the one a row belongs to; keys and measures that it does not have are NULL.
    """
    publisher, campaign, job, date = (F.col(c) for c in ("publisher_id", "campaign_id", "job_id", "date"))
    judged = F.coalesce("qualified", F.lit(0)) + F.coalesce("unqualified", F.lit(0))
    totals = kpis.groupingSets([[job, date], [publisher], [campaign]], publisher, campaign, job, date).agg(
        F.grouping_id().alias("left_out"), *[F.sum(c).alias(c) for c in COUNTS],
        F.sum("spend_hour").alias("spend"), F.sum(judged).alias("judged"),
    )
    report = F.element_at(F.create_map(*[F.lit(x) for pair in _REPORTS.items() for x in pair]), F.col("left_out").cast("int"))

    def only(names: list[str], value: Column) -> Column:
        return F.when(F.col("report").isin(names), value)

    named = totals.withColumn("report", report).select(
        "report", "job_id", F.col("date").alias("dates"), "publisher_id", "campaign_id", "clicks",
        only(["job_day", "campaign"], F.col("conversions")).alias("conversions"),
        only(["job_day", "publisher"], F.col("qualified")).alias("qualified"),
        only(["job_day", "publisher"], F.col("unqualified")).alias("unqualified"),
        only(["job_day", "campaign"], F.col("spend")).alias("spend"),
        only(["publisher"], F.try_divide(F.coalesce("qualified", F.lit(0)), F.col("judged"))).alias("quality"),
        only(["campaign"], F.try_divide(F.col("spend"), F.col("conversions"))).alias("cost_per_conversion"),
    )
    names = publishers.select(F.col("id").alias("publisher_id"), "publisher_name")
    return attach(named, names, "publisher_id", ["publisher_id"], salts=1, **join)
