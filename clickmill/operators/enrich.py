"""Joining details on, and shaping KPI rows for the sink."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.schemas import DEFAULT_SOURCE, GRAIN, HOURLY_KPI

# A lookup table up to this size is broadcast to every executor.
BROADCAST_BYTES = 32 * 1024 * 1024
# Beyond it, every key's rows are spread over this many join keys.
SALTS = 16

# KPI name -> sink column, and the order of the columns written.
SINK_NAMES = {
    "date": "dates",
    "hour": "hours",
    "qualified": "qualified_application",
    "unqualified": "disqualified_application",
    "conversions": "conversion",
}
SINK_ORDER = [
    "job_id", "dates", "hours", "publisher_id", "company_id", "campaign_id", "group_id",
    "disqualified_application", "qualified_application", "conversion", "clicks", "bid_set",
    "spend_hour", "updated_at",
]


def job_dim(jobs: DataFrame) -> DataFrame:
    """The job columns the KPI job knows."""
    return jobs.select(F.col("id").alias("job_id"), "company_id", "group_id", "campaign_id")


def publisher_ids(publishers: DataFrame) -> DataFrame:
    return publishers.select(F.col("id").alias("publisher_id")).distinct()


def job_group_ids(jobs: DataFrame) -> DataFrame:
    """The group of every job that has one."""
    return jobs.filter(F.col("group_id").isNotNull()).select(F.col("group_id").cast("int"))


def lookup_bytes(lookup: DataFrame) -> int:
    """The size of a lookup table's values: texts as they are, anything else as 8 bytes."""
    texts = [f.name for f in lookup.schema if f.dataType.simpleString() == "string"]
    fixed = 8 * (len(lookup.columns) - len(texts))
    lengths = [F.coalesce(F.sum(F.octet_length(t)), F.lit(0)) for t in texts]
    size = sum(lengths, F.count(F.lit(1)) * fixed)
    return lookup.agg(size.alias("bytes")).first()["bytes"]


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    spread_by: list[str],
    broadcast_bytes: int = BROADCAST_BYTES,
    salts: int = SALTS,
) -> DataFrame:
    """Left join a lookup table with unique ``key`` to facts that may be skewed on it.

    The lookup is measured first; for plain numbers parquet's footers tell. Small enough, it is
    broadcast and the facts stay where they are. Otherwise both sides are shuffled, with a hot key
    split over ``salts`` partitions: facts get a salt from the columns ``spread_by``, and the
    lookup, which is narrow, is repeated once per salt.
    """
    if lookup_bytes(lookup) <= broadcast_bytes:
        return facts.join(F.broadcast(lookup), key, "left")
    if salts == 1:
        return facts.join(lookup, key, "left")
    salt = F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int")
    spread = lookup.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return facts.withColumn("salt", salt).join(spread, [key, "salt"], "left").drop("salt")


def company_enriched(kpis: DataFrame, jobs: DataFrame, **join: int) -> DataFrame:
    """KPI rows with the company owning the job; an unknown job leaves it NULL."""
    companies = job_dim(jobs).select("job_id", "company_id")
    rest = [c for c in GRAIN if c != "job_id"]
    return attach(kpis, companies, "job_id", rest, **join)


def keep_bucketed(df: DataFrame, table: str, path: str, key: str = "job_id", buckets: int = 64) -> DataFrame:
    """A table kept in buckets of ``key`` and sorted within them, to be joined where it lies.

    The rows are shuffled once, when the table is written; joins on the key with tables in as many
    buckets shuffle nothing, however often they are made and however large both sides are. A
    bucket is read by one task: keep rows of a bounded number per key in it, such as KPI rows, of
    which a job has one per hour and grain, rather than events.
    """
    spread = df.repartition(buckets, key)
    spread.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def company_bucketed(kpis: DataFrame, jobs: DataFrame) -> DataFrame:
    """``company_enriched`` of tables kept in equal buckets of ``job_id``: merged bucket by bucket.

    No table is measured, none is sent around, and there is no salt.
    """
    return kpis.hint("merge").join(jobs.select("job_id", "company_id"), "job_id", "left")


def sink_rows(
    enriched: DataFrame, updated_at: Column, source: str = DEFAULT_SOURCE
) -> DataFrame:
    """Enriched KPIs under the sink's column names, with lineage and the batch's high mark."""
    named = enriched.withColumn("updated_at", updated_at).withColumnsRenamed(SINK_NAMES)
    return named.select(*SINK_ORDER, F.lit(0).alias("impression"), F.lit(source).alias("sources"))


def to_sink_types(rows: DataFrame) -> DataFrame:
    """All sink columns in their declared types and order, with a repeatable surrogate id.

    The id is a hash: among billions of rows some share one. The key is the grain and ``updated_at``.
    """
    grain = [SINK_NAMES.get(c, c) for c in GRAIN]
    keyed = rows.withColumn("id", F.xxhash64(*grain, "updated_at"))
    return keyed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in HOURLY_KPI])
