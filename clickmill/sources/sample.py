"""The given test tables seen as an event log, job and publisher tables, and payloads.

The texts are portable SQL, read alike by Spark and by the checking engine; ``plans.oracles``
uses them too, so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.functions.time_uuid import mint_time_uuid
from clickmill.session import apply_settings

# ``k`` is the number in an event's ``props``. Two thirds of the events go to three jobs, two
# publishers and two campaigns; the others to hundreds of jobs, some of them unknown.
TRACKING_COLUMNS = {
    "custom_track": "CASE event_type WHEN 'click' THEN 'click' WHEN 'purchase' THEN 'conversion' "
                    "WHEN 'signup' THEN 'qualified' WHEN 'error' THEN 'unqualified' "
                    "ELSE event_type END",
    "job_id": "CASE WHEN event_id % 50 = 0 THEN NULL WHEN event_id % 3 = 0 THEN CAST(user_id * 11 AS INT) "
              "ELSE CAST(user_id % 3 AS INT) END",
    "bid": "CASE WHEN k % 10 = 0 THEN NULL WHEN k % 4 = 3 THEN 5 ELSE CAST(k % 4 AS INT) END",
    "publisher_id": "CASE WHEN event_id % 17 = 0 THEN NULL "
                    "ELSE CAST(1 + k % CASE WHEN event_id % 3 = 0 THEN 7 ELSE 2 END AS INT) END",
    "campaign_id": "CAST(user_id % CASE WHEN event_id % 3 = 0 THEN 11 ELSE 2 END AS INT)",
    "group_id": "CASE WHEN user_id % 3 = 2 THEN NULL ELSE CAST(user_id % 3 AS INT) END",
}
# Every eleventh event reaches the log a day and a half late.
ARRIVAL = "CASE WHEN event_id % 11 = 0 THEN ts + INTERVAL '36' HOUR ELSE ts END"
# A moment in the middle of the data, between two batches.
CUT = "2024-01-16 00:00:00"

JOB_COLUMNS = {
    "id": "CAST(c_custkey AS INT)",
    "company_id": "CAST(c_nationkey AS INT)",
    "group_id": "CAST(c_custkey % 3 AS INT)",
    "campaign_id": "CAST(c_custkey % 2 AS INT)",
}
PUBLISHER_COLUMNS = {"id": "CAST(s_suppkey AS INT)", "publisher_name": "s_name"}

_K, _U = "CAST(k AS STRING)", "CAST(user_id AS STRING)"
# One payload per event: well-formed ones, odd ones that pass, and ones to refuse.
PAYLOAD = f"""CASE event_id % 25
    WHEN 0 THEN '{{}}'
    WHEN 1 THEN '{{"bid":"' || {_K} || '.9","job_id":"' || {_U} || '"}}'
    WHEN 2 THEN '{{"bid":-' || {_K} || '.9}}'
    WHEN 3 THEN '{{"job_id":' || {_U} || '.7}}'
    WHEN 4 THEN '{{"group_id":null,"job_id":' || {_U} || '}}'
    WHEN 5 THEN '{{"custom_track":"view","publisher_id":' || {_U} || '}}'
    WHEN 6 THEN '{{"custom_track":null,"bid":' || {_K} || '}}'
    WHEN 7 THEN '{{"job_id":true,"campaign_id":false}}'
    WHEN 8 THEN '{{"campaign_id":"' || {_K} || '.5"}}'
    WHEN 9 THEN '{{"campaign_id":null}}'
    WHEN 10 THEN '{{"bid":null,"job_id":' || {_U} || '}}'
    WHEN 11 THEN '{{"bid":1e400}}'
    WHEN 12 THEN '{{"bid":"abc' || {_K} || '"}}'
    WHEN 13 THEN '{{"job_id":' || CAST(3000000000 + user_id AS STRING) || '}}'
    WHEN 14 THEN '[' || {_K} || ']'
    WHEN 15 THEN 'nope ' || {_K}
    WHEN 16 THEN '{{"bid":' || {_K} || '}} and more'
    WHEN 17 THEN '{{"bid":' || {_K} || 'e2,"publisher_id":" +' || {_U} || ' "}}'
    WHEN 18 THEN '{{"bid":{{"v":' || {_K} || '}}}}'
    WHEN 19 THEN '{{"group_id":[' || {_K} || ']}}'
    WHEN 20 THEN '"' || {_K} || '"'
    WHEN 21 THEN '{{"custom_track":"conversion","job_id":' || {_U} || ',"more":{{"a":[1,2]}}}}'
    WHEN 22 THEN ' {{"custom_track":"qualified" , "group_id":"' || {_K} || '"}} '
    ELSE '{{"custom_track":"click","bid":' || {_K} || ',"job_id":' || {_U}
         || ',"publisher_id":3,"campaign_id":27,"group_id":' || {_K} || '}}'
    END"""

# The given tables' columns that are read.
GIVEN = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, props string",
    "customer": "c_custkey bigint, c_nationkey int",
    "supplier": "s_suppkey bigint, s_name string",
}


def _given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(GIVEN[table]).parquet(f"{sf_dir}/{table}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    apply_settings(spark)
    k = F.get_json_object("props", "$.k").cast("int")
    return _given(spark, sf_dir, "events").withColumn("k", k)


def _instant(column: str):
    """Event times carry no zone; they are UTC."""
    return F.col(column).cast("timestamp")


def tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log, with ids minted from event time, and when each event reached the log."""
    raw = events(spark, sf_dir)
    return raw.select(
        "event_id",
        mint_time_uuid(_instant("ts"), F.col("event_id")).alias("create_time"),
        *[F.expr(text).alias(name) for name, text in TRACKING_COLUMNS.items()],
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
        F.expr(ARRIVAL).cast("timestamp").alias("arrived_at"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = _given(spark, sf_dir, "customer")
    return customers.select(*[F.expr(text).alias(name) for name, text in JOB_COLUMNS.items()])


def publishers(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = _given(spark, sf_dir, "supplier")
    return suppliers.select(*[F.expr(text).alias(name) for name, text in PUBLISHER_COLUMNS.items()])


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON texts with their arrival and a number that identifies each."""
    return events(spark, sf_dir).select(
        F.expr(PAYLOAD).alias("raw"), _instant("ts").alias("arrived_at"), "event_id"
    )


def spelled_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time-UUIDs in every accepted spelling and in some that are none."""
    raw = events(spark, sf_dir)
    canonical = mint_time_uuid(_instant("ts"), F.col("event_id"))
    variant = F.col("event_id") % 10
    spelled = (
        F.when(variant == 0, F.upper(canonical))
        .when(variant == 1, F.concat(F.lit("{"), canonical, F.lit("}")))
        .when(variant == 2, F.concat(F.lit("urn:uuid:"), canonical))
        .when(variant == 3, F.replace(canonical, F.lit("-")))
        .when(variant == 4, F.concat(F.lit("URN:UUID:"), canonical))
        .when(variant == 5, F.concat(F.lit(" "), canonical))
        .when(variant == 6, F.overlay(canonical, F.lit("4"), F.lit(15)))
        .when(variant == 7, F.overlay(canonical, F.lit("c"), F.lit(20)))
        .otherwise(canonical)
    )
    return raw.select("event_id", spelled.alias("create_time"))
