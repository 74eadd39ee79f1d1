"""Table schemas and the names every module shares."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "tinyint": T.ByteType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "money": T.DecimalType(10, 2),
    "wide_money": T.DecimalType(21, 2),
}


def struct(spec: str) -> T.StructType:
    """``"a int, b string"`` -> StructType; usable before a session exists."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Column names, types and order of the four tables.
TRACKING = struct(
    "create_time string, bid int, bn string, campaign_id int, cd int, custom_track string, "
    "de string, dl string, dt string, ed string, ev int, group_id int, id string, job_id int, "
    "md string, publisher_id int, rl string, sr string, ts string, tz int, ua string, uid string, "
    "utm_campaign string, utm_content string, utm_medium string, utm_source string, "
    "utm_term string, v int, vp string"
)
JOB = struct(
    "id int, created_by string, created_date timestamp, last_modified_by string, "
    "last_modified_date timestamp, is_active tinyint, title string, description string, "
    "work_schedule string, radius_unit string, location_street string, location_locality string, "
    "role_location string, resume_optional string, budget money, status int, error string, "
    "template_layout int, template_options int, question_template int, redirect_url string, "
    "start_date timestamp, end_date timestamp, close_date timestamp, group_id int, minor_id int, "
    "campaign_id int, company_id int, history_store int, ref_id int"
)
PUBLISHER = struct(
    "id int, created_by string, created_date timestamp, last_modified_by string, "
    "last_modified_date timestamp, is_active tinyint, publisher_name string, "
    "publisher_email string, access_token string, publisher_type int, publisher_group int, "
    "publisher_code int, publisher_currency string, time_zone string, cpc_increment money, "
    "bid_reading_interval int, min_bid money, max_bid money, countries string, data_sharing string"
)
# Counts are bigint and spend is wider than decimal(10,2), so that neither can overflow however
# many events fall into one hour.
HOURLY_KPI = struct(
    "id bigint, job_id int, dates date, hours int, disqualified_application bigint, "
    "qualified_application bigint, conversion bigint, company_id int, group_id int, "
    "campaign_id int, publisher_id int, bid_set wide_money, clicks bigint, impression int, "
    "spend_hour wide_money, sources string, updated_at timestamp"
)

# The columns of an event the KPI job reads.
EVENT_COLUMNS = [
    "create_time", "job_id", "custom_track", "bid", "campaign_id", "group_id", "publisher_id",
]

# The grain of an hourly KPI row.
GRAIN = ["job_id", "date", "hour", "publisher_id", "campaign_id", "group_id"]

# The grain's id columns, which are 0 where an event leaves them out.
IDS = ["job_id", "publisher_id", "campaign_id", "group_id"]

# Event kind -> name of its count.
KINDS = {
    "click": "clicks",
    "conversion": "conversions",
    "qualified": "qualified",
    "unqualified": "unqualified",
}
COUNTS = list(KINDS.values())

# Fixed value: where reading starts when the sink holds nothing yet.
FIRST_WATERMARK = "1998-01-01 23:59:59"
# Fixed value: lineage text of rows derived from the event log.
DEFAULT_SOURCE = "Cassandra"

# Partials of the newest second of a run, under the sink's names, with the run's mark.
TAILS = struct(
    "job_id int, dates date, hours int, publisher_id int, campaign_id int, group_id int, "
    "clicks bigint, conversion bigint, qualified_application bigint, "
    "disqualified_application bigint, spend_hour wide_money, updated_at timestamp"
)

# Additive hourly partials of a log with whole bids.
PARTIALS = struct(
    "job_id int, date date, hour int, publisher_id int, campaign_id int, group_id int, "
    "clicks bigint, conversions bigint, qualified bigint, unqualified bigint, bid_sum bigint, "
    "max_ts timestamp"
)
