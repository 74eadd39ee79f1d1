"""Event time in version-1 UUIDs, as native column expressions."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ids count ticks of 100 ns from 1582-10-15, which is this long before 1970.
TICKS_PER_SECOND = 10_000_000
GREGORIAN_DAY = "1582-10-15"
GREGORIAN_SECONDS = 12_219_292_800
# Fixed value: version 1 and the standard variant in the usual spelling.
_CANONICAL = (
    "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-1[0-9a-fA-F]{3}-[89abAB][0-9a-fA-F]{3}-[0-9a-fA-F]{12}\\z"
)
# The same as bare digits with the three time fields as groups, or else any text without groups.
_TIME_FIELDS = "(?s)^([0-9a-f]{8})([0-9a-f]{4})1([0-9a-f]{3})[89ab][0-9a-f]{15}\\z|^.*\\z"


def time_uuid_ticks(text: Column) -> Column:
    """The 60-bit tick count of a version-1 UUID, NULL for any other text.

    Prefixes ``urn:`` and ``uuid:`` (lower case only), outer braces, hyphens and upper-case
    digits are all accepted spellings. The usual one, cut at fixed places, costs a third of the
    others.
    """
    cut = F.concat(F.substring(text, 16, 3), F.substring(text, 10, 4), F.substring(text, 1, 8))
    bare = F.replace(F.replace(text, F.lit("urn:")), F.lit("uuid:"))
    digits = F.lower(F.replace(F.btrim(bare, F.lit("{}")), F.lit("-")))
    # High, middle and low part in a row; empty, and so NULL as a number, if there are none.
    found = F.regexp_replace(digits, _TIME_FIELDS, "$3$2$1")
    return F.conv(F.when(text.rlike(_CANONICAL), cut).otherwise(found), 16, 10).cast("bigint")


def decode_time_uuid(text: Column) -> Column:
    """Event time of a version-1 UUID, floored to the second with exact integers."""
    seconds = F.call_function("div", time_uuid_ticks(text), F.lit(TICKS_PER_SECOND))
    return F.timestamp_seconds(seconds - F.lit(GREGORIAN_SECONDS))


def gregorian_hours(ts: Column) -> Column:
    """Whole hours since 1582-10-15 in UTC; never negative for a time decoded from an id."""
    return F.call_function("div", F.unix_seconds(ts) + F.lit(GREGORIAN_SECONDS), F.lit(3600))


def date_of(hours: Column) -> Column:
    day = F.call_function("div", hours, F.lit(24)).cast("int")
    return F.date_add(F.lit(GREGORIAN_DAY).cast("date"), day)


def hour_of(hours: Column) -> Column:
    return (hours % F.lit(24)).cast("int")


def utc_date(ts: Column) -> Column:
    return date_of(gregorian_hours(ts))


def utc_hour(ts: Column) -> Column:
    return hour_of(gregorian_hours(ts))


def utc_text(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session's time zone."""
    seconds = F.unix_seconds(ts)
    minute = F.call_function("div", F.pmod(seconds, F.lit(3600)), F.lit(60))
    text = F.format_string(
        "%s %02d:%02d:%02d", utc_date(ts).cast("string"), utc_hour(ts), minute, F.pmod(seconds, F.lit(60)))
    return F.when(ts.isNotNull(), text)


def utc_instant(value: int | str | dt.datetime | Column) -> Column:
    """A moment as a timestamp: microseconds since 1970, a text or a time; UTC if it says no zone."""
    if isinstance(value, Column):
        return value.cast("timestamp")
    if isinstance(value, str):
        zoned = re.search(r"(Z|[+-]\d\d:?\d\d)$", value.strip())
        return F.lit(value if zoned else value + "Z").cast("timestamp")
    if isinstance(value, dt.datetime):
        aware = value if value.tzinfo else value.replace(tzinfo=dt.timezone.utc)
        value = (aware - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(value).cast("bigint"))


def mint_time_uuid(at: Column, identity: Column) -> Column:
    """A version-1 UUID for the instant ``at`` (timestamp) and the bigint ``identity``.

    The low 62 bits of ``identity`` fill the node (48) and clock sequence (14), so a retry mints
    the same id again, and rows with different identities never share one.
    """
    micros = F.unix_micros(at) + F.lit(GREGORIAN_SECONDS * 1_000_000)
    ticks = F.lpad(F.lower(F.hex(micros * F.lit(10))), 15, "0")
    fields = F.regexp_replace(ticks, "^(.{3})(.{4})(.{8})$", "$3-$2-1$1-")
    sequence = F.shiftright(identity, 48).bitwiseAND(F.lit(0x3FFF)).bitwiseOR(F.lit(0x8000))
    node = F.lpad(F.lower(F.hex(identity.bitwiseAND(F.lit(0xFFFF_FFFF_FFFF)))), 12, "0")
    return F.concat(fields, F.lower(F.hex(sequence)), F.lit("-"), node)
