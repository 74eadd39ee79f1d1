"""From JSON payloads to events, with the refused ones kept and explained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickmill.functions.payload import members, parse_sealed, to_int, to_kind, type_of, unseal
from clickmill.functions.time_uuid import mint_time_uuid, utc_text

# Integer members of a payload, in the order they are checked. Those absent are 0,
# but for the group, which may be absent or null.
_INTS = ["bid", "campaign_id", "group_id", "job_id", "publisher_id"]
_OPTIONAL = "group_id"
_MEMBERS = [*_INTS, "custom_track"]
ACCEPTED = [
    "create_time", "bid", "campaign_id", "custom_track", "group_id", "job_id", "publisher_id", "ts",
]


def _type(name: str) -> Column:
    return F.col(f"{name}_type")


def _refused(name: str) -> Column:
    """Whether an integer member is there without being a number it may be."""
    there = _type(name).isNotNull()
    if name == _OPTIONAL:
        there = there & (_type(name) != "VOID")
    return there & F.col(name).isNull()


def _reason() -> Column:
    body_type = _type("body")
    reason = F.when(body_type.isNull(), F.lit("not JSON"))
    reason = reason.when(body_type != "OBJECT", F.lit("not an object"))
    for name in _INTS:
        reason = reason.when(_refused(name), F.lit(f"{name}: not a 32-bit number"))
    return reason.when(F.col("custom_track").isNull(), F.lit("custom_track: not a scalar"))


def classify(payloads: DataFrame, raw: Column, arrived_at: Column, identity: Column) -> DataFrame:
    """Every payload once: as an event with ``reason`` NULL, or with the reason it is refused.

    ``raw`` is the payload text, ``arrived_at`` its arrival (timestamp) and ``identity`` a bigint
    unique among payloads arriving in the same microsecond, such as a source offset: the event id
    is made from both, so processing a payload again gives the same id.

    One narrow stage after the other, each expression evaluated once per row: the JSON, its
    members, their types, their values, the verdict. Do not filter on the verdict, as Catalyst
    would move the filter below all of them and repeat the work; land the rows by it instead.
    """
    given = ["raw", "arrived_at", "identity"]
    parsed = payloads.select(
        raw.alias("raw"), arrived_at.alias("arrived_at"), identity.alias("identity"),
        parse_sealed(raw).alias("sealed"),
    ).select(*given, unseal(F.col("sealed"), F.col("raw")).alias("body"))
    opened = parsed.select(
        *given, type_of(F.col("body")).alias("body_type"),
        members(F.col("body"), _MEMBERS).alias("member"),
    )
    typed = opened.withColumns(
        {f"{m}_type": type_of(F.col(f"member.{m}")) for m in _MEMBERS}
    )
    read = {
        n: to_int(F.col(f"member.{n}"), _type(n), text_may_have_fraction=n == "bid") for n in _INTS
    }
    absent = {n: F.lit(0) for n in _INTS if n != _OPTIONAL}
    values = typed.withColumns({
        n: F.when(_type(n).isNull(), absent[n]).otherwise(read[n]) if n in absent else read[n]
        for n in _INTS
    } | {"custom_track": to_kind(F.col("member.custom_track"), _type("custom_track"))})
    return values.select(
        "raw", "arrived_at", *[c for c in ACCEPTED if c not in ("create_time", "ts")],
        _reason().alias("reason"),
        mint_time_uuid(F.col("arrived_at"), F.col("identity")).alias("create_time"),
        utc_text(F.col("arrived_at")).alias("ts"),
    )
