import datetime as dt
import random
import uuid

from pyspark.sql import functions as F

from clickmill.functions.time_uuid import (
    date_of, decode_time_uuid, gregorian_hours, hour_of, mint_time_uuid, time_uuid_ticks,
)
from tests.helpers import EPOCH

ID = "1eec8b70-f1c2-11ed-8f3e-00155d012401"


def _decoded(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    decoded = df.select("i", decode_time_uuid(F.col("text")).cast("timestamp_ntz").alias("ts"))
    return [r.ts for r in sorted(decoded.collect(), key=lambda r: r.i)]


def _expected(text):
    return (EPOCH + dt.timedelta(seconds=uuid.UUID(text).time // 10_000_000))


def test_random_ids_of_every_age_equal_the_standard_library(spark):
    rng = random.Random(7)
    texts = []
    for _ in range(3000):
        raw = rng.getrandbits(128)
        texts.append(str(uuid.UUID(int=raw & ~(0xF << 76) & ~(0x3 << 62) | 1 << 76 | 1 << 63)))
    assert _decoded(spark, texts) == [_expected(t) for t in texts]


def test_all_spellings_of_one_id(spark):
    spellings = [
        ID, ID.upper(), "{" + ID + "}", "urn:uuid:" + ID, "uuid:" + ID, ID.replace("-", ""),
        "{{" + ID, "urn:" + ID.replace("-", "").upper(), ID[:20] + "-" + ID[20:],
        ID[:8] + ID[9:13] + "--" + ID[14:],
    ]
    for text in spellings:
        uuid.UUID(text)
    assert set(_decoded(spark, spellings)) == {_expected(ID)}


def test_what_is_no_version_1_id(spark):
    texts = [
        None, "", "abc", " " + ID, ID + "\n", ID + "0", "URN:UUID:" + ID,
        ID[:14] + "4" + ID[15:], ID[:14] + "6" + ID[15:], ID[:14] + "7" + ID[15:],
        ID[:19] + "7" + ID[20:], ID[:19] + "c" + ID[20:], ID.replace("b", "g"),
        "0" * 15, "1ed11c2f1eec8b7",
    ]
    assert _decoded(spark, texts) == [None] * len(texts)


def test_the_last_tick_of_a_second_stays_in_it(spark):
    edge = "0548567f-833b-11ee-8000-000000000000"
    assert _decoded(spark, [edge]) == [dt.datetime(2023, 11, 14, 22, 13, 20)]


def test_before_1970_is_floored(spark):
    text = str(uuid.UUID(fields=(0, 0, 0x1001, 0x80, 0, 0)))
    assert _decoded(spark, [text]) == [_expected(text)]


def test_minted_ids_decode_to_their_instant(spark):
    base = 1_704_067_200_123_456
    df = spark.range(2000).select(
        "id", (F.lit(base) + F.col("id") * 987_654_321).alias("micros"),
        (F.xxhash64("id")).alias("identity"),
    )
    minted = df.withColumn("text", mint_time_uuid(F.timestamp_micros("micros"), F.col("identity")))
    checked = minted.select("*", time_uuid_ticks(F.col("text")).alias("ticks")).collect()
    assert len({r.text for r in checked}) == 2000
    for r in checked:
        parsed = uuid.UUID(r.text)
        assert str(parsed) == r.text and parsed.version == 1
        assert parsed.time == r.ticks == r.micros * 10 + 0x01B21DD213814000
        assert (parsed.clock_seq << 48 | parsed.node) == r.identity & (1 << 62) - 1


def test_hours_split_into_utc_dates_whatever_the_session_zone(spark):
    df = spark.createDataFrame([("1969-12-31 23:59:59",), ("2024-02-29 05:00:00",)], "text string")
    moments = df.select(F.concat("text", F.lit("Z")).cast("timestamp").alias("ts"))
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        hours = gregorian_hours(F.col("ts"))
        found = moments.select(date_of(hours).alias("d"), hour_of(hours).alias("h")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert sorted((str(r.d), r.h) for r in found) == [("1969-12-31", 23), ("2024-02-29", 5)]
