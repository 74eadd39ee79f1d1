"""Small aids shared by the tests."""

import datetime as dt
import uuid

EPOCH = dt.datetime(1582, 10, 15)


def time_uuid(at: dt.datetime, node: int = 0) -> str:
    """A version-1 UUID of a naive UTC time, put together by the standard library."""
    ticks = (at - EPOCH) // dt.timedelta(microseconds=1) * 10
    fields = (ticks & 0xFFFFFFFF, ticks >> 32 & 0xFFFF, ticks >> 48 | 0x1000, 0x80, 0, node)
    return str(uuid.UUID(fields=fields))


def at(day: int, hour: int, minute: int = 0, second: int = 0) -> dt.datetime:
    return dt.datetime(2024, 3, day, hour, minute, second)


def event(when: dt.datetime, kind: str = "click", job: int | None = 1, **more) -> dict:
    made = {"create_time": time_uuid(when, more.pop("node", 0)), "custom_track": kind, "job_id": job}
    return {"publisher_id": 1, "campaign_id": 1, "group_id": 1} | made | more


def rows(df) -> list[tuple]:
    """A DataFrame's rows with columns by name, in an order of their own."""
    names = sorted(df.columns)
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)
