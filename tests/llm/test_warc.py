import random

from pyspark.sql import functions as F

from clickmill.llm import warc

SCHEMA = ("record_id string, kind string, url string, captured long, status int, etag string, last_modified string, "
          "headers array<struct<name:string,value:string>>, payload_digest string, payload_length long, page string")


def record(name, kind, url, captured, status=200, etag=None, changed=None, headers=None, digest=None):
    return (name, kind, url, captured, status, etag, changed, headers, digest, None if digest is None else len(digest), "x")


def resolved(spark, *records):
    found = warc.resolve(spark.createDataFrame(list(records), SCHEMA))
    return {r["record_id"]: r for r in found.collect()}


def test_canonical_urls(spark):
    cases = {
        "HTTP://User:pw@Example.COM:80/A?b=2&a=1&utm_source=x&ref=y#top": "http://example.com/A?a=1&b=2",
        "https://example.com:443": "https://example.com/", "https://example.com:8080/?": "https://example.com:8080/",
        "https://example.com/a/?&&": "https://example.com/a/", "no url": "no url", "": "",
    }
    rows = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r[0]: r[1] for r in rows.select("u", warc.canonical(F.col("u"))).collect()} == cases


def test_verdicts_and_headers(spark):
    old = [("Content-Type", "text/html"), ("Content-Length", "9"), ("DATE", "old"), ("Set-Cookie", "a"), ("Set-Cookie", "b")]
    new = [("Date", "new"), ("Content-Length", "0"), ("ETag", "W/\"1\"")]
    url = "http://a.example/x"
    found = resolved(
        spark,
        record("r0", "response", url, 5, etag='"0"', digest="first"),
        record("r1", "response", url, 10, etag='"1"', changed="d1", headers=old, digest="payload"),
        record("r2", "response", url, 30, 404, etag='"1"', digest="gone"),
        record("same", "revisit", "HTTP://A.example:80/x#f", 40, 304, 'W/"1"', None, new),
        record("date", "revisit", url, 41, 304, None, "d1"),
        record("other", "revisit", url, 42, 304, '"2"', "d1"),
        record("bare", "revisit", url, 43, 304),
        record("atonce", "revisit", url, 10, 304, '"0"'),
        record("early", "revisit", url, 5, 304, '"0"'),
        record("far", "revisit", "http://b.example/", 50, 304, '"0"'),
        record("nourl", "revisit", None, 50, 304, '"0"'), record("notime", "revisit", url, None, 304, '"0"'),
        record("odd", "request", url, 44),
    )
    assert {k: (r["verdict"], r["response_id"]) for k, r in found.items()} == {
        "same": ("resolved", "r1"), "date": ("resolved", "r1"), "other": ("changed", "r1"), "bare": ("unverified", "r1"),
        "atonce": ("resolved", "r0"), "early": ("orphan", None), "far": ("orphan", None), "nourl": ("orphan", None),
        "notime": ("orphan", None)}
    assert found["same"]["payload_digest"] == "payload" and found["other"]["payload_digest"] is None
    assert [tuple(h) for h in found["same"]["headers"]] == [
        ("Content-Type", "text/html"), ("Content-Length", "9"), ("Set-Cookie", "a"), ("Set-Cookie", "b"),
        ("Date", "new"), ("ETag", 'W/"1"')]
    assert found["atonce"]["headers"] == []


def test_stretches_of_time_change_nothing(spark, monkeypatch):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        url = "http://hot.example/" if rng.random() < 0.4 else f"http://h.example/{rng.randrange(9)}"
        kind = rng.choice(["response", "revisit"])
        rows.append(record(f"{i}", kind, url, rng.randrange(150), 200, f'"{rng.randrange(2)}"', digest="d"))
    rows += rows[:20]
    whole = sorted(map(tuple, warc.resolve(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr)
    expected = []
    for r in rows:
        if r[1] == "revisit":
            before = [s for s in rows if s[1] == "response" and s[2] == r[2] and s[3] < r[3]]
            expected.append((r[0], max(before, key=lambda s: (s[3], s[0]))[0] if before else None))
    assert sorted((x[0], x[4]) for x in whole) == sorted(expected) or sorted(
        ((x[0], x[4]) for x in whole), key=repr) == sorted(expected, key=repr)
    monkeypatch.setattr(warc, "CHUNK_ROWS", 20)
    assert sorted(map(tuple, warc.resolve(spark.createDataFrame(rows, SCHEMA)).collect()), key=repr) == whole


def test_no_records(spark):
    assert resolved(spark) == {}
