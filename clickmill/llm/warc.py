"""Not-modified revisits resolved against earlier responses.

A revisit record says only that a page had not changed. It is joined as of its time to the latest
earlier full response of the same canonical URL; the validators of both are compared, and the
headers that a not-modified answer may renew are merged into the response's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Header fields a not-modified answer may renew, and query names that only track.
RENEWABLE = ("cache-control", "content-location", "date", "etag", "expires", "vary")
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"
URL_PARTS = r"^([A-Za-z][A-Za-z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?"

HEADERS = "array<struct<name: string, value: string>>"
CHUNK_ROWS = 200_000
MOST_CHUNKS = 256


def canonical(url: Column) -> Column:
    """Scheme and host in lower case, without credentials, default port, fragment and tracking
    parameters, and with the other parameters sorted; what is not such a URL stays as it is."""
    def part(number):
        return F.regexp_extract(url, URL_PARTS, number)

    scheme, host, port = F.lower(part(1)), F.lower(part(2)), part(3)
    usual = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    path = F.when(part(4) == "", F.lit("/")).otherwise(part(4))
    pairs = F.array_sort(F.filter(F.split(part(5), "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    query = F.when(F.size(pairs) > 0, F.concat(F.lit("?"), F.array_join(pairs, "&"))).otherwise(F.lit(""))
    whole = F.concat(scheme, F.lit("://"), host, F.when(usual, F.lit("")).otherwise(F.concat(F.lit(":"), port)), path, query)
    return F.when(part(1) != "", whole).otherwise(url)


def _chunk(records: DataFrame) -> Column:
    """Number of the stretch of time a record lies in; stretches hold about equally many records.

    They divide the records of a URL that holds a third of all.
    """
    rows, low, high = records.agg(F.count("captured"), F.min("captured"), F.max("captured")).first()
    chunks = min(MOST_CHUNKS, rows // CHUNK_ROWS + 1)
    if chunks < 2 or low == high:
        return F.lit(0)
    shares = [i / chunks for i in range(1, chunks)]
    edges = sorted(set(records.agg(F.percentile_approx("captured", shares, 10_000)).first()[0]))
    return F.size(F.filter(F.array(*map(F.lit, edges)), lambda edge: edge < F.col("captured")))


def latest_earlier(records: DataFrame) -> DataFrame:
    """Each revisit with ``response``, a struct of the latest earlier response or null.

    ``records`` has ``record_id, kind, page, captured`` and what a response hands on. A response at
    the same moment is not earlier; of several at one moment the one with the largest id counts.
    """
    handed = F.struct("captured", "record_id", "etag", "last_modified", "headers", "payload_digest", "payload_length")
    placed = records.withColumn("chunk", _chunk(records)).withColumn(
        "full", F.when(F.col("kind") == "response", handed))
    # The last response of each stretch, and from that the last one before it.
    lasts = placed.groupBy("page", "chunk").agg(F.max_by("full", F.when(
        F.col("full").isNotNull(), F.struct("captured", "record_id"))).alias("last"))
    before = Window.partitionBy("page").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = lasts.select("page", "chunk", F.last("last", ignorenulls=True).over(before).alias("carried"))
    # Revisits come before responses of the same moment.
    order = Window.partitionBy("page", "chunk").orderBy(
        "captured", F.col("full").isNotNull(), "record_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = placed.withColumn("own", F.last("full", ignorenulls=True).over(order)).where("kind = 'revisit'").drop("full")
    return seen.join(carried, ["page", "chunk"], "left").withColumn("response", F.coalesce("own", "carried")).drop(
        "own", "carried", "chunk")


def merged_headers(response: Column, revisit: Column) -> Column:
    """The response's fields, with those renewed that the revisit gives and may renew."""
    nothing = F.array().cast(HEADERS)
    ours, theirs = F.coalesce(response, nothing), F.coalesce(revisit, nothing)
    renewed = F.filter(theirs, lambda h: F.lower(h["name"]).isin(*RENEWABLE))
    names = F.transform(renewed, lambda h: F.lower(h["name"]))
    left = F.filter(ours, lambda h: ~F.coalesce(F.array_contains(names, F.lower(h["name"])), F.lit(False)))
    return F.concat(left, renewed)


def resolve(records: DataFrame) -> DataFrame:
    """One row for each revisit of ``records``: ``record_id, page, captured, verdict, response_id,
    payload_digest, payload_length, headers``.

    ``records`` has ``record_id, kind`` (response or revisit), ``url, captured`` (seconds), ``status,
    etag, last_modified, headers, payload_digest, payload_length``. Only responses with status 200,
    a URL and a time are full ones. The verdict is ``resolved`` if the entity tags are equal, weak or
    not, or, where the revisit has none, the dates of last change; ``changed`` if they differ or the
    response lacks them; ``unverified`` if the revisit has neither; ``orphan`` without an earlier
    response or without a URL or time. Payload and merged headers are given for resolved ones only.
    Other kinds are left out; repeated rows are resolved each on its own; other columns are not read.
    """
    names = ("record_id", "kind", "captured", "etag", "last_modified", "headers", "payload_digest", "payload_length")
    usable = records.where(
        "kind = 'revisit' OR (kind = 'response' AND status = 200 AND url IS NOT NULL AND captured IS NOT NULL)")
    placed = usable.select(*names, canonical(F.col("url")).alias("page"))
    known = F.col("page").isNotNull() & F.col("captured").isNotNull()
    found = latest_earlier(placed.where(known))
    # Revisits without a place are set apart, as they would all meet in one window.
    lost = placed.where(~known & (F.col("kind") == "revisit"))
    found = found.unionByName(lost.withColumn("response", F.lit(None).cast(found.schema["response"].dataType)))
    at = F.col("response")

    def bare(tag):
        return F.regexp_replace(tag, "^W/", "")

    has_tag, has_date = F.col("etag").isNotNull(), F.col("last_modified").isNotNull()
    same = F.when(has_tag, F.coalesce(bare(F.col("etag")) == bare(at["etag"]), F.lit(False))).otherwise(
        F.coalesce(F.col("last_modified") == at["last_modified"], F.lit(False)))
    verdict = (
        F.when(at.isNull(), "orphan").when(~has_tag & ~has_date, "unverified").when(same, "resolved").otherwise("changed"))
    judged = found.withColumn("verdict", verdict)
    resolved = F.col("verdict") == "resolved"
    return judged.select(
        "record_id", "page", "captured", "verdict", at["record_id"].alias("response_id"),
        F.when(resolved, at["payload_digest"]).alias("payload_digest"),
        F.when(resolved, at["payload_length"]).alias("payload_length"),
        F.when(resolved, merged_headers(at["headers"], F.col("headers"))).alias("headers"))


def crawl_records(pages: DataFrame) -> DataFrame:
    """A crawl's records made from ``pages`` (``page_id, url, html``).

    Every page is one full response. It is asked for again a day later, under its URL as another
    crawler would write it, and, every fourth page, before it was first had. Some answers carry
    another tag, some a weak tag, some only a date, some nothing.
    """
    name = F.col("page_id").cast("string")
    tag = F.concat(F.lit('"'), F.substring(F.md5(F.coalesce("html", F.lit("")).cast("binary")), 1, 12), F.lit('"'))
    had = F.lit(1_700_000_000).cast("bigint") + F.col("page_id") * 60
    date = F.concat(F.lit("day "), F.floor(F.col("page_id") / 24).cast("string"))

    def fields(*pairs):
        return F.array(*(F.struct(F.lit(n).alias("name"), v.alias("value")) for n, v in pairs)).cast(HEADERS)

    def record(kind, prefix, url, captured, status, etag, changed, headers, digest, length):
        return F.struct(
            F.concat(F.lit(prefix), name).alias("record_id"), F.lit(kind).alias("kind"), url.alias("url"),
            captured.cast("bigint").alias("captured"), F.lit(status).alias("status"), etag.alias("etag"),
            changed.alias("last_modified"), headers.alias("headers"), digest.alias("payload_digest"),
            length.cast("bigint").alias("payload_length"))

    def absent(kind):
        return F.lit(None).cast(kind)
    tagged = F.when(F.col("page_id") % 5 != 0, tag)
    length = F.octet_length(F.coalesce("html", F.lit("")))
    response = record(
        "response", "r", F.col("url"), had, 200, tagged, date,
        fields(("Content-Type", F.lit("text/html")), ("Content-Length", length.cast("string")),
               ("Date", had.cast("string")), ("Cache-Control", F.lit("max-age=60"))),
        F.sha1(F.coalesce("html", F.lit("")).cast("binary")), length)
    later = had + 86_400
    asked = F.concat(F.regexp_replace(F.col("url"), "#.*$", ""), F.lit("#seen"))
    new_tag = (
        F.when(F.col("page_id") % 7 == 0, F.lit('"other"')).when(F.col("page_id") % 3 == 0, F.concat(F.lit("W/"), tagged))
        .otherwise(tagged))
    renewed = fields(("date", later.cast("string")), ("cache-control", F.lit("max-age=3600")), ("content-length", F.lit("0")))
    again = record("revisit", "v", asked, later, 304, new_tag, F.when(F.col("page_id") % 10 != 0, date), renewed,
                   absent("string"), absent("bigint"))
    early = record("revisit", "e", F.col("url"), had - 1, 304, tagged, date, renewed, absent("string"), absent("bigint"))
    records = F.filter(
        F.array(response, again, F.when(F.col("page_id") % 4 == 0, early)), lambda r: r.isNotNull())
    return pages.select(F.explode(records).alias("r")).select("r.*")
