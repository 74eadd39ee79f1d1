"""The registered queries as plain SQL for an independent engine.

Written from the definitions of the results, not from the plans: four branches joined in full,
runs and watermarks spelled out. Only the texts that derive the input tables are shared.
"""

from __future__ import annotations

from clickmill.sources import sample

KEYS = ["job_id", "date", "hour", "publisher_id", "campaign_id", "group_id"]
KEY_LIST = ", ".join(KEYS)
KINDS = {"conversion": "conversions", "qualified": "qualified", "unqualified": "unqualified"}
EVENT = "create_time, job_id, custom_track, bid, campaign_id, group_id, publisher_id, ts"


def _columns(texts: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in texts.items())


# Ticks since 1582 in hex, cut into the three time fields; the node is the event's number.
_TICKS = "lpad(lower(to_hex(epoch_us(ts) * 10 + 122192928000000000)), 15, '0')"
_UUID = (
    f"substr({_TICKS}, 8, 8) || '-' || substr({_TICKS}, 4, 4) || '-1' || substr({_TICKS}, 1, 3)"
    " || '-8000-' || lpad(lower(to_hex(event_id)), 12, '0')"
)

EVENTS = f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
log AS (
    SELECT event_id, {_UUID} AS create_time, {_columns(sample.TRACKING_COLUMNS)},
           date_trunc('second', ts) AS ts, {sample.ARRIVAL} AS arrived_at
    FROM ev
),
tracking AS (SELECT * FROM log WHERE job_id IS NOT NULL)"""

TABLES = f"""
job AS (SELECT {_columns(sample.JOB_COLUMNS)} FROM customer),
publisher AS (SELECT {_columns(sample.PUBLISHER_COLUMNS)} FROM supplier)"""


def _filled(source: str, name: str) -> str:
    """Events with ids filled and their date and hour."""
    return f"""
{name}_filled AS (
    SELECT job_id, CAST(ts AS DATE) AS date, CAST(hour(ts) AS INT) AS hour,
           coalesce(publisher_id, 0) AS publisher_id, coalesce(campaign_id, 0) AS campaign_id,
           coalesce(group_id, 0) AS group_id, custom_track, coalesce(bid, 0) AS bid
    FROM {source}
)"""


def _clicks(name: str) -> str:
    return f"""SELECT {KEY_LIST}, round(avg(bid), 2) AS bid_set, count(*) AS clicks,
           CAST(sum(bid) AS BIGINT) AS spend_hour
    FROM {name}_filled WHERE custom_track = 'click' GROUP BY ALL"""


def _count(name: str, kind: str, alias: str) -> str:
    return f"""SELECT {KEY_LIST}, count(*) AS {alias}
    FROM {name}_filled WHERE custom_track = '{kind}' GROUP BY ALL"""


def _kpis(source: str, name: str = "kpis") -> str:
    """CTEs ending in ``name``: the four branches of ``source`` joined in full."""
    joins = " ".join(
        f"FULL JOIN ({_count(name, kind, alias)}) {alias}_rows USING ({KEY_LIST})"
        for kind, alias in KINDS.items()
    )
    return f"""{_filled(source, name)},
{name} AS (
    SELECT {KEY_LIST}, bid_set, clicks, spend_hour, conversions, qualified, unqualified
    FROM ({_clicks(name)}) clicks_rows {joins}
)"""


def _sink(kpis: str, mark: str) -> str:
    return f"""SELECT f.job_id, f.date AS dates, f.hour AS hours, f.publisher_id, j.company_id,
       f.campaign_id, f.group_id, f.unqualified AS disqualified_application,
       f.qualified AS qualified_application, f.conversions AS conversion, f.clicks, f.bid_set,
       f.spend_hour, {mark} AS updated_at, CAST(0 AS INT) AS impression, 'Cassandra' AS sources
FROM {kpis} f LEFT JOIN job j ON j.id = f.job_id"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


CUT = f"TIMESTAMP '{sample.CUT}'"
EARLY = f"""
early AS (SELECT * FROM tracking WHERE arrived_at < {CUT})"""
MARK = """
mark AS (SELECT max(ts) AS high_mark FROM early)"""

KPIS = _with(EVENTS, _kpis("tracking")) + f"""SELECT {KEY_LIST}, bid_set, clicks, spend_hour,
       conversions, qualified, unqualified FROM kpis"""

SPELLED = """
ids AS (SELECT event_id, create_time, ts FROM log),
spelled AS (
    SELECT event_id, ts, CASE event_id % 10
        WHEN 0 THEN upper(create_time)
        WHEN 1 THEN '{' || create_time || '}'
        WHEN 2 THEN 'urn:uuid:' || create_time
        WHEN 3 THEN replace(create_time, '-', '')
        WHEN 4 THEN 'URN:UUID:' || create_time
        WHEN 5 THEN ' ' || create_time
        WHEN 6 THEN substr(create_time, 1, 14) || '4' || substr(create_time, 16)
        WHEN 7 THEN substr(create_time, 1, 19) || 'c' || substr(create_time, 21)
        ELSE create_time END AS create_time
    FROM ids
)"""

# --- payloads ----------------------------------------------------------------------------------

_INTS = ["bid", "campaign_id", "group_id", "job_id", "publisher_id"]


def _json_int(name: str) -> str:
    spelled = r"\s*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?\s*" if name == "bid" \
        else r"\s*[+-]?[0-9]+\s*"
    text, kind = f"json_extract_string(body, '$.{name}')", f"json_type(body, '$.{name}')"
    number = f"trunc(TRY_CAST(trim({text}) AS DOUBLE))"
    return f"""CASE WHEN {kind} = 'BOOLEAN' THEN CASE {text} WHEN 'true' THEN 1.0 ELSE 0.0 END
         WHEN {kind} IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN {number}
         WHEN {kind} = 'VARCHAR' AND regexp_full_match({text}, '{spelled}') THEN {number} END"""


def _payload_ctes() -> str:
    numbers = ",\n".join(f"{_json_int(n)} AS {n}_number, json_type(body, '$.{n}') AS {n}_type" for n in _INTS)

    def refused(name: str) -> str:
        allowed = f"{name}_type IS NULL"
        if name == "group_id":
            allowed += f" OR {name}_type = 'NULL'"
        fits = f"{name}_number BETWEEN -2147483648 AND 2147483647"
        return f"WHEN NOT ({allowed}) AND NOT coalesce({fits}, FALSE) THEN '{name}: not a 32-bit number'"

    return f"""
ev AS (SELECT *, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events),
payloads AS (SELECT event_id, ts, {sample.PAYLOAD} AS raw FROM ev),
bodies AS (SELECT *, CASE WHEN json_valid(raw) THEN raw END AS body FROM payloads),
numbers AS (
    SELECT *, {numbers},
           json_type(body, '$.custom_track') AS kind_type,
           json_extract_string(body, '$.custom_track') AS kind_text
    FROM bodies
),
judged AS (
    SELECT *, CASE WHEN body IS NULL THEN 'not JSON'
                   WHEN json_type(body) <> 'OBJECT' THEN 'not an object'
                   {" ".join(refused(n) for n in _INTS)}
                   WHEN kind_type IN ('OBJECT', 'ARRAY') THEN 'custom_track: not a scalar'
              END AS reason
    FROM numbers
),
accepted AS (
    SELECT {_UUID} AS create_time,
           {", ".join(f"CAST({n}_number AS INT) AS {n}" if n == "group_id"
                      else f"CASE WHEN {n}_type IS NULL THEN 0 ELSE CAST({n}_number AS INT) END AS {n}"
                      for n in _INTS)},
           CASE WHEN kind_type IS NULL THEN 'click' WHEN kind_type = 'NULL' THEN 'None'
                ELSE kind_text END AS custom_track,
           strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, ts AS exact_ts
    FROM judged WHERE reason IS NULL
)"""


ACCEPTED = _with(_payload_ctes()) + """SELECT create_time, bid, campaign_id, custom_track, group_id,
       job_id, publisher_id, ts FROM accepted"""
REJECTED = _with(_payload_ctes()) + "SELECT raw, reason FROM judged WHERE reason IS NOT NULL"


def _contract() -> str:
    """(table, column, declared type, found type)."""
    checks = [
        ("log", "tracking", "create_time", "string", "string"),
        ("log", "tracking", "job_id", "int", "int"),
        ("log", "tracking", "custom_track", "string", "string"),
        ("log", "tracking", "bid", "int", "int"),
        ("log", "tracking", "campaign_id", "int", "int"),
        ("log", "tracking", "group_id", "int", "int"),
        ("log", "tracking", "publisher_id", "int", "int"),
        ("log", "tracking", "ts", "string", "string"),
        ("log", "tracking", "uid", "string", None),
        ("log", "tracking", "event_id", None, "bigint"),
        ("log", "tracking", "arrived_at", None, "timestamp"),
        ("job", "job", "id", "int", "int"),
        ("job", "job", "company_id", "int", "int"),
        ("job", "job", "group_id", "int", "int"),
        ("job", "job", "campaign_id", "int", "int"),
        ("publisher", "publisher", "id", "int", "int"),
        ("publisher", "publisher", "publisher_name", "string", "string"),
    ]

    def text(value: str | None) -> str:
        return f"'{value}'" if value else "CAST(NULL AS VARCHAR)"

    return _with(EVENTS, TABLES) + " UNION ALL ".join(
        f'SELECT \'{name}\' AS "table", \'{column}\' AS "column", {text(declared)} AS expected, '
        f"{text(found)} AS actual, {str(declared == found).upper()} AS ok, count(*) AS rows, "
        + (f"count(*) FILTER ({column} IS NULL)" if found else "CAST(NULL AS BIGINT)")
        + f" AS nulls FROM {source}"
        for source, name, column, declared, found in checks
    )


INCREMENTAL = _with(
    EVENTS, TABLES, EARLY, MARK,
    "\nfresh AS (SELECT * FROM tracking WHERE ts >= (SELECT high_mark FROM mark))",
    _kpis("early", "first_run"), _kpis("fresh", "second_run"),
) + _sink("first_run", "(SELECT high_mark FROM mark)") + "\nUNION ALL\n" + _sink(
    "second_run", "(SELECT max(ts) FROM fresh)")
# Each second once: the first run's events before its mark, and all from the mark on.
COUNTED = _with(
    EVENTS, TABLES, EARLY, MARK, """
counted AS (
    SELECT * FROM early WHERE ts < (SELECT high_mark FROM mark)
    UNION ALL SELECT * FROM tracking WHERE ts >= (SELECT high_mark FROM mark)
)""", _kpis("counted"))


def _merged(kpis: str) -> str:
    return f"""SELECT f.job_id, f.date AS dates, f.hour AS hours, f.publisher_id, j.company_id, f.campaign_id,
       f.group_id, f.unqualified AS disqualified_application, f.qualified AS qualified_application,
       f.conversions AS conversion, f.clicks, f.bid_set, f.spend_hour
FROM {kpis} f LEFT JOIN job j ON j.id = f.job_id"""


ORACLES: dict[str, str] = {
    "tracking_events": _with(EVENTS) + f"SELECT {EVENT} FROM tracking",
    "job_dim": _with(TABLES) + "SELECT id AS job_id, company_id, group_id, campaign_id FROM job",
    "publisher_ids": _with(TABLES) + "SELECT DISTINCT id AS publisher_id FROM publisher",
    "job_group_ids": _with(TABLES) + "SELECT group_id FROM job WHERE group_id IS NOT NULL",
    "filled_events": _with(EVENTS) + """
        SELECT create_time, job_id, custom_track,
               CASE WHEN custom_track = 'click' THEN coalesce(bid, 0) ELSE bid END AS bid,
               coalesce(campaign_id, 0) AS campaign_id, coalesce(group_id, 0) AS group_id,
               coalesce(publisher_id, 0) AS publisher_id, ts
        FROM tracking""",
    "decode_time_uuid": _with(EVENTS, SPELLED) + """
        SELECT event_id, create_time,
               CASE WHEN event_id % 10 IN (4, 5, 6, 7) THEN NULL ELSE ts END AS ts
        FROM spelled""",
    "incremental_slice": _with(EVENTS) + f"SELECT {EVENT} FROM tracking WHERE ts >= {CUT}",
    "clicks_hourly": _with(EVENTS, _filled("tracking", "all")) + _clicks("all"),
    **{
        f"{alias}_hourly": _with(EVENTS, _filled("tracking", "all")) + _count("all", kind, alias)
        for kind, alias in KINDS.items()
    },
    "hourly_kpis": KPIS,
    "hourly_kpis_join": KPIS,
    "company_enriched": _with(EVENTS, TABLES, _kpis("tracking")) + f"""
        SELECT {", ".join("kpis." + k for k in KEYS)}, bid_set, clicks, spend_hour, conversions,
               qualified, unqualified, company_id
        FROM kpis LEFT JOIN job ON job.id = kpis.job_id""",
    "company_salted": _with(EVENTS, TABLES, _kpis("tracking")) + f"""
        SELECT {", ".join("kpis." + k for k in KEYS)}, bid_set, clicks, spend_hour, conversions,
               qualified, unqualified, company_id
        FROM kpis LEFT JOIN job ON job.id = kpis.job_id""",
    "company_bucketed": _with(EVENTS, TABLES, _kpis("tracking")) + f"""
        SELECT {", ".join("kpis." + k for k in KEYS)}, bid_set, clicks, spend_hour, conversions,
               qualified, unqualified, company_id
        FROM kpis LEFT JOIN job ON job.id = kpis.job_id""",
    "log_replayed": KPIS,
    "batch_high_mark": _with(EVENTS) + "SELECT max(ts) AS high_mark FROM tracking",
    "sink_rows": _with(EVENTS, TABLES, _kpis("tracking"))
        + _sink("kpis", "(SELECT max(ts) FROM tracking)"),
    "sink_watermark": _with(EVENTS, EARLY, MARK) + "SELECT high_mark AS watermark FROM mark",
    "sink_watermark_empty": _with(EVENTS) + """
        SELECT coalesce(max(ts), TIMESTAMP '1998-01-01 23:59:59') AS watermark FROM tracking
        WHERE custom_track NOT IN ('click', 'conversion', 'qualified', 'unqualified', 'view')""",
    "late_events": _with(EVENTS, EARLY, MARK) + f"""
        SELECT custom_track, CAST(epoch(high_mark) - epoch(ts) AS BIGINT) // 3600 AS hours_late,
               count(*) AS events
        FROM tracking, mark WHERE arrived_at >= {CUT} AND ts < high_mark GROUP BY ALL""",
    "incremental_run": INCREMENTAL,
    "incremental_retry": INCREMENTAL,
    "empty_batch": _with(EVENTS, TABLES, EARLY, MARK, _kpis("early", "first_run"))
        + "SELECT *, FALSE AS found, TRUE AS mark_kept FROM ("
        + _sink("first_run", "(SELECT high_mark FROM mark)") + ")",
    "sink_merged": COUNTED + _merged("kpis"),
    "sink_by_job_day": COUNTED + """SELECT job_id, date AS dates, CAST(sum(clicks) AS BIGINT) AS clicks,
        CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(qualified) AS BIGINT) AS qualified,
        CAST(sum(unqualified) AS BIGINT) AS unqualified, CAST(sum(spend_hour) AS BIGINT) AS spend
        FROM kpis GROUP BY ALL""",
    "sink_by_publisher": COUNTED + """SELECT publisher_id, CAST(sum(clicks) AS BIGINT) AS clicks,
        CAST(sum(qualified) AS BIGINT) AS qualified, CAST(sum(unqualified) AS BIGINT) AS unqualified,
        CAST(coalesce(sum(qualified), 0) AS DOUBLE)
            / nullif(coalesce(sum(qualified), 0) + coalesce(sum(unqualified), 0), 0) AS quality,
        any_value(publisher_name) AS publisher_name
        FROM kpis LEFT JOIN publisher ON publisher.id = publisher_id GROUP BY publisher_id""",
    "sink_by_campaign": COUNTED + """SELECT campaign_id, CAST(sum(clicks) AS BIGINT) AS clicks,
        CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(spend_hour) AS BIGINT) AS spend,
        CAST(sum(spend_hour) AS DOUBLE) / sum(conversions) AS cost_per_conversion
        FROM kpis GROUP BY campaign_id""",
    "stream_sink_rows": _with(EVENTS, TABLES, _kpis("tracking")) + _merged("kpis"),
    "stream_distinct": KPIS,
    "ingest_mixed": ACCEPTED,
    "fractional_bids": _with(EVENTS, """
priced AS (
    SELECT job_id, CAST(t.ts AS DATE) AS date, CAST(hour(t.ts) AS INT) AS hour,
           coalesce(publisher_id, 0) AS publisher_id, coalesce(campaign_id, 0) AS campaign_id,
           coalesce(group_id, 0) AS group_id, ev.k
    FROM tracking t JOIN ev USING (event_id) WHERE custom_track = 'click'
)""") + f"""SELECT {KEY_LIST}, CAST((50 * sum(k) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS bid_set,
        count(*) AS clicks, CAST(sum(k) AS DOUBLE) / 4 AS spend_hour FROM priced GROUP BY ALL""",
    "kpi_merged": KPIS,
    "kpi_by_job_day": _with(EVENTS) + """
        SELECT job_id, CAST(ts AS DATE) AS dates,
               nullif(count(*) FILTER (custom_track = 'click'), 0) AS clicks,
               nullif(count(*) FILTER (custom_track = 'conversion'), 0) AS conversions,
               nullif(count(*) FILTER (custom_track = 'qualified'), 0) AS qualified,
               nullif(count(*) FILTER (custom_track = 'unqualified'), 0) AS unqualified,
               CAST(sum(coalesce(bid, 0)) FILTER (custom_track = 'click') AS BIGINT) AS spend
        FROM tracking
        WHERE custom_track IN ('click', 'conversion', 'qualified', 'unqualified') GROUP BY ALL""",
    "kpi_by_publisher": _with(EVENTS, TABLES, """
totals AS (
    SELECT coalesce(publisher_id, 0) AS publisher_id,
           nullif(count(*) FILTER (custom_track = 'click'), 0) AS clicks,
           nullif(count(*) FILTER (custom_track = 'qualified'), 0) AS qualified,
           nullif(count(*) FILTER (custom_track = 'unqualified'), 0) AS unqualified
    FROM tracking
    WHERE custom_track IN ('click', 'conversion', 'qualified', 'unqualified') GROUP BY ALL
)""") + """
        SELECT t.publisher_id, clicks, qualified, unqualified,
               CAST(coalesce(qualified, 0) AS DOUBLE)
                   / nullif(coalesce(qualified, 0) + coalesce(unqualified, 0), 0) AS quality,
               publisher_name
        FROM totals t LEFT JOIN publisher p ON p.id = t.publisher_id""",
    "kpi_by_campaign": _with(EVENTS, """
totals AS (
    SELECT coalesce(campaign_id, 0) AS campaign_id,
           nullif(count(*) FILTER (custom_track = 'click'), 0) AS clicks,
           nullif(count(*) FILTER (custom_track = 'conversion'), 0) AS conversions,
           CAST(sum(coalesce(bid, 0)) FILTER (custom_track = 'click') AS BIGINT) AS spend
    FROM tracking
    WHERE custom_track IN ('click', 'conversion', 'qualified', 'unqualified') GROUP BY ALL
)""") + """
        SELECT campaign_id, clicks, conversions, spend,
               CAST(spend AS DOUBLE) / conversions AS cost_per_conversion FROM totals""",
    "stream_hourly_kpis": KPIS,
    "stream_hourly_kpis_stateful": KPIS,
    "kpi_reports": _with(EVENTS, TABLES, _kpis("tracking")) + """
        SELECT 'job_day' AS report, job_id, date AS dates, CAST(NULL AS INT) AS publisher_id,
               CAST(NULL AS INT) AS campaign_id, CAST(sum(clicks) AS BIGINT) AS clicks,
               CAST(sum(conversions) AS BIGINT) AS conversions, CAST(sum(qualified) AS BIGINT) AS qualified,
               CAST(sum(unqualified) AS BIGINT) AS unqualified, CAST(sum(spend_hour) AS BIGINT) AS spend,
               CAST(NULL AS DOUBLE) AS quality, CAST(NULL AS DOUBLE) AS cost_per_conversion,
               CAST(NULL AS VARCHAR) AS publisher_name
        FROM kpis GROUP BY job_id, date
        UNION ALL
        SELECT 'publisher', NULL, NULL, publisher_id, NULL, CAST(sum(clicks) AS BIGINT), NULL,
               CAST(sum(qualified) AS BIGINT), CAST(sum(unqualified) AS BIGINT), NULL,
               CAST(coalesce(sum(qualified), 0) AS DOUBLE)
                   / nullif(coalesce(sum(qualified), 0) + coalesce(sum(unqualified), 0), 0), NULL,
               any_value(publisher_name)
        FROM kpis LEFT JOIN publisher ON publisher.id = publisher_id GROUP BY publisher_id
        UNION ALL
        SELECT 'campaign', NULL, NULL, NULL, campaign_id, CAST(sum(clicks) AS BIGINT),
               CAST(sum(conversions) AS BIGINT), NULL, NULL, CAST(sum(spend_hour) AS BIGINT), NULL,
               CAST(sum(spend_hour) AS DOUBLE) / sum(conversions), NULL
        FROM kpis GROUP BY campaign_id""",
    "stream_state_totals": KPIS,
    "stream_late_side": KPIS,
    "stream_replay": KPIS,
    "stream_compacted": KPIS,
    "ingest_accepted": ACCEPTED,
    "ingest_rejected": REJECTED,
    "stream_ingest": ACCEPTED,
    "stream_ingest_rejected": REJECTED,
    "stream_ingest_to_kpis": _with(
        _payload_ctes(),
        "\ningested AS (SELECT * REPLACE (date_trunc('second', exact_ts) AS ts) FROM accepted)",
        _kpis("ingested"),
    ) + f"""SELECT {KEY_LIST}, bid_set, clicks, spend_hour, conversions, qualified, unqualified
        FROM kpis""",
    "schema_contract": _contract(),
    "create_if_missing": _with(EVENTS, TABLES, _kpis("tracking"))
        + _sink("kpis", "(SELECT max(ts) FROM tracking)"),
    "bootstrap_if_empty": _with(TABLES) + "SELECT id, company_id, group_id, campaign_id FROM job",
}
