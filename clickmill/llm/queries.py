"""The operators as registered queries, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickmill.llm import (
    alignment, decontaminate, language, mixing, near_dup, pages, passages, prefix_trie, quality, rules, secrets,
    token_counts, warc,
)
from clickmill.llm.common import read_table


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, read_table(spark, sf_dir, "labels")))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated_passages(read_table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"), token_counts.new_cache(spark))


def op4_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revisits of a crawl made from ``pages``, resolved; headers as one text."""
    found = warc.resolve(warc.crawl_records(read_table(spark, sf_dir, "pages")))
    lines = F.transform("headers", lambda h: F.concat_ws(": ", h["name"], h["value"]))
    return found.withColumn("headers", F.when(F.col("headers").isNotNull(), F.array_join(F.array_sort(lines), "\n")))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.summary(secrets.scan(read_table(spark, sf_dir, "documents")))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract_pages(read_table(spark, sf_dir, "pages"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read_table(spark, sf_dir, "conversations"), prefix_trie.by_hundreds())


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language.identify(docs, language.learn(docs))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_substring_dedup, op3_token_counts, op4_warc_revisits, op5_quality_rules,
        op6_minhash_dedup, op7_decontamination,
        op8_secret_scan, op9_source_mixing, op10_html_extraction,
        op11_conversation_trie, op12_token_alignment, op13_language_id,
    )
}
_CANONICAL = """
    CASE WHEN regexp_extract({url}, '{parts}', 1) = '' THEN {url} ELSE
    lower(regexp_extract({url}, '{parts}', 1)) || '://' || lower(regexp_extract({url}, '{parts}', 2))
    || CASE WHEN regexp_extract({url}, '{parts}', 3) = ''
              OR (lower(regexp_extract({url}, '{parts}', 1)) = 'http' AND regexp_extract({url}, '{parts}', 3) = '80')
              OR (lower(regexp_extract({url}, '{parts}', 1)) = 'https' AND regexp_extract({url}, '{parts}', 3) = '443')
            THEN '' ELSE ':' || regexp_extract({url}, '{parts}', 3) END
    || CASE WHEN regexp_extract({url}, '{parts}', 4) = '' THEN '/' ELSE regexp_extract({url}, '{parts}', 4) END
    || CASE WHEN len(list_filter(string_split(regexp_extract({url}, '{parts}', 5), '&'),
                 lambda p: p <> '' AND NOT regexp_matches(p, '{tracking}'))) = 0 THEN '' ELSE '?' ||
       array_to_string(list_sort(list_filter(string_split(regexp_extract({url}, '{parts}', 5), '&'),
                 lambda p: p <> '' AND NOT regexp_matches(p, '{tracking}'))), '&') END END
"""


def _canonical_sql(url: str) -> str:
    return _CANONICAL.format(url=url, parts=warc.URL_PARTS, tracking=warc.TRACKING)


ORACLES: dict[str, str] = {
    "op4_warc_revisits": f"""
WITH made AS (
  SELECT page_id, url, md5(coalesce(html, '')) AS sum, sha1(coalesce(html, '')) AS digest,
         CAST(strlen(coalesce(html, '')) AS BIGINT) AS bytes, 1700000000 + page_id * 60 AS had,
         'day ' || CAST(page_id // 24 AS VARCHAR) AS changed
  FROM pages),
tagged AS (
  SELECT *, CASE WHEN page_id % 5 <> 0 THEN '"' || sum[1:12] || '"' END AS tag FROM made),
responses AS (
  SELECT 'r' || page_id AS response_id, {_canonical_sql("url")} AS page, had AS at, tag AS old_tag,
         changed AS old_changed, digest, bytes, had FROM tagged),
revisits AS (
  SELECT 'v' || page_id AS record_id, {_canonical_sql("regexp_replace(url, '#.*$', '') || '#seen'")} AS page,
         had + 86400 AS captured,
         CASE WHEN page_id % 7 = 0 THEN '"other"' WHEN page_id % 3 = 0 THEN 'W/' || tag ELSE tag END AS tag,
         CASE WHEN page_id % 10 <> 0 THEN changed END AS changed, had + 86400 AS renewed FROM tagged
  UNION ALL
  SELECT 'e' || page_id, {_canonical_sql("url")}, had - 1, tag, changed, had + 86400 FROM tagged WHERE page_id % 4 = 0),
joined AS (
  SELECT r.*, s.* EXCLUDE (page) FROM revisits r ASOF LEFT JOIN responses s ON r.page = s.page AND r.captured > s.at),
judged AS (
  SELECT *, CASE
    WHEN response_id IS NULL THEN 'orphan'
    WHEN tag IS NULL AND changed IS NULL THEN 'unverified'
    WHEN tag IS NOT NULL AND regexp_replace(tag, '^W/', '') = regexp_replace(old_tag, '^W/', '') THEN 'resolved'
    WHEN tag IS NULL AND changed = old_changed THEN 'resolved'
    ELSE 'changed' END AS verdict
  FROM joined)
SELECT record_id, page, captured, verdict, response_id,
       CASE WHEN verdict = 'resolved' THEN digest END AS payload_digest,
       CASE WHEN verdict = 'resolved' THEN bytes END AS payload_length,
       CASE WHEN verdict = 'resolved' THEN 'Content-Length: ' || bytes || chr(10) || 'Content-Type: text/html'
         || chr(10) || 'cache-control: max-age=3600' || chr(10) || 'date: ' || renewed END AS headers
FROM judged""",
}
