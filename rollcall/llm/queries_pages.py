"""Queries over web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import html_text, urlfilter
from rollcall.llm.queries import query, table

URL_RULES = """('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')"""

URL_SQL = f"""
WITH u AS (
    SELECT page_id, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '') AS raw,
           coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
h AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
             AS host, path FROM u),
r(rule_host, rule_path, verdict) AS (VALUES {URL_RULES}),
f AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
             arg_max(verdict, length(rule_host || rule_path)) AS verdict
      FROM (SELECT DISTINCT host, path FROM h) JOIN r
        ON (host = rule_host OR suffix(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM h LEFT JOIN f USING (host, path)"""


@query("op5_url_filter", URL_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {URL_RULES} AS r(host, path, verdict)")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.judge(pages, rules).select("page_id", "host", "path", "rule", "verdict")


@query("op2_html_text")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = html_text.extract(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", "text", F.length("text").alias("n_chars"))
