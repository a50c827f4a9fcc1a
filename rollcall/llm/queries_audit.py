"""Queries that hold documents against a benchmark and sources against each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import divergence, wumanber
from rollcall.llm.queries import query, table

UPPER_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
WORDS_SQL = f"regexp_extract_all(translate(text, {UPPER_LOWER}), " \
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

LEAKS_SQL = f"""
WITH b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE text IS NOT NULL),
bn AS (SELECT item_id, w, least(len(w), 10) AS n FROM b WHERE len(w) > 0),
bi AS (SELECT item_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM bn),
windows AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM bi),
d AS (SELECT row_number() OVER () AS r, doc_id,
             coalesce({WORDS_SQL}, []) AS w FROM documents),
di AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
       FROM d JOIN (SELECT DISTINCT n FROM windows) ON n <= len(w)),
hits AS MATERIALIZED (
    SELECT r, i, n, item_id FROM (
        SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM di)
    JOIN windows USING (n, s)),
words AS (SELECT r, count(DISTINCT k) AS n_hit FROM (
    SELECT r, unnest(generate_series(i, i + n - 1)) AS k FROM (SELECT DISTINCT r, i, n FROM hits))
    GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (
    SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (r) LEFT JOIN items USING (r)"""


@query("op11_benchmark_leaks", LEAKS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = wumanber.occurrences(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                 table(spark, sf_dir, "benchmark"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["last"] - s["first"] + 1)
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"))


DIVERGENCE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, {UPPER_LOWER}),
             '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term
                   HAVING count(DISTINCT r) >= 3),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term)
                   GROUP BY lang, source, term),
g AS MATERIALIZED (
    SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
    LEFT JOIN c USING (lang, source) GROUP BY lang, source),
l AS (SELECT lang, count(*) AS v, sum(n) AS total FROM k GROUP BY lang),
p AS MATERIALIZED (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (g.total + l.v) AS p,
           1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS q
    FROM g JOIN k USING (lang) JOIN l USING (lang)
    LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
    SELECT g.lang, g.source, o.source AS item, coalesce(any_value(f), 0)::BIGINT AS value
    FROM g JOIN g AS o ON g.lang = o.lang AND g.source <> o.source
    LEFT JOIN (SELECT a.lang, a.source, b.source AS other, sum((a.p - b.p) * (a.p - b.p) // b.p) AS f
               FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term
                AND a.source <> b.source GROUP BY a.lang, a.source, b.source) AS s
      ON s.lang = g.lang AND s.source = g.source AND s.other = o.source
    GROUP BY g.lang, g.source, o.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
          FROM p WHERE n > 0 AND p > q),
ranked AS (
    SELECT lang, source, 'pair' AS part, item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', item, value,
           row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) FROM terms)
SELECT lang, source, part, item, value, rank::INTEGER AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200"""


@query("op13_source_divergence", DIVERGENCE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents").select("text", "lang", "source"))
