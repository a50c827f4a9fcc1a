"""Queries over embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import lemp, quantised, topk
from rollcall.llm.queries import query, table
from rollcall.llm.vectors import numbered, usable

USABLE_SQL = """vec_id IS NOT NULL AND len(embedding) > 0 AND list_bool_and(list_transform(
    embedding, lambda x: x IS NOT NULL AND isfinite(x)))"""

DEDUP_SQL = f"""
WITH RECURSIVE v AS (
    SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
    WHERE {USABLE_SQL} AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS MATERIALIZED (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b
      ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings
                UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
roots AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN roots USING (vec_id) LEFT JOIN counts USING (vec_id)"""

TOP_SQL = f"""
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings WHERE {USABLE_SQL}),
s AS (SELECT q.r AS query, q.vec_id AS query_id, c.vec_id,
             list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v AS q JOIN v AS c ON q.vec_id % 50 = 0 AND c.r <> q.r AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id)::INTEGER
                AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


HARD_SQL = """
WITH v AS (
    SELECT row_number() OVER () AS r, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
    FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
     AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))),
s AS MATERIALIZED (
    SELECT a.r AS ar, a.vec_id AS anchor_id, a.label = c.label AS same, c.r AS cr, c.vec_id,
           list_inner_product(a.e, c.e)::BIGINT AS score
    FROM v AS a JOIN v AS c ON a.vec_id % 100 = 0 AND c.r <> a.r AND len(a.e) = len(c.e)),
p AS (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id, cr) AS place
      FROM s WHERE same),
n AS (SELECT p.ar, p.cr AS pr, p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
             s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY s.score DESC, s.vec_id, s.cr)
                 ::INTEGER AS rank
      FROM p JOIN s ON p.ar = s.ar AND NOT s.same AND p.place <= 5
       AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10"""


@query("op6_embedding_dedup", DEDUP_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quantised.near_duplicates(table(spark, sf_dir, "embeddings"))


def whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Usable embeddings, with vector: each component x as floor(256 * x)."""
    return table(spark, sf_dir, "embeddings").where(usable(F.col("embedding"))) \
        .withColumn("vector", F.transform(
            "embedding", lambda x: F.floor(x.cast("double") * 256).cast("double")))


@query("op9_exact_topk", TOP_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = numbered(whole(spark, sf_dir).select(F.col("vec_id").alias("id"), "vector"))
    return topk.top_k(vectors.where("id % 50 = 0"), vectors, 5)


@query("op12_hard_negatives", HARD_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = whole(spark, sf_dir).select("vec_id", label.alias("label"), "vector")
    return lemp.hard_negatives(vectors, F.col("vec_id") % 100 == 0)
