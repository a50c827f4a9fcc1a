"""Texts of documents behind checks, and blanks around texts."""

import re

from pyspark.sql import functions as F

from rollcall.functions.text import strip
from rollcall.operators import verdict


def test_text_of_a_check_is_one_row_even_if_an_attempt_is_recorded_twice(spark):
    targets = spark.sql("SELECT 1L AS run_id, 'a' AS agent_id, 1 AS pass, 'https://a.test' AS uri")
    fetched = spark.sql("""SELECT 1L AS run_id, 'a' AS agent_id, 1 AS pass, explode(array(0, 0)) AS pos,
        'https://a.test' AS target, false AS excluded, true AS robots_allowed, 200 AS status,
        CAST(NULL AS STRING) AS error_class, CAST(NULL AS STRING) AS error_message,
        1 AS latency_ms, '' AS content_type, 2L AS bytes, '{"a": 1}' AS body""")
    rows = verdict.documents_of_run(targets, fetched).collect()
    assert [(r.agent_id, r.pos, r.body) for r in rows] == [("a", 0, '{"a": 1}')]


def test_documents_are_looked_at_once(spark):
    """One parser in the plan and one reading of each table: no attempt is judged twice."""
    targets = spark.sql("SELECT 1L AS run_id, id || '' AS agent_id, 1 AS pass, 'data:,{}' AS uri "
                        "FROM range(3)")
    fetched = spark.sql("""SELECT 1L AS run_id, 'x' AS agent_id, 1 AS pass, 0 AS pos, '' AS target,
        false AS excluded, true AS robots_allowed, 200 AS status,
        CAST(NULL AS STRING) AS error_class, CAST(NULL AS STRING) AS error_message,
        1 AS latency_ms, '' AS content_type, 2L AS bytes, '{"a": 1}' AS body""").where("rand() > 2")
    found = verdict.documents_of_run(targets, fetched)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Range (") == 2 and len(found.collect()) == 3


def test_strip_of_every_kind_of_end(spark):
    texts = ["", " ", "a", " a", "a ", "\x1ca\x1f", "　a b ", "a\n\n", "\r\n", "é ", "\u0085x",
             "😀", " 😀\t", "a b", None]
    got = [r[0] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)],
                                               "i int, t string").orderBy("i")
           .select(strip(F.col("t"))).collect()]
    assert got == [None if t is None else re.sub(r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "", t)
                   for t in texts]
