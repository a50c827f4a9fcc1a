"""Rows of grading move once: exchanges of the plan, and the rows that come of it."""

from rollcall.operators import verdict


def _inputs(spark):
    targets = spark.range(60).selectExpr(
        "CAST(id % 3 AS BIGINT) AS run_id", "CAST(id % 10 AS STRING) AS agent_id",
        "CAST(id % 2 + 1 AS INT) AS pass", "'https://a.test/' || id AS uri",
        "CAST(NULL AS TIMESTAMP) AS checked_at").dropDuplicates(["run_id", "agent_id", "pass"])
    body = """'{"type": "erc8004:registration", "services": {"z": "https://github.com/", '
        || '"b": {"url": "https://s.test/"}, "b2": {"n": 1}}}'"""
    fetches = targets.selectExpr(
        "run_id", "agent_id", "pass", "0 AS pos", "uri AS target", "false AS excluded",
        "true AS robots_allowed", "200 AS status", "CAST(NULL AS STRING) AS error_class",
        "CAST(NULL AS STRING) AS error_message", "1 AS latency_ms", "'t' AS content_type",
        "9 AS bytes", f"{body} AS body")
    probes = targets.selectExpr(
        "run_id", "agent_id", "pass", "explode(array(0, 1)) AS pos", "CAST(NULL AS STRING) AS url",
        "'HEAD' AS method", "false AS excluded", "true AS robots_allowed", "200 AS status",
        "CAST(NULL AS STRING) AS error_class", "CAST(NULL AS STRING) AS error_message",
        "1 AS latency_ms")
    return targets, fetches, probes


def test_each_row_moves_once(spark, tmp_path):
    stored = []
    for name, rows in zip(("targets", "fetches", "probes"), _inputs(spark)):
        rows.write.parquet(f"{tmp_path}/{name}")
        stored.append(spark.read.parquet(f"{tmp_path}/{name}"))
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = verdict.grade(*stored)._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_entries_of_an_object_and_their_hosts(spark):
    rows = verdict.grade(*_inputs(spark)).select(
        "endpoint_details.url", "endpoint_details.host", "endpoint_details.generic",
        "services_count", "endpoints_total", "live_strict").distinct().collect()
    assert [tuple(r) for r in rows] == [(
        ["https://github.com/", "https://s.test/"], ["github.com", "s.test"], [True, False],
        3, 2, True)]
