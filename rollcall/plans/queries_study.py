"""The study's jobs, and the documents published at the end."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.constants import STUDY_STAGES
from rollcall.functions.text import round_half_up
from rollcall.operators import decode, ownership, verdict
from rollcall.plans import bindings as b, publish, study
from rollcall.plans.catalog import percent_sql, query, round_sql
from rollcall.plans.queries_ingest import _block_table, _TIMES_SQL
from rollcall.plans.queries_measure import GRADED_SQL
from rollcall.session import fresh_path, materialise
from rollcall.sources import csvfiles, jsondocs


@query("study_registrations", f"""{_TIMES_SQL} SELECT agent_id,
    '0xAB' || lpad(to_hex(event_id % 40), 38, '0') AS owner,
    CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 31 = 0 THEN ''
        WHEN event_id % 23 = 0 THEN 'https://h' || (event_id % 97) || '.t' || chr(0) || 'est/ü'
        ELSE 'https://h' || (event_id % 97) || '.test/ü' END AS agent_uri_at_registration,
    block_number, seconds AS "timestamp",
    coalesce(strftime(to_timestamp(seconds) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ'), '')
        AS datetime_utc
    FROM decoded LEFT JOIN blocks USING (block_number)
    WHERE source_type = 'signup'""")
def study_registrations(spark, sf_dir):
    raw = b.log_table(spark, sf_dir)
    rows = decode.study_registrations(raw)
    return study.with_times(rows, _block_table(raw)) \
        .drop("tx_hash", "log_index")


@query("study_cut_payloads", f"""WITH {b.DECODED_SQL} SELECT tx_hash, CAST(0 AS BIGINT) AS chars
    FROM decoded WHERE source_type = 'signup' AND event_id % 31 = 0""")
def study_cut_payloads(spark, sf_dir):
    """A payload cut in half holds no text the lenient reader could take."""
    rows = decode.study_registrations(b.raw_logs(spark, sf_dir))
    return rows.where(F.col("log_index").cast("bigint") % 31 == 0).select(
        F.lower("tx_hash").alias("tx_hash"),
        F.char_length("agent_uri_at_registration").cast("bigint").alias("chars"))


@query("study_current_uris", f"""WITH {b.DECODED_SQL} SELECT tx_hash,
    CASE WHEN event_id % 7 <> 0 THEN 'https://h' || (event_id % 97) || '.test/ü' END
        AS agent_uri_current,
    CASE WHEN event_id % 7 = 0 THEN false
        ELSE event_id % 5 = 0 OR event_id % 31 = 0 OR event_id % 23 = 0 END AS changed
    FROM decoded WHERE source_type = 'signup'""")
def study_current_uris(spark, sf_dir):
    """Current URIs by lookup; one agent in seven did not answer. Payloads that are cut or
    hold NUL characters differ from what the registry answers now."""
    rows = materialise(decode.study_registrations(b.raw_logs(spark, sf_dir)).select(
        F.lower("tx_hash").alias("agent_id"), "agent_uri_at_registration",
        F.col("log_index").cast("bigint").alias("log_index")), "registered")
    answers = rows.where("log_index % 7 <> 0").select("agent_id", F.concat(
        F.lit("https://h"), (F.col("log_index") % 97).cast("string"), F.lit(".test/ü")).alias("uri"))
    return study.with_current_uris(rows, answers).select(
        F.col("agent_id").alias("tx_hash"), "agent_uri_current",
        F.col("uri_changed_after_registration").alias("changed"))


def _resolved(spark, sf_dir):
    rows = b.table(spark, sf_dir, "orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS agent_id", "o_orderkey AS k",
        "CASE WHEN o_orderkey % 3 = 0 THEN ' ' ELSE 'https://a/' || o_orderkey END "
        "AS agent_uri_at_registration")
    answers = rows.where("k % 15 <> 4").selectExpr(
        "agent_id", "CASE WHEN k % 4 = 0 THEN '' WHEN k % 6 = 1 THEN 'https://b' "
                    "ELSE agent_uri_at_registration || ' ' END AS uri")
    return study.resolve(rows.drop("k"), answers)


@query("resolution_summary", f"""WITH r AS (SELECT o_orderkey AS k, o_orderkey % 15 = 4 AS un,
        CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://a/' || o_orderkey END AS old,
        CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 6 = 1 THEN 'https://b'
            WHEN o_orderkey % 3 = 0 THEN '' ELSE 'https://a/' || o_orderkey END AS new FROM orders),
    s AS (SELECT count(*) AS agents, count(*) FILTER (WHERE un) AS unresolved,
        count(*) FILTER (WHERE old = '') AS empty_at_registration,
        count(*) FILTER (WHERE NOT un AND new = '') AS empty_now,
        count(*) FILTER (WHERE NOT un AND new <> old) AS changed FROM r)
    SELECT *, {round_sql('100.0 * (empty_at_registration / CAST(agents AS DOUBLE))', 1)}
            AS empty_at_registration_pct,
        {round_sql('100.0 * (empty_now / CAST(agents - unresolved AS DOUBLE))', 1)} AS empty_now_pct,
        {round_sql('100.0 * (changed / CAST(agents - unresolved AS DOUBLE))', 1)} AS changed_pct
    FROM s""")
def resolution_summary(spark, sf_dir):
    return study.resolution_summary(_resolved(spark, sf_dir))


STUDY_FLAGS = [column for _, column in STUDY_STAGES if column]

# Flags as the study's CSV spells them, one row per order.
_FLAGS_SQL = f"""{b.ORDER_CHECKS_SQL}, flagged AS (SELECT *, s6_endpoint_alive AS
    s6_any_endpoint_alive FROM order_checks)"""


def _study_rows(spark, sf_dir):
    rows = b.order_checks(spark, sf_dir).withColumnRenamed("s6_endpoint_alive",
                                                           "s6_any_endpoint_alive")
    spelled = {c: F.when(F.col(c), F.element_at(F.array(*[F.lit(t) for t in (
        "True", "1", "yes ")]), (F.col("id") % 3 + 1).cast("int"))).otherwise("False")
        for c in STUDY_FLAGS}
    return rows.withColumns(spelled).withColumns({
        "fetch_error": F.when(F.col("id") % 4 == 0, "ReadTimeout: slow")
        .when(F.col("id") % 4 == 1, "ConnectError: x:y").otherwise(""),
        "http_status": (F.col("id") % 3 + 500).cast("string")})


def _study_stage_sql() -> str:
    rows = []
    for i, (label, column) in enumerate(STUDY_STAGES):
        now = "count(*)" if column is None else f"count(*) FILTER (WHERE {column})"
        prev = STUDY_STAGES[max(i - 1, 0)][1]
        before = "count(*)" if prev is None else f"count(*) FILTER (WHERE {prev})"
        rows.append(f"SELECT {i} AS stage_no, '{label}' AS label, {now} AS n, count(*) AS total, "
                    f"{before} AS prev FROM flagged")
    return " UNION ALL ".join(rows)


@query("study_funnel", f"""WITH {_FLAGS_SQL}, st AS ({_study_stage_sql()}) SELECT stage_no, label, n,
    {round_sql('100.0 * (n / CAST(total AS DOUBLE))', 1)} AS pct_of_total,
    CASE WHEN prev > 0 THEN {round_sql('100.0 * (n / CAST(prev AS DOUBLE))', 1)} ELSE 0.0 END
    AS pct_of_previous FROM st""")
def study_funnel(spark, sf_dir):
    return study.funnel(_study_rows(spark, sf_dir))


_Z, _P, _N = "CAST(1.96 AS DOUBLE)", "(live / CAST(agents AS DOUBLE))", "CAST(agents AS DOUBLE)"
_MID = f"({_P} + {_Z} * {_Z} / (2.0 * {_N}))"
_SPREAD = f"({_Z} * sqrt({_P} * (1.0 - {_P}) / {_N} + {_Z} * {_Z} / (4.0 * {_N} * {_N})))"
_DIV = f"(1.0 + {_Z} * {_Z} / {_N})"


@query("study_live_share", f"""WITH {_FLAGS_SQL}, s AS (SELECT count(*) AS agents,
        count(*) FILTER (WHERE s6_any_endpoint_alive) AS live FROM flagged)
    SELECT live, agents, {round_sql(f'100.0 * {_P}', 1)} AS pct,
        floor(({_MID} - {_SPREAD}) / {_DIV} * 1000.0 + 0.5) / 10.0 AS ci_low,
        floor(({_MID} + {_SPREAD}) / {_DIV} * 1000.0 + 0.5) / 10.0 AS ci_high,
        floor((({_MID} + {_SPREAD}) / {_DIV} - ({_MID} - {_SPREAD}) / {_DIV}) * 1000.0 + 0.5)
            / 10.0 AS width FROM s""")
def study_live_share(spark, sf_dir):
    return study.live_share(study.funnel(_study_rows(spark, sf_dir)))


@query("drop_offs", f"""WITH {_FLAGS_SQL}, st AS ({_study_stage_sql()}),
    steps AS (SELECT a.label AS from_stage, z.label AS to_stage, a.n - z.n AS lost, a.total
        FROM st a JOIN st z ON z.stage_no = a.stage_no + 1)
    SELECT from_stage, to_stage, lost, {round_sql('100.0 * (lost / CAST(total AS DOUBLE))', 1)}
        AS points FROM steps ORDER BY lost DESC, from_stage DESC LIMIT 3""")
def drop_offs(spark, sf_dir):
    return study.drop_offs(study.funnel(_study_rows(spark, sf_dir)))


@query("resolve_failures", f"""WITH {_FLAGS_SQL} SELECT CASE WHEN id % 4 = 0 THEN 'ReadTimeout'
        WHEN id % 4 = 1 THEN 'ConnectError' ELSE 'HTTP ' || (id % 3 + 500) END AS reason,
    count(*) AS n FROM flagged WHERE s1_uri_present AND NOT s2_resolved GROUP BY 1
    ORDER BY n DESC, reason LIMIT 10""")
def resolve_failures(spark, sf_dir):
    return study.resolve_failures(_study_rows(spark, sf_dir))


@query("owner_top5", f"""WITH {b.ORDER_CHECKS_SQL} SELECT lower(owner) AS owner, count(*) AS agents,
    {round_sql('100.0 * (count(*) / CAST((SELECT count(*) FROM order_checks) AS DOUBLE))', 4)}
        AS share_pct,
    (SELECT count(DISTINCT lower(owner)) FROM order_checks WHERE owner <> '') AS distinct_owners,
    (SELECT count(*) FROM order_checks) AS "rows"
    FROM order_checks WHERE owner <> '' GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5""")
def owner_top5(spark, sf_dir):
    return ownership.top_owners(b.order_checks(spark, sf_dir)) \
        .withColumn("share_pct", round_half_up(F.col("share_pct"), 4))


# --- the study's verdict ----------------------------------------------------------------

@query("study_verdict", f"""WITH {GRADED_SQL}, s AS (SELECT *,
        CASE WHEN u IN (0, 1) THEN 0 WHEN u = 4 THEN 1
            WHEN u = 2 THEN CASE q % 3 WHEN 0 THEN 2 ELSE 1 END WHEN u = 3 THEN 2
            WHEN q IN (0, 1, 3, 4) THEN 1 ELSE 2 END AS got FROM graded WHERE pass = 1),
    t AS (SELECT *, CASE WHEN got < 2 THEN got WHEN d IN (0, 1) OR (u >= 5 AND q = 2) THEN 2
            WHEN d = 2 THEN 3
            WHEN d = 3 THEN 4 WHEN d IN (4, 5) THEN 5 ELSE 6 END AS funnel_stage FROM s)
    SELECT CAST(k AS VARCHAR) AS agent_id, funnel_stage,
        CASE WHEN got < 2 AND u = 4 THEN 'unsupported_scheme:other'
            WHEN u >= 5 AND q = 1 THEN 'ReadTimeout: slow' ELSE '' END AS fetch_error,
        CASE WHEN u IN (0, 1, 4) THEN '' WHEN u = 2 THEN CASE WHEN q % 3 = 2 THEN '' ELSE '200' END
            WHEN u = 3 THEN 'data' WHEN q = 0 THEN '404' WHEN q IN (1, 4) THEN '' WHEN q = 3 THEN '429' ELSE '200' END
            AS http_status,
        CASE WHEN funnel_stage < 4 OR (d = 3) THEN CASE WHEN funnel_stage >= 4 THEN '0' ELSE '' END
            ELSE CASE d WHEN 4 THEN '2' WHEN 5 THEN '3' WHEN 6 THEN '2' ELSE '6' END END
            AS services_count,
        CASE WHEN funnel_stage >= 5 AND d = 4 THEN 'x'
            WHEN funnel_stage >= 5 AND d = 5 THEN 'web' WHEN funnel_stage >= 5 AND d = 6 THEN 'z|b'
            ELSE '' END AS service_types
    FROM t""")
def study_verdict(spark, sf_dir):
    """The same attempts under the study's rules: neither robots nor exclusions, and any 2xx
    answer ends the search."""
    targets = materialise(b.probe_targets(spark, sf_dir).where("pass = 1"), "targets")
    rows = targets.select("run_id", "agent_id", "pass", "uri", F.lit("").alias("owner"),
                          F.lit("agent_uri_current").alias("uri_source"), "checked_at")
    graded = verdict.grade_study(rows, b.fetches(targets), b.endpoint_probes(targets))
    return graded.select("agent_id", F.col("funnel_stage").cast("int"), "fetch_error",
                         "http_status", "services_count", "service_types")


# --- files and documents ----------------------------------------------------------------

CSV_SQL = """SELECT CAST(doc_id AS VARCHAR) AS agent_id,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS uri,
    CASE WHEN doc_id % 3 = 0 THEN '' ELSE 'agent_uri_at_registration' END AS uri_source
    FROM documents"""


def _csv_path(spark, sf_dir):
    rows = b.table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("agent_id"), F.lit("").alias("owner"),
        F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text"))
        .alias("agent_uri_at_registration"), F.lit("").alias("agent_uri_current"))
    path = fresh_path(spark, "csv")
    csvfiles.write_table(rows, path, rows.columns)
    return path


@query("csv_round_trip", CSV_SQL)
def csv_round_trip(spark, sf_dir):
    """Whole texts, with quotes, commas and line breaks, written as CSV and read back."""
    return csvfiles.agent_uris(csvfiles.read_table(spark, _csv_path(spark, sf_dir))) \
        .select("agent_id", "uri", "uri_source")


@query("csv_cut_round_trip", CSV_SQL)
def csv_cut_round_trip(spark, sf_dir):
    """The same files, cut between records wherever their blocks end."""
    return csvfiles.agent_uris(csvfiles.read_cut_table(spark, _csv_path(spark, sf_dir))) \
        .select("agent_id", "uri", "uri_source")


@query("text_round_trip", """SELECT CAST(row_number() OVER (ORDER BY o_orderkey) AS VARCHAR)
    AS agent_id, 'https://a/' || o_orderkey AS uri FROM orders""")
def text_round_trip(spark, sf_dir):
    path = fresh_path(spark, "txt")
    b.table(spark, sf_dir, "orders").orderBy("o_orderkey").selectExpr(
        "'  https://a/' || o_orderkey || ' ' AS value").write.text(path)
    return csvfiles.uris_from_text(spark, path).select("agent_id", "uri")


def _publishable(spark, sf_dir):
    stored = b.check_table(spark, sf_dir)
    agents = stored.selectExpr(
        "agent_id", "owner", "uri_root_domain",
        "CAST(make_date(2023, CAST(id % 12 + 1 AS INT), 1) AS TIMESTAMP) AS registered_at",
        "CASE WHEN id % 5 = 0 THEN '' ELSE 'https://a' END AS current_uri",
        "CASE WHEN id % 4 = 0 THEN '' ELSE 'https://a' END AS uri_at_registration",
        "CAST(id % 3 AS INT) AS uri_change_count", "CAST(id % 2 AS INT) AS transfer_count")
    checks = stored.drop("owner", "uri_root_domain").selectExpr(
        "*", "explode(array(1L, 2L)) AS run_id").withColumn(
        "checked_at", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("run_id") * 2_592_000))
    runs = spark.range(1, 3).selectExpr(
        "id", "'panel' AS kind", "'completed' AS status",
        "timestamp_seconds(1700000000 + id * 2592000) AS started_at",
        "timestamp_seconds(1700000000 + id * 2592000 + 60) AS finished_at",
        "CAST(10 AS INT) AS agents_checked", "8 AS concurrency",
        "CAST(20 AS DECIMAL(6,2)) AS timeout_seconds", "'1.1' AS prober_version")
    return agents, checks, runs


@query("summary_documents", f"""WITH RECURSIVE {b.PROJECTS_SQL}, f AS (
    SELECT count(*) AS nn, count(*) FILTER (WHERE live_strict) AS kk FROM analysed),
    p AS (SELECT count(*) AS nn, count(*) FILTER (WHERE live) AS kk FROM
        (SELECT project, bool_or(live_strict) AS live FROM projects GROUP BY 1))
    SELECT (SELECT count(*) FROM documents) AS agents,
        (SELECT count(*) FROM document_checks) - (SELECT count(*) FROM analysed) AS censored,
        f.nn AS agent_n, f.kk AS agent_k, {percent_sql('f.kk', 'f.nn')} AS agent_pct,
        p.nn AS project_n, p.kk AS project_k, CAST(7 AS BIGINT) AS documents,
        (SELECT count(*) FROM document_checks WHERE live_strict) AS survival_n,
        (SELECT max(c) FROM (SELECT count(*) AS c FROM projects GROUP BY project))
            AS largest_project,
        (SELECT max(o_orderkey) FROM orders) AS indexed_through, 'error' AS last_status,
        'node unreachable' AS last_error, (SELECT max(o_orderkey) FROM orders) AS meta_block,
        (SELECT count(*) FROM documents) AS totals_agents,
        (SELECT count(DISTINCT lower(owner)) FROM analysed WHERE owner <> '') AS owner_n,
        (SELECT count(DISTINCT lower(owner)) FROM analysed WHERE owner <> '' AND live_strict)
            AS owner_k,
        (SELECT count(*) FROM document_checks WHERE live_strict) AS survival_document_n,
        (SELECT least(20, count(DISTINCT project)) FROM projects) AS top_projects,
        CAST(6 AS BIGINT) AS endpoints FROM f, p""")
def summary_documents(spark, sf_dir):
    """Build the seven published documents, write them, read them back and pick figures."""
    agents, checks, runs = _publishable(spark, sf_dir)
    progress = b.table(spark, sf_dir, "orders").agg(F.max("o_orderkey").alias("last_block")) \
        .select("last_block", F.inline(F.array(
            *[F.struct(F.lit(n).alias("batch_id"), F.lit(status).alias("status"),
                       F.lit(error).cast("string").alias("error"))
              for n, status, error in ((1, "ok", None), (2, "error", "node unreachable"))]))) \
        .withColumn("last_block", F.when(F.col("status") == "ok", F.col("last_block"))) \
        .withColumn("run_at", F.timestamp_seconds(F.col("batch_id") + 1_700_000_000))
    row = publish.summary(agents, b.event_log(spark, sf_dir), checks, runs, progress,
                          F.timestamp_seconds(F.lit(1_710_000_000)), horizons=(30, 90))
    path = fresh_path(spark, "documents")
    jsondocs.write_documents(publish.documents(row), path)
    documents = jsondocs.read_documents(spark, path)
    pick = lambda p, kind: F.get_json_object("json", p).cast(kind)
    number = documents.agg(F.count(F.lit(1)).alias("n")).scalar()

    def other(name, p, kind="bigint"):
        return documents.where(F.col("name") == name).select(pick(p, kind)).scalar()
    return documents.where("name = 'summary.json'").select(
        pick("$.registry.agents", "bigint").alias("agents"),
        pick("$.liveness.censored.n", "bigint").alias("censored"),
        pick("$.liveness.by_agent.stages[6].n", "bigint").alias("agent_n"),
        pick("$.liveness.by_agent.stages[6].k", "bigint").alias("agent_k"),
        pick("$.liveness.by_agent.stages[6].pct", "double").alias("agent_pct"),
        pick("$.liveness.by_project.denominator", "bigint").alias("project_n"),
        pick("$.liveness.by_project.stages[6].k", "bigint").alias("project_k"),
        number.alias("documents"),
        pick("$.survival.horizons[0].n", "bigint").alias("survival_n"),
        pick("$.liveness.top_projects[0].agents", "bigint").alias("largest_project"),
        pick("$.registry.indexed_through_block", "bigint").alias("indexed_through"),
        pick("$.registry.indexer_last_status", "string").alias("last_status"),
        pick("$.registry.indexer_last_error", "string").alias("last_error"),
        other("meta.json", "$.indexed_through_block").alias("meta_block"),
        other("registrations.json", "$.totals.agents").alias("totals_agents"),
        other("funnel.json", "$.by_owner.denominator").alias("owner_n"),
        other("funnel.json", "$.by_owner.stages[6].k").alias("owner_k"),
        other("survival.json", "$.survival.horizons[0].n").alias("survival_document_n"),
        documents.where("name = 'projects.json'").select(F.size(F.from_json(F.get_json_object(
            "json", "$.top_projects"), "array<string>")).cast("bigint")).scalar()
        .alias("top_projects"),
        documents.where("name = 'index.json'").select(F.size(F.from_json(F.get_json_object(
            "json", "$.endpoints"), "array<string>")).cast("bigint")).scalar()
        .alias("endpoints"))


