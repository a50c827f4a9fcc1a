"""Funnels, projects, cohorts, survival and registry totals."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.constants import STAGES
from rollcall.operators import funnel, ownership, projects, runs, state, survival, totals
from rollcall.plans import bindings as b
from rollcall.plans.catalog import percent_sql, query, round_sql, wilson_sql
from rollcall.session import materialise

HORIZONS, TOLERANCE = (7, 20), 2


def funnel_sql(source: str) -> str:
    """Seven rows from a relation with one row per counted unit."""
    branches, previous = [], "total"
    for number, (key, label) in enumerate(STAGES, start=1):
        branches.append(f"SELECT {number} AS stage_no, '{key}' AS stage, '{label}' AS label, "
                        f"{key} AS kk, {previous} AS prev, total FROM counts")
        previous = key
    counts = ", ".join(f"count(*) FILTER (WHERE {key}) AS {key}" for key, _ in STAGES)
    return f"""counts AS (SELECT count(*) AS total, {counts} FROM {source}),
        staged AS ({' UNION ALL '.join(branches)})
        SELECT stage_no, stage, label, {wilson_sql('kk', 'total')},
            CASE WHEN prev > 0 THEN {round_sql('100.0 * CAST(kk AS DOUBLE) / CAST(prev AS DOUBLE)')}
            END AS pct_of_previous FROM staged"""


def grouped_sql(source: str, key: str) -> str:
    flags = ", ".join(f"bool_or({stage}) AS {stage}" for stage, _ in STAGES)
    return f"(SELECT {key} AS g, {flags} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1)"


@query("funnel_agents", f"WITH {b.ORDER_CHECKS_SQL}, {funnel_sql('analysed')}")
def funnel_agents(spark, sf_dir):
    return funnel.agent_funnel(funnel.analysed(b.order_checks(spark, sf_dir)))


@query("funnel_owners", f"""WITH {b.ORDER_CHECKS_SQL},
    {funnel_sql(grouped_sql('analysed', "nullif(lower(owner), '')"))}""")
def funnel_owners(spark, sf_dir):
    return funnel.owner_funnel(funnel.analysed(b.order_checks(spark, sf_dir)))


@query("funnel_projects", f"""WITH RECURSIVE {b.PROJECTS_SQL},
    {funnel_sql(grouped_sql('projects', 'project'))}""")
def funnel_projects(spark, sf_dir):
    return projects.project_funnel(funnel.analysed(b.check_table(spark, sf_dir)))


def _final_sql(counted: str, source: str) -> str:
    return f"""SELECT '{counted}' AS counted, kk AS live, nn AS "of", pct, ci_low, ci_high
        FROM (SELECT kk, nn, {wilson_sql('kk', 'nn')} FROM
            (SELECT count(*) FILTER (WHERE live_strict) AS kk, count(*) AS nn FROM {source}))"""


@query("three_denominators", f"""WITH RECURSIVE {b.PROJECTS_SQL}
    {_final_sql('per agent', 'analysed')}
    UNION ALL {_final_sql('per owner', grouped_sql('analysed', "nullif(lower(owner), '')"))}
    UNION ALL {_final_sql('per project', grouped_sql('projects', 'project'))}""")
def three_denominators(spark, sf_dir):
    rows = funnel.analysed(b.check_table(spark, sf_dir))
    return funnel.final_stage(funnel.agent_funnel(rows), "per agent") \
        .unionByName(funnel.final_stage(funnel.owner_funnel(rows), "per owner")) \
        .unionByName(funnel.final_stage(projects.project_funnel(rows), "per project"))


@query("headline", f"""WITH {b.ORDER_CHECKS_SQL},
    a AS (SELECT count(*) AS nn, count(*) FILTER (WHERE live_strict) AS kk FROM analysed),
    o AS (SELECT count(*) AS nn, count(*) FILTER (WHERE live_strict) AS kk
        FROM {grouped_sql('analysed', "nullif(lower(owner), '')")})
    SELECT (SELECT count(*) FROM order_checks) AS registered,
        {percent_sql('a.kk', 'a.nn')} AS agent_pct, {percent_sql('o.kk', 'o.nn')} AS owner_pct
    FROM a, o""")
def headline(spark, sf_dir):
    from rollcall.plans.publish import headline_figures

    everyone = b.order_checks(spark, sf_dir)
    rows = funnel.analysed(everyone)
    return headline_figures(everyone.agg(F.count(F.lit(1)).alias("agents")),
                            funnel.agent_funnel(rows), funnel.owner_funnel(rows))


def _summary_sql() -> str:
    names = ["registered", *[key for key, _ in STAGES], "generic_only", "not_measured"]
    counts = ", ".join(f"count(*) FILTER (WHERE m AND {n}) AS {n}" for n in names[1:-1])
    rows = []
    for i, name in enumerate(names):
        share = "CAST(NULL AS DOUBLE)" if name == "not_measured" else percent_sql(name, "registered")
        step = percent_sql(name, names[i - 1]) if 0 < i <= len(STAGES) else "CAST(NULL AS DOUBLE)"
        rows.append(f"""SELECT {i} AS row_no, '{name}' AS item, {name} AS "count",
            {share} AS pct_of_measured, {step} AS pct_of_previous FROM c""")
    return f"""WITH {b.ORDER_CHECKS_SQL},
        tagged AS (SELECT *, coalesce(failure_category, '') NOT IN ('excluded_by_request',
            'robots_disallowed', 'undetermined') AS m FROM order_checks),
        c AS (SELECT count(*) FILTER (WHERE m) AS registered, {counts},
            count(*) FILTER (WHERE NOT m) AS not_measured FROM tagged)
        {' UNION ALL '.join(rows)}"""


@query("run_summary", _summary_sql())
def run_summary(spark, sf_dir):
    return funnel.run_summary(b.order_checks(spark, sf_dir))


@query("stage_histogram", f"""WITH {b.ORDER_CHECKS_SQL}
    SELECT funnel_stage, count(*) AS checks, count(*) FILTER (WHERE live_strict) AS live,
        count(*) FILTER (WHERE generic_only) AS generic_only FROM order_checks GROUP BY 1""")
def stage_histogram(spark, sf_dir):
    return funnel.stage_histogram(b.order_checks(spark, sf_dir))


@query("endpoint_totals", f"""WITH {b.ORDER_CHECKS_SQL}
    SELECT CAST(sum(endpoints_total) AS BIGINT) AS declared,
        CAST(sum(endpoints_ok) AS BIGINT) AS responding,
        CAST(sum(endpoints_ok_specific) AS BIGINT) AS responding_specific FROM analysed""")
def endpoint_totals(spark, sf_dir):
    return funnel.endpoint_totals(funnel.analysed(b.order_checks(spark, sf_dir)))


@query("generic_share", f"""WITH {b.ORDER_CHECKS_SQL} SELECT {wilson_sql('kk', 'nn')} FROM
    (SELECT count(*) FILTER (WHERE generic_only) AS kk, count(*) AS nn FROM analysed)""")
def generic_share(spark, sf_dir):
    return funnel.generic_only_share(funnel.analysed(b.order_checks(spark, sf_dir)))


def _failures_sql(source: str) -> str:
    return f"""WITH {b.ORDER_CHECKS_SQL}, t AS (SELECT count(*) AS nn FROM {source})
        SELECT failure_category AS category, count(*) AS n, {percent_sql('count(*)', 'max(nn)')} AS pct
        FROM {source}, t WHERE failure_category IS NOT NULL GROUP BY 1"""


@query("failure_breakdown", _failures_sql("analysed"))
def failure_breakdown(spark, sf_dir):
    return funnel.failure_breakdown(funnel.analysed(b.order_checks(spark, sf_dir)))


@query("censored_breakdown", _failures_sql("""(SELECT * FROM order_checks WHERE failure_category
    IN ('excluded_by_request', 'robots_disallowed', 'undetermined')) x"""))
def censored_breakdown(spark, sf_dir):
    return funnel.failure_breakdown(funnel.censored(b.order_checks(spark, sf_dir)))


@query("cohort_liveness", f"""WITH {b.ORDER_CHECKS_SQL}
    SELECT month, {wilson_sql('kk', 'nn')} FROM (SELECT strftime(registered_at, '%Y-%m') AS month,
        count(*) FILTER (WHERE live_strict) AS kk, count(*) AS nn FROM analysed GROUP BY 1)""")
def cohort_liveness(spark, sf_dir):
    return survival.cohorts(funnel.analysed(b.order_checks(spark, sf_dir)))


OUTCOMES_SQL = f"""{b.HISTORY_SQL},
    anchors AS (SELECT agent_id, min(seen_at) AS anchor FROM history WHERE live GROUP BY 1),
    horizons(h) AS (VALUES (7), (20)),
    near AS (SELECT history.agent_id, month, h, live, seen_at,
        seen_at - anchor - h * 86400000000 AS gap FROM history JOIN anchors USING (agent_id), horizons
        WHERE seen_at > anchor AND seen_at - anchor - h * 86400000000 >= -2 * 86400000000
            AND seen_at - anchor - h * 86400000000 < 3 * 86400000000),
    outcomes AS (SELECT agent_id, month, h AS horizon_days, live AS survived FROM
        (SELECT *, row_number() OVER (PARTITION BY agent_id, h ORDER BY abs(gap), seen_at, live) AS rn
         FROM near) WHERE rn = 1)"""


def _outcomes(spark, sf_dir, censor="as_dead"):
    history = survival.panel_history(b.check_history(spark, sf_dir), b.check_runs(spark, sf_dir),
                                     censor)
    return survival.agent_outcomes(history, b.history_agents(spark, sf_dir), HORIZONS, TOLERANCE)


_SURVIVAL_SELECT = f"""SELECT horizon_days, {wilson_sql('kk', 'nn')} FROM
    (SELECT h AS horizon_days, count(survived) AS nn, count(*) FILTER (WHERE survived) AS kk
     FROM horizons LEFT JOIN outcomes ON h = horizon_days GROUP BY 1)"""


@query("survival", f"WITH {OUTCOMES_SQL} {_SURVIVAL_SELECT}")
def survival_overall(spark, sf_dir):
    return survival.survival(_outcomes(spark, sf_dir), HORIZONS)


@query("survival_censored_skipped", f"""WITH {OUTCOMES_SQL.replace(
    "JOIN agents USING (agent_id))",
    "JOIN agents USING (agent_id) WHERE failure_category IS NULL)")} {_SURVIVAL_SELECT}""")
def survival_skip(spark, sf_dir):
    return survival.survival(_outcomes(spark, sf_dir, "skip"), HORIZONS)


@query("survival_by_cohort", f"""WITH {OUTCOMES_SQL}
    SELECT horizon_days, month, {wilson_sql('kk', 'nn')} FROM (SELECT horizon_days, month,
        count(*) AS nn, count(*) FILTER (WHERE survived) AS kk FROM outcomes
        WHERE month IS NOT NULL GROUP BY 1, 2)""")
def survival_by_cohort(spark, sf_dir):
    return survival.survival_by_cohort(_outcomes(spark, sf_dir))


_SPAN = "((max(seen_at) - min(seen_at)) / 86400000000.0)"


@query("survival_status", f"""WITH {b.HISTORY_SQL}
    SELECT CASE WHEN {_SPAN} >= 40 THEN 'ok' ELSE 'insufficient_history' END AS status,
        {round_sql(_SPAN, 1)} AS history_span_days,
        greatest(0.0, {round_sql(f'40.0 - {_SPAN}', 1)}) AS days_until_first_horizon,
        count(DISTINCT agent_id) AS agents_with_history FROM history""")
def survival_status(spark, sf_dir):
    history = survival.panel_history(b.check_history(spark, sf_dir), b.check_runs(spark, sf_dir))
    return survival.survival_status(history, b.history_agents(spark, sf_dir), (40, 90)).drop("note")


# --- current state and registry totals --------------------------------------------------

STATE_SQL = f"""{b.EVENT_LOG_SQL},
    ranked AS (SELECT *, row_number() OVER (PARTITION BY agent_id,
            event_type = 'Registered' ORDER BY block_number, log_index) AS reg_no,
        row_number() OVER (PARTITION BY agent_id, event_type IN ('Registered', 'URIUpdated')
            ORDER BY block_number DESC, log_index DESC) AS uri_no,
        row_number() OVER (PARTITION BY agent_id, event_type = 'Transfer'
            ORDER BY block_number DESC, log_index DESC) AS hold_no FROM event_log),
    tally AS (SELECT agent_id, count(*) FILTER (WHERE event_type = 'URIUpdated') AS uri_changes,
        count(*) FILTER (WHERE event_type = 'Transfer'
            AND from_address <> '{b.ZERO_ADDRESS}') AS transfers FROM event_log GROUP BY 1),
    agents AS (SELECT reg.agent_id, coalesce(hold.owner, reg.owner) AS owner,
        reg.owner AS minted_to, CAST(transfers AS INT) AS transfer_count,
        reg.block_number AS registered_block, reg.block_time AS registered_at,
        reg.tx_hash AS registered_tx, coalesce(reg.agent_uri, '') AS uri_at_registration,
        coalesce(uri.agent_uri, '') AS current_uri, uri.block_number AS current_uri_block,
        uri.log_index AS current_uri_log_index, CAST(uri_changes AS INT) AS uri_change_count
        FROM (SELECT * FROM ranked WHERE event_type = 'Registered' AND reg_no = 1) reg
        LEFT JOIN (SELECT * FROM ranked WHERE event_type IN ('Registered', 'URIUpdated')
            AND uri_no = 1) uri USING (agent_id)
        LEFT JOIN (SELECT * FROM ranked WHERE event_type = 'Transfer' AND hold_no = 1) hold
            USING (agent_id)
        LEFT JOIN tally USING (agent_id))"""


def _agents(spark, sf_dir):
    return state.current_state(b.event_log(spark, sf_dir))


@query("agents_current_state", f"WITH {STATE_SQL} SELECT * EXCLUDE (registered_at) FROM agents")
def agents_current_state(spark, sf_dir):
    return _agents(spark, sf_dir).drop("registered_at")


@query("agents_rebuild_touched", f"""WITH {STATE_SQL} SELECT * EXCLUDE (registered_at) FROM agents
    WHERE agent_id IN (SELECT CAST(user_id AS VARCHAR) FROM events WHERE ts >= '2024-01-30')""")
def agents_rebuild_touched(spark, sf_dir):
    log = b.event_log(spark, sf_dir)
    return state.rebuild_touched(log, log.where("block_time >= '2024-01-30'")) \
        .drop("registered_at")


@query("agent_tallies", f"WITH {STATE_SQL} SELECT * FROM tally")
def agent_tallies(spark, sf_dir):
    return state.agent_tallies(b.event_log(spark, sf_dir))


@query("registry_totals", f"""WITH {STATE_SQL} SELECT count(*) AS agents,
    count(DISTINCT owner) AS distinct_owners,
    count(*) FILTER (WHERE current_uri <> '') AS agents_with_uri,
    count(*) FILTER (WHERE uri_at_registration = '') AS empty_uri_at_registration,
    count(*) FILTER (WHERE uri_change_count > 0) AS uri_changed,
    count(*) FILTER (WHERE transfer_count > 0) AS transferred,
    strftime(min(registered_at), '%Y-%m-%d %H:%M:%S') AS first_registration,
    strftime(max(registered_at), '%Y-%m-%d %H:%M:%S') AS last_registration FROM agents""")
def registry_totals(spark, sf_dir):
    shown = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return totals.registry_totals(_agents(spark, sf_dir)).withColumns({
        c: shown(c) for c in ("first_registration", "last_registration")})


@query("uri_churn", f"""WITH {STATE_SQL} SELECT {wilson_sql('kk', 'nn')} FROM (SELECT
    count(*) FILTER (WHERE uri_change_count > 0) AS kk, count(*) AS nn FROM agents)""")
def uri_churn(spark, sf_dir):
    return totals.uri_churn(totals.registry_totals(_agents(spark, sf_dir)))


@query("state_report", f"""WITH {STATE_SQL} SELECT agents, with_uri, uri_changed,
    {round_sql('100.0 * CAST(uri_changed AS DOUBLE) / agents')} AS changed_pct
    FROM (SELECT count(*) AS agents, count(*) FILTER (WHERE current_uri <> '') AS with_uri,
    count(*) FILTER (WHERE uri_change_count > 0) AS uri_changed FROM agents)""")
def state_report(spark, sf_dir):
    from rollcall.functions.text import round_half_up

    return totals.state_report(_agents(spark, sf_dir)) \
        .withColumn("changed_pct", round_half_up(F.col("changed_pct")))


@query("events_by_type", f"""WITH {b.EVENT_LOG_SQL}
    SELECT event_type, count(*) AS n FROM event_log GROUP BY 1""")
def events_by_type(spark, sf_dir):
    return totals.events_by_type(b.event_log(spark, sf_dir))


@query("registrations_monthly", """SELECT month, registered,
    CAST(sum(registered) OVER (ORDER BY month) AS BIGINT) AS cumulative FROM (
        SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS registered
        FROM orders GROUP BY 1)""")
def registrations_monthly(spark, sf_dir):
    return totals.monthly(b.order_checks(spark, sf_dir), F.col("registered_at"))


@query("table_counts", "\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST((SELECT count(*) FROM {t}) AS BIGINT) AS rows, "
    "true AS present" for t in ("events", "orders", "lineitem", "documents", "pages"))
    + "\nUNION ALL SELECT 'absent', CAST(NULL AS BIGINT), false")
def table_counts(spark, sf_dir):
    present = {t: b.table(spark, sf_dir, t)
               for t in ("events", "orders", "lineitem", "documents", "pages")}
    return totals.table_counts({**present, "absent": None})


# --- runs -------------------------------------------------------------------------------

@query("latest_check", f"""WITH {b.HISTORY_SQL} SELECT agent_id, run_id, live AS live_strict, id
    FROM (SELECT *, row_number() OVER (PARTITION BY agent_id ORDER BY seen_at DESC, id DESC) AS rn
    FROM checks) WHERE rn = 1""")
def latest_check(spark, sf_dir):
    return runs.latest_check(b.check_history(spark, sf_dir)
                             .select("agent_id", "run_id", "live_strict", "id", "checked_at")) \
        .drop("checked_at")


@query("latest_run", f"""WITH {b.HISTORY_SQL} SELECT id, kind, status FROM runs
    WHERE kind = 'panel' AND status = 'completed' ORDER BY id DESC LIMIT 1""")
def latest_run(spark, sf_dir):
    return runs.latest_run(b.check_runs(spark, sf_dir), "panel").drop("started_at")


@query("unchecked_agents", f"""WITH {b.HISTORY_SQL}
    SELECT DISTINCT CAST(user_id AS VARCHAR) AS agent_id FROM events WHERE CAST(user_id AS VARCHAR)
        NOT IN (SELECT agent_id FROM checks WHERE run_id = 5)""")
def unchecked_agents(spark, sf_dir):
    everyone = b.table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("agent_id"), F.lit("").alias("current_uri")).distinct()
    return runs.agents_to_check(everyone, True, b.check_history(spark, sf_dir), 5) \
        .select("agent_id")


@query("checks_of_run", """SELECT CAST(o_orderkey AS VARCHAR) AS agent_id,
    CAST(c_custkey AS VARCHAR) AS owner, o_totalprice > 100000 AS live_strict
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE o_orderkey % 4 = 1""")
def checks_of_run(spark, sf_dir):
    """Orders as checks in four runs; the state of their agents comes from another table."""
    checks = b.order_checks(spark, sf_dir).withColumn("run_id", F.col("id") % 4) \
        .drop("owner", "registered_at")
    orders = b.table(spark, sf_dir, "orders")
    customers = b.table(spark, sf_dir, "customer").select("c_custkey")
    agents = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        F.col("o_orderkey").cast("string").alias("agent_id"),
        F.col("c_custkey").cast("string").alias("owner"), F.lit("").alias("uri_root_domain"),
        F.col("o_orderdate").alias("registered_at"), F.lit(0).alias("uri_change_count"),
        (F.col("o_totalprice") > 100000).alias("big"))
    joined = runs.checks_of_run(checks, agents, 1)
    return joined.join(agents.select("agent_id", "big"), "agent_id") \
        .select("agent_id", "owner", F.col("big").alias("live_strict"))


@query("document_changes", f"""WITH {b.HISTORY_SQL},
    seq AS (SELECT agent_id, props, lag(props) OVER (PARTITION BY agent_id ORDER BY seen_at, id) AS before
        FROM checks)
    SELECT agent_id, count(*) AS documents,
        count(*) FILTER (WHERE before IS NOT NULL AND before <> props) AS changes
    FROM seq GROUP BY 1""")
def document_changes(spark, sf_dir):
    return runs.document_changes(b.check_history(spark, sf_dir))


@query("run_ledger", f"""WITH {b.HISTORY_SQL} SELECT runs.id AS id, 'completed' AS status,
    CAST(count(checks.agent_id) AS BIGINT) AS agents_checked,
    'daily | ' || count(checks.agent_id) || ' checked' AS notes
    FROM runs JOIN checks ON run_id = runs.id GROUP BY runs.id""")
def run_ledger(spark, sf_dir):
    checks, opened = b.check_history(spark, sf_dir), b.check_runs(spark, sf_dir)
    opened = runs.open_run(opened.select("id", "started_at", F.lit("daily").alias("notes")),
                           "panel", F.col("started_at"))
    counts = checks.groupBy("run_id").agg(F.count(F.lit(1)).alias("agents_checked")) \
        .withColumnRenamed("run_id", "id")
    note = F.concat(F.col("_checked").cast("string"), F.lit(" checked"))
    closed = runs.close_run(opened, counts, "completed", note, F.current_timestamp())
    return closed.select("id", "status", "agents_checked", "notes")


# --- projects and owners ----------------------------------------------------------------

@query("project_components", f"""WITH RECURSIVE {b.PROJECTS_SQL}
    SELECT agent_id, min(agent_id) OVER (PARTITION BY project) AS first_agent,
        count(*) OVER (PARTITION BY project) AS agents FROM projects""")
def project_components(spark, sf_dir):
    rows = projects.with_project(funnel.analysed(b.check_table(spark, sf_dir))) \
        .select("agent_id", "project")
    names = projects.project_names(rows)
    return rows.join(names, "project") \
        .select("agent_id", "first_agent", "agents")


@query("project_increment", f"""WITH RECURSIVE {b.PROJECTS_SQL}
    SELECT agent_id, min(agent_id) OVER (PARTITION BY project) AS first_agent,
        count(*) OVER (PARTITION BY project) AS agents FROM projects""")
def project_increment(spark, sf_dir):
    """The same projects, from stored labels of most agents and what the others add to them."""
    checks = materialise(funnel.analysed(b.document_checks(spark, sf_dir)).select(
        "agent_id", "owner", "uri_root_domain"), "checks")
    late = F.pmod(F.xxhash64("agent_id"), F.lit(20)) == 0
    known = materialise(projects.project_labels(checks.where(~late)), "labels")
    rows = materialise(projects.with_project(checks, projects.project_labels(
        checks.where(late), known)).select("agent_id", "project"), "projects")
    return rows.join(projects.project_names(rows), "project") \
        .select("agent_id", "first_agent", "agents")


@query("top_projects", f"""WITH RECURSIVE {b.PROJECTS_SQL},
    grouped AS (SELECT project, count(*) AS agents,
        count(DISTINCT nullif(lower(owner), '')) AS owners,
        list_sort(list(DISTINCT uri_root_domain) FILTER (WHERE uri_root_domain <> 'ipfs.io')) AS own,
        bool_or(uri_root_domain = 'ipfs.io') AS hosted, min(agent_id) AS first_agent,
        count(*) FILTER (WHERE live_strict) AS live_agents FROM projects GROUP BY 1)
    SELECT agents, owners, coalesce(array_to_string(own[1:5], ' '), '') AS domains,
        CASE WHEN hosted THEN 'ipfs.io' ELSE '' END AS hosted_on, live_agents,
        CASE WHEN len(own) > 0 THEN own[1] WHEN hosted THEN owners || ' wallet(s) on ipfs.io'
            ELSE owners || ' wallet(s), no domain' END AS label, first_agent
    FROM grouped ORDER BY agents DESC, first_agent LIMIT 20""")
def top_projects(spark, sf_dir):
    rows = projects.with_project(funnel.analysed(b.check_table(spark, sf_dir)))
    return projects.top_projects(rows, 20).withColumns({
        "domains": F.array_join("domains", " "), "hosted_on": F.array_join("hosted_on", " ")})


@query("shared_hosting_signature", f"""WITH {b.DOCUMENT_CHECKS_SQL}
    SELECT uri_root_domain AS domain, count(*) AS agents,
        count(DISTINCT nullif(lower(owner), '')) AS owners,
        count(DISTINCT nullif(lower(owner), '')) / CAST(count(*) AS DOUBLE) AS owners_per_agent
    FROM document_checks WHERE uri_root_domain <> '' GROUP BY 1""")
def shared_hosting_signature(spark, sf_dir):
    return projects.shared_hosting_signature(b.document_checks(spark, sf_dir))


@query("owner_gini", f"""WITH {b.ORDER_CHECKS_SQL},
    sizes AS (SELECT lower(owner) AS o, count(*) AS x FROM order_checks WHERE owner <> '' GROUP BY 1),
    ranked AS (SELECT x, row_number() OVER (ORDER BY x) AS i FROM sizes)
    SELECT count(*) AS owners, CAST(sum(x) AS BIGINT) AS agents,
        {round_sql('2.0 * sum(CAST(i AS DOUBLE) * x) / (count(*) * CAST(sum(x) AS DOUBLE))'
                   ' - (count(*) + 1) / CAST(count(*) AS DOUBLE)', 6)} AS gini FROM ranked""")
def owner_gini(spark, sf_dir):
    from rollcall.functions.text import round_half_up

    return ownership.owner_gini(b.order_checks(spark, sf_dir)) \
        .withColumn("gini", round_half_up(F.col("gini"), 6))
