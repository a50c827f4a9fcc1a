"""From a run's checks to the published documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.constants import CENSORED_NOTE, DATA_LICENSE, REGISTRY_CHAIN, REGISTRY_CHAIN_ID, \
    REGISTRY_CONTRACT, STAGES, SURVIVAL_HORIZONS_DAYS, SURVIVAL_TOLERANCE_DAYS
from rollcall.functions.stats import wilson
from rollcall.functions.text import iso
from rollcall.operators import funnel, projects, runs, survival, totals
from rollcall.schemas import PROGRESS
from rollcall.session import materialise
from rollcall.sources.jsondocs import DOCUMENTS


def headline_figures(registry: DataFrame, by_agent: DataFrame, by_owner: DataFrame) -> DataFrame:
    """The number the page exists for: final-stage share per agent and per owner."""
    last = F.col("stage_no") == len(STAGES)
    owner = by_owner.where(last).select("pct")
    agent = by_agent.where(last).select("pct")
    return registry.select(F.col("agents").alias("registered"),
                           agent.scalar().alias("agent_pct"), owner.scalar().alias("owner_pct"))


def three_denominators(by_agent: DataFrame, by_owner: DataFrame,
                       by_project: DataFrame) -> DataFrame:
    return funnel.final_stage(by_agent, "per agent") \
        .unionByName(funnel.final_stage(by_owner, "per owner")) \
        .unionByName(funnel.final_stage(by_project, "per project"))


def _packed(order: list[Column], *columns: str) -> Column:
    keyed = F.struct(F.struct(*order).alias("k"), F.struct(*columns).alias("v"))
    return F.transform(F.array_sort(F.collect_list(keyed)), lambda s: s["v"])


def _rows(df: DataFrame, order: list[Column], *columns: str) -> Column:
    """
    A small result as one array value.

    Only finished aggregates come here: seven stages, a few dozen categories, the top twenty.
    """
    return df.agg(_packed(order, *columns).alias("a")).scalar()


def _funnel_value(stages: DataFrame) -> Column:
    """The stages and their total in one value, so a funnel is counted once."""
    named = stages.withColumnRenamed("stage", "key")
    both = named.agg(F.max("n").alias("denominator"), _packed(
        [F.col("stage_no")], "key", "label", "n", "k", "pct", "ci_low", "ci_high",
        "pct_of_previous").alias("stages"))
    return _single(both, "denominator", "stages")


def _failures_value(checks: DataFrame) -> Column:
    return _rows(funnel.failure_breakdown(checks), [-F.col("n"), F.col("category")],
                 "category", "n", "pct")


def _single(df: DataFrame, *columns: str) -> Column:
    return df.select(F.struct(*columns)).scalar()


def summary(agents: DataFrame, events: DataFrame, checks: DataFrame, check_runs: DataFrame,
            progress: DataFrame | None, generated_at: Column, run_id: int | None = None,
            horizons=SURVIVAL_HORIZONS_DAYS, tolerance_days: int = SURVIVAL_TOLERANCE_DAYS,
            limit: int = 20) -> DataFrame:
    """
    The aggregate document as one row: registry, registrations_monthly, liveness, survival.

    The rows of the run are written once and read by every figure; each figure is a scalar
    subquery, so nothing but finished aggregates meets in the one row. The driver plans the figures
    of liveness and the others one after the other.
    """
    spark = agents.sparkSession
    run = check_runs.where(F.col("id") == run_id) if run_id is not None \
        else runs.latest_run(check_runs)
    chosen = run.select("id").scalar()
    rows = materialise(runs.checks_of_run(checks, agents, chosen), "run")
    measured = funnel.analysed(rows)
    skipped = funnel.censored(rows)
    grouped = materialise(projects.with_project(measured), "projects")
    by_project = funnel.group_funnel(grouped, F.col("project"))

    registry = totals.registry_totals(agents)
    per_type = F.map_from_entries(_rows(totals.events_by_type(events),
                                        [-F.col("n"), F.col("event_type")], "event_type", "n"))
    progress = spark.createDataFrame([], PROGRESS) if progress is None else progress
    tried = F.struct("batch_id", "run_at")
    state = progress.agg(
        F.max(F.when(F.col("status") == "ok", F.col("last_block"))).alias("last_block"),
        F.max("run_at").alias("run_at"), F.max_by("status", tried).alias("status"),
        F.max_by("error", tried).alias("error"))
    indexed = _single(state.withColumn("run_at", iso(F.col("run_at"))),
                      "last_block", "run_at", "status", "error")
    registry_value = registry.select(F.struct(
        F.lit(REGISTRY_CHAIN_ID).alias("chain_id"), F.lit(REGISTRY_CHAIN).alias("chain"),
        F.lit(REGISTRY_CONTRACT).alias("contract"), "agents", "distinct_owners",
        "agents_with_uri", "empty_uri_at_registration",
        wilson(F.col("uri_changed"), F.col("agents")).alias("uri_changed_after_registration"),
        "transferred", iso(F.col("first_registration")).alias("first_registration"),
        iso(F.col("last_registration")).alias("last_registration"), per_type.alias("events"),
        indexed["last_block"].alias("indexed_through_block"),
        indexed["run_at"].alias("indexer_last_run"),
        indexed["status"].alias("indexer_last_status"),
        indexed["error"].alias("indexer_last_error"))).scalar()
    monthly = _rows(totals.monthly(agents, F.col("registered_at")), [F.col("month")],
                    "month", "registered", "cumulative")

    run_columns = ["id", "kind", "started_at", "finished_at", "agents_checked", "concurrency",
                   "timeout_seconds", "prober_version"]
    shown = {"started_at": iso(F.col("started_at")), "finished_at": iso(F.col("finished_at")),
             "timeout_seconds": F.col("timeout_seconds").cast("double")}
    run_value = _single(run.withColumns(shown), *run_columns)
    skipped_count = skipped.agg(F.count(F.lit(1))).scalar()
    top = projects.top_projects(grouped, limit)
    liveness = F.struct(
        F.lit("ok").alias("status"), run_value.alias("run"),
        F.struct(skipped_count.alias("n"), F.lit(CENSORED_NOTE).alias("note"),
                 _failures_value(skipped).alias("by_category")).alias("censored"),
        _funnel_value(funnel.agent_funnel(measured)).alias("by_agent"),
        _funnel_value(funnel.owner_funnel(measured)).alias("by_owner"),
        _funnel_value(by_project).alias("by_project"),
        _single(funnel.generic_only_share(measured), "n", "k", "pct", "ci_low", "ci_high")
        .alias("generic_hosts_only"),
        _single(funnel.endpoint_totals(measured), "declared", "responding",
                "responding_specific").alias("endpoints"),
        _failures_value(measured).alias("failures"),
        _rows(survival.cohorts(measured), [F.col("month")], "month", "n", "k", "pct", "ci_low",
              "ci_high").alias("cohorts_cross_sectional"),
        _rows(top, [-F.col("agents"), F.col("first_agent")], "agents", "owners", "domains",
              "hosted_on", "live_agents", "label").alias("top_projects"))
    # Without a completed run there is nothing to say about liveness but that.
    liveness_value = F.when(chosen.isNotNull(), liveness).otherwise(
        F.struct(F.lit("no_completed_runs").alias("status"),
                 *[F.lit(None).alias(f) for f in (
                     "run", "censored", "by_agent", "by_owner", "by_project",
                     "generic_hosts_only", "endpoints", "failures", "cohorts_cross_sectional",
                     "top_projects")]))
    # Its figures are half of all; written by themselves, fewer subqueries run and are held at once.
    liveness_row = materialise(spark.range(1).select(liveness_value.alias("liveness")), "liveness")

    history = survival.panel_history(checks, check_runs)
    outcomes = materialise(survival.agent_outcomes(history, agents, horizons, tolerance_days),
                           "outcomes")
    cohorts = survival.survival_by_cohort(outcomes).groupBy("horizon_days").agg(F.array_sort(
        F.collect_list(F.struct("month", "n", "k", "pct", "ci_low", "ci_high")))
        .alias("by_cohort"))
    by_horizon = survival.survival(outcomes, horizons).join(cohorts, "horizon_days", "left") \
        .withColumn("by_cohort", F.coalesce("by_cohort", F.array().cast(
            cohorts.schema["by_cohort"].dataType)))
    horizon_rows = _rows(by_horizon, [F.col("horizon_days")], "horizon_days", "n", "k", "pct",
                         "ci_low", "ci_high", "by_cohort")
    status = survival.survival_status(history, agents, horizons).select(F.struct(
        "status", "history_span_days", "days_until_first_horizon", "agents_with_history",
        "note")).scalar()
    return liveness_row.select(
        iso(generated_at).alias("generated_at"), registry_value.alias("registry"),
        monthly.alias("registrations_monthly"), F.col("liveness"),
        status.alias("_status"), horizon_rows.alias("_horizons")).select(
        "generated_at", "registry", "registrations_monthly", "liveness",
        F.struct("_status.status", "_status.history_span_days",
                 "_status.days_until_first_horizon", "_status.agents_with_history",
                 F.col("_horizons").alias("horizons"), "_status.note").alias("survival"))


def documents(summary_row: DataFrame, source: str = "") -> DataFrame:
    """
    The seven published documents as (name, json), NULL fields kept.

    The summary is written first, so its many subqueries run once and not once per document.
    """
    row = materialise(summary_row, "summary")
    c = F.col
    src, licence = F.lit(source).alias("source"), F.lit(DATA_LICENSE).alias("license")
    contents = {
        "summary.json": F.struct("generated_at", "registry", "registrations_monthly",
                                 "liveness", "survival"),
        "meta.json": F.struct(
            c("generated_at"), c("registry.chain"), c("registry.chain_id"),
            c("registry.contract"), c("registry.indexed_through_block"),
            c("registry.indexer_last_run"), c("liveness.run").alias("probe_run"), src, licence),
        "registrations.json": F.struct(c("generated_at"),
                                       c("registrations_monthly").alias("monthly"),
                                       c("registry").alias("totals")),
        "funnel.json": F.struct(
            "generated_at", "liveness.run", "liveness.by_agent", "liveness.by_owner",
            "liveness.by_project", "liveness.generic_hosts_only", "liveness.endpoints",
            "liveness.censored", "liveness.failures"),
        "survival.json": F.struct("generated_at", "survival",
                                  "liveness.cohorts_cross_sectional"),
        "projects.json": F.struct("generated_at", "liveness.top_projects"),
        "index.json": F.struct(F.array(*[F.lit(n) for n in DOCUMENTS[:-1]]).alias("endpoints"),
                               src, licence),
    }
    entries = F.array(*[F.struct(F.lit(name).alias("name"),
                                 F.to_json(value, {"ignoreNullFields": "false"}).alias("json"))
                        for name, value in contents.items()])
    return row.select(F.inline(entries))
