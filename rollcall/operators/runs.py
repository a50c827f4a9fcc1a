"""Probe runs and who is checked in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_check(checks: DataFrame) -> DataFrame:
    """
    The most recent check of each agent.

    max_by rather than a window: it is aggregated before the shuffle, so an agent with a long
    history sends one row per input partition.
    """
    columns = [c for c in checks.columns if c != "agent_id"]
    return checks.groupBy("agent_id").agg(
        F.max_by(F.struct(*columns), F.struct("checked_at", "id")).alias("_last")) \
        .select("agent_id", *[F.col(f"_last.{c}").alias(c) for c in columns])


def latest_run(runs: DataFrame, kind: str | None = None) -> DataFrame:
    """The completed run that started last, of one kind if given."""
    done = runs.where("status = 'completed'")
    if kind is not None:
        done = done.where(F.col("kind") == kind)
    return done.orderBy(F.col("started_at").desc(), F.col("id").desc()).limit(1)


def open_run(spark_rows: DataFrame, kind: str, started_at: Column) -> DataFrame:
    """Run rows (id, settings, agents_planned) as they stand when probing starts."""
    return spark_rows.withColumns({
        "kind": F.lit(kind), "status": F.lit("running"), "started_at": started_at,
        "finished_at": F.lit(None).cast("timestamp"),
        "agents_checked": F.lit(None).cast("int"),
    })


def close_run(runs: DataFrame, checked: DataFrame, status: str, note: Column,
              finished_at: Column) -> DataFrame:
    """
    Close the runs that `checked` (id, agents_checked) has counts for.

    The note is cut at 500 characters and appended to what is there, after a bar.
    """
    closing = F.col("_checked").isNotNull()
    counts = checked.select("id", F.col("agents_checked").alias("_checked"))
    return runs.join(counts, "id", "left").withColumns({
        "status": F.when(closing, F.lit(status)).otherwise(F.col("status")),
        "finished_at": F.when(closing, finished_at).otherwise(F.col("finished_at")),
        "agents_checked": F.when(closing, F.col("_checked")).otherwise(F.col("agents_checked")),
        "notes": F.when(closing, F.concat_ws(" | ", "notes", F.substring(note, 1, 500)))
        .otherwise(F.col("notes")),
    }).drop("_checked")


def agents_to_check(agents: DataFrame, everything: bool = False, checks: DataFrame | None = None,
                    run_id: int | None = None, limit: int = 0) -> DataFrame:
    """
    The panel, or everyone, minus those the run has a row for already.

    A limit takes the first agents in numeric order of their ids.
    """
    chosen = agents if everything else agents.where("in_panel")
    if checks is not None:
        done = checks if run_id is None else checks.where(F.col("run_id") == run_id)
        chosen = chosen.join(done.select("agent_id"), "agent_id", "left_anti")
    if limit:
        chosen = chosen.orderBy(F.char_length("agent_id"), "agent_id").limit(limit)
    return chosen.select("agent_id", "current_uri")


def checks_of_run(checks: DataFrame, agents: DataFrame, run_id: Column | int) -> DataFrame:
    """The rows every published figure of a run is computed from."""
    columns = ["agent_id", "s1_uri_present", "s2_resolved", "s3_valid_json", "s4_schema_match",
               "s5_has_services", "s6_endpoint_alive", "live_strict", "generic_only",
               "failure_category", "endpoints_total", "endpoints_ok", "endpoints_ok_specific"]
    state = agents.select("agent_id", "owner", "uri_root_domain", "registered_at",
                          "uri_change_count")
    return checks.where(F.col("run_id") == run_id).select(*columns).join(state, "agent_id")


def document_changes(checks: DataFrame) -> DataFrame:
    """
    How often each agent's document differs from the one before it.

    An agent has one check a run, so its window is as long as the list of runs.
    """
    narrow = checks.where("doc_sha256 IS NOT NULL").select("agent_id", "checked_at", "id",
                                                           "doc_sha256")
    in_time = Window.partitionBy("agent_id").orderBy("checked_at", "id")
    changed = F.lag("doc_sha256").over(in_time) != F.col("doc_sha256")
    return narrow.withColumn("_changed", changed).groupBy("agent_id").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if("_changed").alias("changes"))
