"""One probe run from the crawler's tables to stored checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.operators import runs, verdict
from rollcall.sources import tables


def targets_of(agents: DataFrame, run_id: int, checked_at: Column, everything: bool = False,
               stored: DataFrame | None = None, limit: int = 0) -> DataFrame:
    """
    Both passes of everyone the run still has to check.

    A run that was interrupted leaves out who is stored already. The second pass is listed for
    all of them; without attempts recorded for it, it is not graded.
    """
    chosen = runs.agents_to_check(agents, everything, stored, run_id, limit)
    return chosen.select(
        F.lit(run_id).cast("bigint").alias("run_id"), "agent_id",
        F.explode(F.array(F.lit(1), F.lit(2))).alias("pass"),
        F.col("current_uri").alias("uri"), checked_at.alias("checked_at"))


def grade_run(targets: DataFrame, fetches: DataFrame, probes: DataFrame,
              exact_json: bool = False) -> DataFrame:
    """
    One check per agent: the normal pass, replaced by the slow one where that was taken.

    The slow pass was taken for an agent if the crawler recorded any request in it.
    """
    slow = fetches.where("pass = 2").select("run_id", "agent_id") \
        .unionByName(probes.where("pass = 2").select("run_id", "agent_id")).distinct()
    second = targets.where("pass = 2").join(slow, ["run_id", "agent_id"], "left_semi")
    taken = targets.where("pass = 1").unionByName(second)
    return verdict.reconcile(verdict.grade(taken, fetches, probes, exact_json))


def store_run(checks: DataFrame, path: str) -> DataFrame:
    """
    Append the checks to the history, one directory per run; the first row of an agent stays.
    """
    kept = checks.drop("retried", "uri_host", "uri_root_domain")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return tables.append_checks(kept, path, schema)
