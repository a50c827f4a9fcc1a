"""Idempotent writes expressed as joins: the first row of a key wins, or the last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

LOG_KEY = ("tx_hash", "log_index")
CHECK_KEY = ("run_id", "agent_id")


def first_of_each(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key. Rows with equal keys are copies of one log, so any of them will do."""
    return rows.dropDuplicates(list(keys))


def new_rows(incoming: DataFrame, existing: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is neither stored already nor repeated within the batch."""
    fresh = first_of_each(incoming, keys)
    if existing is None:
        return fresh
    return fresh.join(existing.select(*keys), list(keys), "left_anti")


def replace_rows(first_pass: DataFrame, second_pass: DataFrame,
                 keys: Sequence[str] = CHECK_KEY) -> DataFrame:
    """The second pass overrides the first wherever it has a row."""
    kept = first_pass.join(second_pass.select(*keys), list(keys), "left_anti")
    return kept.unionByName(first_of_each(second_pass, keys))


def append_counters(incoming: DataFrame, fresh: DataFrame) -> DataFrame:
    """
    One row of ingest counters: events seen, new, already known, agents touched, sanitized.
    """
    seen = incoming.agg(F.count(F.lit(1)).alias("events"),
                        F.count_if("sanitized").alias("sanitized"),
                        F.countDistinct("agent_id").alias("agents"))
    added = fresh.agg(F.count(F.lit(1)).alias("inserted"))
    inserted = added.scalar()
    return seen.select(
        "events", inserted.alias("inserted"), (F.col("events") - inserted).alias("already_known"),
        "agents", "sanitized")
