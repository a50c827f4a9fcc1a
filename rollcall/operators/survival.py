"""Cohorts in one run, and survival over the history of runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from rollcall.constants import SURVIVAL_HORIZONS_DAYS, SURVIVAL_NOTE, \
    SURVIVAL_TOLERANCE_DAYS
from rollcall.functions.stats import wilson_columns
from rollcall.functions.text import month
from rollcall.operators.funnel import is_censored

DAY = 86_400_000_000  # microseconds


def cohorts(checks: DataFrame) -> DataFrame:
    """Strict liveness by registration month within one run."""
    counts = checks.where("registered_at IS NOT NULL") \
        .groupBy(month(F.col("registered_at")).alias("month")) \
        .agg(F.count_if("live_strict").alias("_k"), F.count(F.lit(1)).alias("_n"))
    return counts.select("month", *wilson_columns(F.col("_k"), F.col("_n")))


def panel_history(checks: DataFrame, runs: DataFrame, censor: str = "as_dead") -> DataFrame:
    """
    (agent_id, at, live) of the completed panel runs.

    censor="as_dead" counts a check that was not measured as not live, as the published
    figures do; censor="skip" leaves such checks out.
    """
    usable = runs.where("kind = 'panel' AND status = 'completed'").select(
        F.col("id").alias("run_id"))
    history = checks.join(usable, "run_id", "left_semi")
    if censor == "skip":
        history = history.where(~is_censored(F.col("failure_category")))
    elif censor != "as_dead":
        raise ValueError(f"unknown censoring rule {censor!r}")
    return history.select("agent_id", F.unix_micros("checked_at").alias("at"),
                          F.col("live_strict").alias("live"))


def agent_outcomes(history: DataFrame, agents: DataFrame,
                   horizons: Sequence[int] = SURVIVAL_HORIZONS_DAYS,
                   tolerance_days: int = SURVIVAL_TOLERANCE_DAYS) -> DataFrame:
    """
    (agent_id, horizon_days, survived, month): the verdict of each agent that has one.

    The anchor is the agent's first live check. For a horizon the nearest check counts, if it
    lies after the anchor and between tolerance days before the target and less than
    tolerance + 1 days after it: days are whole days rounded down, so the window is not
    symmetric. Among equally near checks the earlier wins, then a dead one.

    Nearness, side and verdict are packed into one number, so the choice is a plain minimum
    that is taken before the shuffle. A check makes a row for each horizon that it lies near and for no
    other, however many are asked for. The join with the anchors, one row per agent, is split by the
    adaptive planner where an agent has very many checks.
    """
    anchors = history.groupBy("agent_id").agg(
        F.min(F.when(F.col("live"), F.col("at"))).alias("anchor")).where("anchor IS NOT NULL")
    age = F.col("at") - F.col("anchor")
    near = F.filter(F.array(*[F.lit(h) for h in horizons]),
                    lambda h: (age - h * F.lit(DAY) >= -tolerance_days * DAY)
                    & (age - h * F.lit(DAY) < (tolerance_days + 1) * DAY))
    offset = age - F.col("horizon_days") * F.lit(DAY)
    packed = F.abs(offset) * 4 + F.when(offset > 0, 2).otherwise(0) \
        + F.when(F.col("live"), 1).otherwise(0)
    nearest = history.join(anchors, "agent_id").where(F.col("at") > F.col("anchor")) \
        .withColumn("horizon_days", F.explode(near)) \
        .groupBy("agent_id", "horizon_days").agg(F.min(packed).alias("_best"))
    known = agents.select("agent_id", month(F.col("registered_at")).alias("month"))
    return nearest.join(known, "agent_id").select(
        "agent_id", "horizon_days", (F.col("_best") % 2 == 1).alias("survived"), "month")


def survival(outcomes: DataFrame, horizons: Sequence[int] = SURVIVAL_HORIZONS_DAYS) -> DataFrame:
    """One row per horizon, also for horizons nobody has reached yet."""
    counts = outcomes.groupBy("horizon_days").agg(
        F.count_if("survived").alias("_k"), F.count(F.lit(1)).alias("_n"))
    wanted = outcomes.sparkSession.range(1).select(
        F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon_days"))
    zero = F.lit(0)
    return wanted.join(counts, "horizon_days", "left").select(
        "horizon_days", *wilson_columns(F.coalesce("_k", zero), F.coalesce("_n", zero)))


def survival_by_cohort(outcomes: DataFrame) -> DataFrame:
    counts = outcomes.where("month IS NOT NULL").groupBy("horizon_days", "month").agg(
        F.count_if("survived").alias("_k"), F.count(F.lit(1)).alias("_n"))
    return counts.select("horizon_days", "month", *wilson_columns(F.col("_k"), F.col("_n")))


def survival_status(history: DataFrame, agents: DataFrame,
                    horizons: Sequence[int] = SURVIVAL_HORIZONS_DAYS) -> DataFrame:
    """How much history there is, and how long until the first horizon can be judged."""
    first_horizon = float(min(horizons))
    per_agent = history.groupBy("agent_id").agg(F.min("at").alias("_first"),
                                                F.max("at").alias("_last"))
    totals = per_agent.join(agents.select("agent_id"), "agent_id", "left_semi").agg(
        F.coalesce((F.max("_last") - F.min("_first")) / F.lit(float(DAY)), F.lit(0.0))
        .alias("_span"), F.count(F.lit(1)).alias("agents_with_history"))
    one_digit = lambda c: F.floor(c * 10 + F.lit(0.5)) / F.lit(10.0)
    enough = F.col("_span") >= first_horizon
    span_text = F.format_string("%.1f", one_digit(F.col("_span")))
    note = F.format_string(SURVIVAL_NOTE.format(days=min(horizons), span="%s"), span_text)
    return totals.select(
        F.when(enough, "ok").otherwise("insufficient_history").alias("status"),
        one_digit(F.col("_span")).alias("history_span_days"),
        F.greatest(F.lit(0.0), one_digit(F.lit(first_horizon) - F.col("_span")))
        .alias("days_until_first_horizon"),
        "agents_with_history", F.when(~enough, note).alias("note"))
