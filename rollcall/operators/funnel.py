"""Staged funnels: per agent, per group, with censoring and failure breakdowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.constants import CENSORED_CATEGORIES, STAGES
from rollcall.functions.stats import percent, share_of_previous, wilson_columns


def is_censored(category: Column) -> Column:
    """
    Not measured, as opposed to measured and dead. A live agent has no category at all, so a
    missing one must count as measured.
    """
    return F.coalesce(category, F.lit("")).isin(*CENSORED_CATEGORIES)


def analysed(checks: DataFrame) -> DataFrame:
    return checks.where(~is_censored(F.col("failure_category")))


def censored(checks: DataFrame) -> DataFrame:
    return checks.where(is_censored(F.col("failure_category")))


def _stage_rows(counts: DataFrame) -> DataFrame:
    """
    One row of counts (total, one column per stage) to one row per stage.

    The count before each stage sits in the same row, so the ratio needs no window.
    """
    entries, previous = [], F.col("total")
    for number, (key, label) in enumerate(STAGES, start=1):
        entries.append(F.struct(
            F.lit(number).alias("stage_no"), F.lit(key).alias("stage"),
            F.lit(label).alias("label"), F.col(key).alias("reached"),
            previous.alias("previous"), F.col("total")))
        previous = F.col(key)
    rows = counts.select(F.inline(F.array(*entries)))
    n, k, pct, low, high = wilson_columns(F.col("reached"), F.col("total"))
    return rows.select("stage_no", "stage", "label", n, k, pct, low, high,
                       share_of_previous(F.col("reached"), F.col("previous"))
                       .alias("pct_of_previous"))


def agent_funnel(checks: DataFrame) -> DataFrame:
    """Seven rows: how many agents reach each stage. One aggregation over the checks."""
    counts = checks.agg(F.count(F.lit(1)).alias("total"),
                        *[F.count_if(key).alias(key) for key, _ in STAGES])
    return _stage_rows(counts)


def group_funnel(checks: DataFrame, group: Column) -> DataFrame:
    """
    A group reaches a stage if any of its agents does; rows without a group are left out.

    The flags of a group are folded together before the shuffle, so a group that owns a third
    of all agents sends one row per input partition.
    """
    grouped = checks.select(group.alias("_group"), *[key for key, _ in STAGES]) \
        .where("_group IS NOT NULL").groupBy("_group") \
        .agg(*[F.bool_or(key).alias(key) for key, _ in STAGES])
    counts = grouped.agg(F.count(F.lit(1)).alias("total"),
                         *[F.count_if(key).alias(key) for key, _ in STAGES])
    return _stage_rows(counts)


def owner_key(owner: Column) -> Column:
    return F.nullif(F.lower(F.coalesce(owner, F.lit(""))), F.lit(""))


def owner_funnel(checks: DataFrame) -> DataFrame:
    return group_funnel(checks, owner_key(F.col("owner")))


def final_stage(funnel: DataFrame, counted: str) -> DataFrame:
    """The last stage of a funnel, named after what was counted."""
    return funnel.where(F.col("stage_no") == len(STAGES)).select(
        F.lit(counted).alias("counted"), F.col("k").alias("live"), F.col("n").alias("of"),
        "pct", "ci_low", "ci_high")


def failure_breakdown(checks: DataFrame) -> DataFrame:
    """
    Failures by category, as a share of all rows passed in, live ones too.

    The total is summed over the grouped rows, a few dozen, not over the checks again.
    Equal counts are ordered by name.
    """
    counts = checks.groupBy(F.nullif(F.col("failure_category"), F.lit("")).alias("category")) \
        .agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return counts.withColumn("_total", total).where("category IS NOT NULL") \
        .select("category", "n", percent(F.col("n"), F.col("_total")).alias("pct")) \
        .orderBy(F.col("n").desc(), "category")


def generic_only_share(checks: DataFrame) -> DataFrame:
    counts = checks.agg(F.count_if("generic_only").alias("_k"), F.count(F.lit(1)).alias("_n"))
    return counts.select(*wilson_columns(F.col("_k"), F.col("_n")))


def endpoint_totals(checks: DataFrame) -> DataFrame:
    zero = F.lit(0).cast("bigint")
    total = lambda c: F.coalesce(F.sum(F.coalesce(F.col(c), F.lit(0)).cast("bigint")), zero)
    return checks.agg(total("endpoints_total").alias("declared"),
                      total("endpoints_ok").alias("responding"),
                      total("endpoints_ok_specific").alias("responding_specific"))


def run_summary(checks: DataFrame) -> DataFrame:
    """
    A run read back from what was stored: a row per stage over the measured agents, then the
    generic-only and not-measured counts. Shares are NULL where nothing was measured before.
    """
    measured = ~is_censored(F.col("failure_category"))
    counts = checks.agg(
        F.count_if(measured).alias("registered"),
        *[F.count_if(measured & F.col(key)).alias(key) for key, _ in STAGES],
        F.count_if(measured & F.col("generic_only")).alias("generic_only"),
        F.count_if(~measured).alias("not_measured"))
    names = ["registered", *[key for key, _ in STAGES], "generic_only", "not_measured"]
    entries = []
    for number, name in enumerate(names):
        in_chain = 0 < number <= len(STAGES)
        of_measured = F.lit(None).cast("double") if name == "not_measured" \
            else F.coalesce(percent(F.col(name), F.col("registered")), F.lit(0.0))
        entries.append(F.struct(
            F.lit(number).alias("row_no"), F.lit(name).alias("item"), F.col(name).alias("count"),
            of_measured.alias("pct_of_measured"),
            (percent(F.col(name), F.col(names[number - 1])) if in_chain
             else F.lit(None).cast("double")).alias("pct_of_previous")))
    return counts.select(F.inline(F.array(*entries)))


def stage_histogram(checks: DataFrame) -> DataFrame:
    """Probe progress: how many checks ended at each stage, and how many of them are live."""
    return checks.groupBy("funnel_stage").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if("live_strict").alias("live"),
        F.count_if("generic_only").alias("generic_only"))
