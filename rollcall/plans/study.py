"""The one-off study: registrations to sample, resolution, verdict and funnel."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.constants import STUDY_STAGES
from rollcall.functions.stats import percent, wilson_bounds
from rollcall.functions.text import strip, truthy


def with_times(registrations: DataFrame, blocks: DataFrame) -> DataFrame:
    """Unix time and ISO text per registration; both stay empty for unknown blocks."""
    known = blocks.select("block_number", F.unix_seconds("block_time").alias("timestamp"))
    return registrations.join(known, "block_number", "left").withColumn(
        "datetime_utc", F.coalesce(F.date_format(
            F.timestamp_seconds("timestamp"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("")))


def with_current_uris(registrations: DataFrame, current: DataFrame) -> DataFrame:
    """
    The URI now, and whether it changed. An agent whose URI could not be asked has none and
    has not changed.
    """
    known = current.select("agent_id", F.col("uri").alias("agent_uri_current"))
    return registrations.join(known, "agent_id", "left").withColumn(
        "uri_changed_after_registration",
        F.coalesce(F.col("agent_uri_current") != F.col("agent_uri_at_registration"),
                   F.lit(False)))


def resolve(sample: DataFrame, answers: DataFrame) -> DataFrame:
    """
    Add the current URI to a sample, keeping apart "empty" and "could not be determined".

    Answers are (agent_id, uri); a missing or NULL answer is unresolved. Texts are compared
    without surrounding blanks.
    """
    at_start = strip(F.coalesce("agent_uri_at_registration", F.lit("")))
    joined = sample.join(answers.select("agent_id", F.col("uri").alias("_now")), "agent_id",
                         "left")
    now = strip(F.col("_now"))
    resolved = F.col("_now").isNotNull()
    return joined.withColumns({
        "agent_uri_current": F.coalesce(now, F.lit("")),
        "resolve_status": F.when(resolved, "ok").otherwise("unresolved"),
        "uri_changed_after_registration": F.when(
            resolved, F.when(now != at_start, "true").otherwise("false")).otherwise(""),
    }).drop("_now")


def resolution_summary(resolved: DataFrame) -> DataFrame:
    """Shares of empty and changed URIs; the last two are over resolved agents only."""
    ok = F.col("resolve_status") == "ok"
    counts = resolved.agg(
        F.count(F.lit(1)).alias("agents"),
        F.count_if(~ok).alias("unresolved"),
        F.count_if(strip(F.coalesce("agent_uri_at_registration", F.lit(""))) == "")
        .alias("empty_at_registration"),
        F.count_if(ok & (F.col("agent_uri_current") == "")).alias("empty_now"),
        F.count_if(ok & (F.col("uri_changed_after_registration") == "true")).alias("changed"))
    resolved_count = F.col("agents") - F.col("unresolved")
    return counts.withColumns({
        "empty_at_registration_pct": percent(F.col("empty_at_registration"), F.col("agents"), 1),
        "empty_now_pct": percent(F.col("empty_now"), resolved_count, 1),
        "changed_pct": percent(F.col("changed"), resolved_count, 1),
    })


def _flag(rows: DataFrame, column: str) -> Column:
    return truthy(F.col(column)) if column in rows.columns else F.lit(False)


def funnel(rows: DataFrame) -> DataFrame:
    """Seven rows, the registered ones first; shares of an empty previous stage are 0."""
    counts = rows.agg(F.count(F.lit(1)).alias("c0"), *[
        F.count_if(_flag(rows, column)).alias(f"c{i}")
        for i, (_, column) in enumerate(STUDY_STAGES) if column is not None])
    entries = []
    for i, (label, _) in enumerate(STUDY_STAGES):
        before = F.col(f"c{max(i - 1, 0)}")
        entries.append(F.struct(
            F.lit(i).alias("stage_no"), F.lit(label).alias("label"), F.col(f"c{i}").alias("n"),
            percent(F.col(f"c{i}"), F.col("c0"), 1).alias("pct_of_total"),
            F.coalesce(percent(F.col(f"c{i}"), before, 1), F.lit(0.0)).alias("pct_of_previous")))
    return counts.where("c0 > 0").select(F.inline(F.array(*entries)))


def live_share(stages: DataFrame) -> DataFrame:
    """The final conversion with its interval and the interval's width, in percent."""
    last = len(STUDY_STAGES) - 1
    total = F.max(F.when(F.col("stage_no") == 0, F.col("n")))
    alive = F.max(F.when(F.col("stage_no") == last, F.col("n")))
    both = stages.agg(alive.alias("live"), total.alias("agents"))
    low, high = wilson_bounds(F.col("live"), F.col("agents"))
    one_digit = lambda c: F.floor(c * 1000.0 + 0.5) / 10.0
    return both.select("live", "agents", percent(F.col("live"), F.col("agents"), 1).alias("pct"),
                       one_digit(F.coalesce(low, F.lit(0.0))).alias("ci_low"),
                       one_digit(F.coalesce(high, F.lit(0.0))).alias("ci_high"),
                       one_digit(F.coalesce(high - low, F.lit(0.0))).alias("width"))


def drop_offs(stages: DataFrame, limit: int = 3) -> DataFrame:
    """The largest losses between consecutive stages, in points of the total."""
    before = stages.select((F.col("stage_no") + 1).alias("stage_no"), F.col("n").alias("_n"),
                           F.col("label").alias("from_stage"))
    total = stages.where("stage_no = 0").select("n").scalar()
    steps = stages.join(F.broadcast(before), "stage_no").withColumn("lost", F.col("_n") - F.col("n"))
    ordered = steps.orderBy(F.col("lost").desc(), F.col("from_stage").desc(),
                            F.col("label").desc()).limit(limit)
    return ordered.select("from_stage", F.col("label").alias("to_stage"), "lost",
                          percent(F.col("lost"), total, 1).alias("points"))


def resolve_failures(rows: DataFrame, limit: int = 10) -> DataFrame:
    """Why URIs did not resolve: the error's name, or the HTTP status where there is none."""
    failed = rows.where(_flag(rows, "s1_uri_present") & ~_flag(rows, "s2_resolved"))
    name = F.substring_index(F.coalesce("fetch_error", F.lit("")), ":", 1)
    reason = F.when(name != "", name).otherwise(
        F.concat(F.lit("HTTP "), F.coalesce(F.col("http_status").cast("string"), F.lit("None"))))
    return failed.groupBy(reason.alias("reason")).agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "reason").limit(limit)
