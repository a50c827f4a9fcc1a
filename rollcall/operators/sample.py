"""Samples: every n-th row of an ordering, a fixed hash panel, the last N rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.constants import PANEL_HASH_SPACE
from rollcall.functions.text import month
from rollcall.session import materialise


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """
    Add `position`, counting from 1 in the given order, without moving all rows to one task.

    The sorted rows are written once, which fixes their partitions. Rows are then numbered
    within each partition, and the sizes of the partitions before it are added; the table of
    sizes has one row per partition.
    """
    ordered = rows.orderBy(*order).withColumn("_id", F.monotonically_increasing_id())
    stored = materialise(ordered, "numbered")
    part = F.shiftright("_id", 33).cast("int")
    sizes = stored.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = F.sum("_size").over(Window.orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    return stored.withColumn("_part", part).join(F.broadcast(starts), "_part") \
        .withColumn("position",
                    F.col("_start") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1) \
        .drop("_id", "_part", "_start")


def every_nth(rows: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return numbered(rows, order).where(F.col("position") % n == 0)


def last_rows(rows: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    return rows.orderBy(*[F.col(c).desc() for c in order]).limit(n)


def panel_hash(agent_id: Column) -> Column:
    """First eight hex digits of the md5 of the id: the same on every engine and version."""
    return F.conv(F.substring(F.md5(agent_id.cast("string").cast("binary")), 1, 8), 16, 10) \
        .cast("bigint")


def panel_rate(total: Column, target: int) -> Column:
    """One in how many, for a wanted panel size; ties round to even."""
    return F.greatest(F.lit(1), F.bround(total / F.lit(target)).cast("bigint"))


def panel_threshold(rate: Column) -> Column:
    return F.floor(F.lit(PANEL_HASH_SPACE) / rate)


def panel_candidates(agents: DataFrame, rate: int) -> DataFrame:
    return agents.where(panel_hash(F.col("agent_id")) < PANEL_HASH_SPACE // rate)


def draw_panel(agents: DataFrame, rate: int | None = None, target: int | None = None,
               now: Column | None = None) -> DataFrame:
    """
    Membership is only ever added: members stay, with the time and stratum of their joining.

    Either a rate (one in N) or a target size is given.
    """
    if rate is not None:
        threshold = F.lit(PANEL_HASH_SPACE // rate)
    else:
        total = agents.agg(F.count(F.lit(1)).alias("n"))
        threshold = panel_threshold(panel_rate(total.scalar(), target))
    joins = ~F.col("in_panel") & (panel_hash(F.col("agent_id")) < threshold)
    return agents.withColumns({
        "panel_added_at": F.when(joins, F.coalesce("panel_added_at",
                                                   F.current_timestamp() if now is None else now))
        .otherwise(F.col("panel_added_at")),
        "panel_stratum": F.when(joins, F.coalesce("panel_stratum", month(F.col("registered_at"))))
        .otherwise(F.col("panel_stratum")),
        "in_panel": F.col("in_panel") | joins,
    })


def panel_dry_run(agents: DataFrame, rate: int) -> DataFrame:
    """How many would be added, adding none."""
    joins = ~F.col("in_panel") & (panel_hash(F.col("agent_id")) < PANEL_HASH_SPACE // rate)
    return agents.agg(F.count(F.lit(1)).alias("agents"),
                      F.count_if("in_panel").alias("already_in_panel"),
                      F.count_if(joins).alias("would_add")) \
        .withColumn("panel_would_become", F.col("already_in_panel") + F.col("would_add"))


def panel_composition(agents: DataFrame) -> DataFrame:
    """
    Panel against registry per registration month.

    The two counts are separate groupings because a member's stratum is the month it joined
    under, whatever the registry says now.
    """
    unknown = F.lit("unknown")
    panel = agents.where("in_panel") \
        .groupBy(F.coalesce("panel_stratum", unknown).alias("stratum")) \
        .agg(F.count(F.lit(1)).alias("in_panel"))
    registry = agents.groupBy(F.coalesce(month(F.col("registered_at")), unknown).alias("stratum")) \
        .agg(F.count(F.lit(1)).alias("registered"))
    joined = panel.join(registry, "stratum", "left") \
        .withColumn("in_registry", F.coalesce("registered", F.lit(0)))
    share = F.when(F.col("in_registry") > 0,
                   F.lit(100.0) * F.col("in_panel") / F.col("in_registry")).otherwise(F.lit(0.0))
    return joined.select("stratum", "in_panel", "in_registry", share.alias("share_pct"))


def panel_summary(agents: DataFrame) -> DataFrame:
    return agents.where("in_panel").agg(
        F.count_if(F.col("current_uri") != "").alias("with_uri"),
        F.count_if(F.col("uri_change_count") > 0).alias("changed"),
        F.countDistinct("owner").alias("owners"))
