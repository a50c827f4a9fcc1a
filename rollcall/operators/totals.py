"""Registry-wide figures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.stats import wilson_columns
from rollcall.functions.text import month


def registry_totals(agents: DataFrame) -> DataFrame:
    return agents.agg(
        F.count(F.lit(1)).alias("agents"),
        F.countDistinct("owner").alias("distinct_owners"),
        F.count_if(F.col("current_uri") != "").alias("agents_with_uri"),
        F.count_if(F.col("uri_at_registration") == "").alias("empty_uri_at_registration"),
        F.count_if(F.col("uri_change_count") > 0).alias("uri_changed"),
        F.count_if(F.col("transfer_count") > 0).alias("transferred"),
        F.min("registered_at").alias("first_registration"),
        F.max("registered_at").alias("last_registration"))


def uri_churn(totals: DataFrame) -> DataFrame:
    """Share of agents whose URI changed after registration."""
    return totals.select(*wilson_columns(F.col("uri_changed"), F.col("agents")))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")) \
        .orderBy(F.col("n").desc(), "event_type")


def state_report(agents: DataFrame) -> DataFrame:
    counts = agents.agg(F.count(F.lit(1)).alias("agents"),
                        F.count_if(F.col("current_uri") != "").alias("with_uri"),
                        F.count_if(F.col("uri_change_count") > 0).alias("uri_changed"))
    share = F.when(F.col("agents") > 0, F.lit(100.0) * F.col("uri_changed") / F.col("agents"))
    return counts.withColumn("changed_pct", share)


def monthly(rows: DataFrame, registered_at: Column) -> DataFrame:
    """Registrations per UTC month with a running total; the window sees one row per month."""
    counts = rows.where(registered_at.isNotNull()).groupBy(month(registered_at).alias("month")) \
        .agg(F.count(F.lit(1)).alias("registered"))
    so_far = Window.orderBy("month").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.withColumn("cumulative", F.sum("registered").over(so_far)).orderBy("month")


def table_counts(tables: dict[str, DataFrame | None]) -> DataFrame:
    """(table, rows, present): a missing table has NULL rows."""
    parts = []
    spark = next(t for t in tables.values() if t is not None).sparkSession
    for name, table in tables.items():
        if table is None:
            part = spark.range(1).select(F.lit(name).alias("table_name"),
                                         F.lit(None).cast("bigint").alias("rows"),
                                         F.lit(False).alias("present"))
        else:
            part = table.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table_name"), "rows", F.lit(True).alias("present"))
        parts.append(part)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result
