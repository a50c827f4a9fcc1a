"""How unevenly agents are spread over owners."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from rollcall.operators.funnel import owner_key


def owner_sizes(rows: DataFrame) -> DataFrame:
    return rows.select(owner_key(F.col("owner")).alias("owner")).where("owner IS NOT NULL") \
        .groupBy("owner").agg(F.count(F.lit(1)).alias("agents"))


def owner_gini(rows: DataFrame) -> DataFrame:
    """
    Gini coefficient of agents per owner, without ranking the owners one by one.

    Owners of equal size share a block of ranks, so the running sum goes over the distinct
    sizes: at most about sqrt(2 * agents) rows, whatever the number of owners.
    """
    sizes = owner_sizes(rows).groupBy("agents").agg(F.count(F.lit(1)).alias("owners"))
    before = F.coalesce(F.sum("owners").over(
        Window.orderBy("agents").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    exact = "decimal(38,0)"
    owners = F.col("owners").cast("decimal(18,0)")
    ranked = sizes.withColumn("_before", before.cast("decimal(18,0)")).withColumn(
        "_ranks", (F.col("_before") * owners).cast(exact)
        + (owners * (owners + 1) / 2).cast(exact))
    totals = ranked.agg(
        F.sum(F.col("_ranks").cast("double") * F.col("agents")).alias("_weighted"),
        F.sum(F.col("owners") * F.col("agents")).alias("agents"),
        F.sum("owners").alias("owners"))
    gini = F.lit(2.0) * F.col("_weighted") / (F.col("owners") * F.col("agents").cast("double")) \
        - (F.col("owners") + 1) / F.col("owners").cast("double")
    return totals.select("owners", "agents", gini.alias("gini"))


def top_owners(rows: DataFrame, limit: int = 5) -> DataFrame:
    """
    The largest owners, with their share of all rows and the number of distinct owners.

    Both totals are scalar subqueries, so no window gathers the owners in one task.
    """
    sizes = owner_sizes(rows)
    total = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    distinct = sizes.agg(F.count(F.lit(1)).alias("n")).scalar()
    return sizes.orderBy(F.col("agents").desc(), "owner").limit(limit).select(
        "owner", "agents", (F.lit(100.0) * F.col("agents") / total).alias("share_pct"),
        distinct.alias("distinct_owners"), total.alias("rows"))
