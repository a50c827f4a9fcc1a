"""
Projects: agents linked by a shared owner or a shared root domain, transitively.

Every agent has at most one owner and one domain, so agents themselves need not be vertices:
the graph is owners and domains, joined by the distinct pairs that occur on agents. An owner
with a third of all agents on one domain is a single edge.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.functions.uri import is_shared_hosting
from rollcall.operators.components import component_labels, extended_labels
from rollcall.operators.funnel import group_funnel, owner_key


def linking_domain(domain: Column) -> Column:
    """The domain if sharing it means anything: shared hosting links nobody."""
    low = F.nullif(F.lower(F.coalesce(domain, F.lit(""))), F.lit(""))
    return F.when(low.isNotNull() & ~is_shared_hosting(low), low)


def _tagged(checks: DataFrame) -> DataFrame:
    owner = F.concat(F.lit("owner "), owner_key(F.col("owner")))
    domain = F.concat(F.lit("domain "), linking_domain(F.col("uri_root_domain")))
    return checks.withColumns({"_owner": owner, "_domain": domain})


def project_edges(checks: DataFrame) -> DataFrame:
    """(a, b): the distinct pairs of an owner and a linking domain."""
    return _tagged(checks).where("_owner IS NOT NULL AND _domain IS NOT NULL").select(
        F.col("_owner").alias("a"), F.col("_domain").alias("b")).distinct()


def project_labels(checks: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """
    (vertex, label) of owners and domains. With `known`, the stored labels of earlier checks, only
    what the given checks add to them is worked out.
    """
    edges = project_edges(checks)
    return component_labels(edges) if known is None else extended_labels(known, edges)


def with_project(checks: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """
    Add `project`, equal for two rows exactly if their agents belong together.

    An agent with neither an owner nor a linking domain is its own project. Only the distinct
    pairs of owner and domain are written; the labels, of these checks if none are given, come back to the
    rows by a join that the adaptive planner splits where one owner has very many rows.
    """
    if labels is None:
        labels = project_labels(checks)
    # Owners or domains that occur alone carry no edge and label themselves.
    anchor = F.coalesce("_owner", "_domain", F.concat(F.lit("agent "), F.col("agent_id")))
    return _tagged(checks).withColumn("_anchor", anchor) \
        .join(labels.withColumnRenamed("vertex", "_anchor"), "_anchor", "left") \
        .withColumn("project", F.coalesce("label", "_anchor")) \
        .drop("_owner", "_domain", "_anchor", "label")


def project_funnel(checks: DataFrame) -> DataFrame:
    return group_funnel(with_project(checks), F.col("project"))


def project_names(with_projects: DataFrame) -> DataFrame:
    """(project, first_agent, agents): a stable name, the smallest agent id of a project."""
    return with_projects.groupBy("project").agg(
        F.min("agent_id").alias("first_agent"), F.count(F.lit(1)).alias("agents"))


def _first_values(pairs: DataFrame, value: str, keep: int) -> DataFrame:
    """The first `keep` values per project in order, as an array of at most that length."""
    ranked = pairs.withColumn("_rank", F.row_number().over(
        Window.partitionBy("project").orderBy(value))).where(F.col("_rank") <= keep)
    return ranked.groupBy("project").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("_rank", value))),
                    lambda s: s[value]).alias("values"))


def top_projects(with_projects: DataFrame, limit: int = 20) -> DataFrame:
    """
    The largest projects with their owners, domains, hosting and live agents.

    Sizes come first; details are gathered for the chosen few only. Domain lists are cut to
    the wanted length by a ranked window, never collected whole.
    """
    sizes = with_projects.groupBy("project").agg(
        F.count(F.lit(1)).alias("agents"), F.count_if("live_strict").alias("live_agents"),
        F.min("agent_id").alias("first_agent"))
    chosen = sizes.orderBy(F.col("agents").desc(), "first_agent").limit(limit)
    members = with_projects.select("project", owner_key(F.col("owner")).alias("owner"),
                                   F.nullif("uri_root_domain", F.lit("")).alias("domain")) \
        .join(F.broadcast(chosen.select("project")), "project", "left_semi")
    owners = members.groupBy("project").agg(F.countDistinct("owner").alias("owners"))
    domains = members.where("domain IS NOT NULL").select("project", "domain").distinct() \
        .withColumn("_shared", is_shared_hosting(F.col("domain")))
    own = _first_values(domains.where("NOT _shared"), "domain", 5)
    hosting = _first_values(domains.where("_shared"), "domain", 3)
    none = F.array().cast("array<string>")
    joined = chosen.join(owners, "project", "left") \
        .join(own.withColumnRenamed("values", "domains"), "project", "left") \
        .join(hosting.withColumnRenamed("values", "hosted_on"), "project", "left") \
        .withColumns({"owners": F.coalesce("owners", F.lit(0)),
                      "domains": F.coalesce("domains", none),
                      "hosted_on": F.coalesce("hosted_on", none)})
    wallets = F.concat(F.col("owners").cast("string"), F.lit(" wallet(s)"))
    label = F.when(F.size("domains") > 0, F.get("domains", F.lit(0))) \
        .when(F.size("hosted_on") > 0,
              F.concat(wallets, F.lit(" on "),
                       F.substring(F.get("hosted_on", F.lit(0)), 1, 40))) \
        .otherwise(F.concat(wallets, F.lit(", no domain")))
    return joined.select("agents", "owners", "domains", "hosted_on", "live_agents",
                         label.alias("label"), "first_agent") \
        .orderBy(F.col("agents").desc(), "first_agent")


def shared_hosting_signature(checks: DataFrame) -> DataFrame:
    """
    Agents against distinct owners per domain. Many agents on almost as many owners is what
    shared hosting looks like; it is a guide for a person, never applied by itself.
    """
    return checks.where("uri_root_domain <> ''").groupBy(
        F.lower("uri_root_domain").alias("domain")).agg(
        F.count(F.lit(1)).alias("agents"),
        F.countDistinct(owner_key(F.col("owner"))).alias("owners")) \
        .withColumn("owners_per_agent", F.col("owners") / F.col("agents"))
