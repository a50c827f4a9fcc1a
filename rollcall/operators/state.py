"""Current state of every agent, rebuilt from the append-only event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollcall.constants import ZERO_ADDRESS


def partial_state(events: DataFrame, zero_address: str = ZERO_ADDRESS) -> DataFrame:
    """
    What a set of events says about each agent, in a form that merges.

    The earliest registration, the latest URI, the latest holder and the tallies come from one
    aggregation with partial aggregation before the shuffle, so an agent with very many events
    is reduced where its events lie. Structs begin with the order they are chosen by.
    """
    kind = F.col("event_type")
    order = ["block_number", "log_index"]
    registered = kind == "Registered"
    transferred = kind == "Transfer"
    when = lambda condition, *fields: F.when(condition, F.struct(*order, *fields))
    return events.where("agent_id IS NOT NULL").groupBy("agent_id").agg(
        F.min(when(registered, "owner", "agent_uri", "block_time", "tx_hash")).alias("reg"),
        F.max(when(kind.isin("Registered", "URIUpdated"), "agent_uri")).alias("uri"),
        F.max(when(transferred, "owner")).alias("hold"),
        F.count_if(kind == "URIUpdated").alias("uri_changes"),
        F.count_if(transferred & (F.col("from_address") != zero_address)).alias("transfers"),
        F.count_if(registered).alias("registrations"))


def merged_state(parts: DataFrame) -> DataFrame:
    """Partial states of disjoint sets of events, put together: again a partial state."""
    return parts.groupBy("agent_id").agg(
        F.min("reg").alias("reg"), F.max("uri").alias("uri"), F.max("hold").alias("hold"),
        *[F.sum(c).alias(c) for c in ("uri_changes", "transfers", "registrations")])


def finished_state(state: DataFrame) -> DataFrame:
    """One row per agent with a Registered event."""
    return state.where("registrations > 0").select(
        "agent_id",
        F.coalesce("hold.owner", "reg.owner").alias("owner"),
        F.col("reg.owner").alias("minted_to"),
        F.col("transfers").cast("int").alias("transfer_count"),
        F.col("reg.block_number").alias("registered_block"),
        F.col("reg.block_time").alias("registered_at"),
        F.col("reg.tx_hash").alias("registered_tx"),
        F.coalesce("reg.agent_uri", F.lit("")).alias("uri_at_registration"),
        F.coalesce("uri.agent_uri", F.lit("")).alias("current_uri"),
        F.col("uri.block_number").alias("current_uri_block"),
        F.col("uri.log_index").alias("current_uri_log_index"),
        F.col("uri_changes").cast("int").alias("uri_change_count"),
    )


def current_state(events: DataFrame, zero_address: str = ZERO_ADDRESS) -> DataFrame:
    """The state of every agent from all its events."""
    return finished_state(partial_state(events, zero_address))


def rebuild_touched(events: DataFrame, touched: DataFrame) -> DataFrame:
    """State of the agents in `touched` only; everything else is left out of the shuffle."""
    ids = touched.where("agent_id IS NOT NULL").select("agent_id").distinct()
    return current_state(events.join(ids, "agent_id", "left_semi"))


def agent_tallies(events: DataFrame, zero_address: str = ZERO_ADDRESS) -> DataFrame:
    """URI updates and real transfers per agent; a transfer without a sender is not counted."""
    kind = F.col("event_type")
    return events.where("agent_id IS NOT NULL").groupBy("agent_id").agg(
        F.count_if(kind == "URIUpdated").alias("uri_changes"),
        F.count_if((kind == "Transfer") & (F.col("from_address") != zero_address))
        .alias("transfers"))


def with_agent_hosts(agents: DataFrame, checks: DataFrame) -> DataFrame:
    """
    Host and root domain of each agent from the checks of one run.

    A check without a host leaves the stored values alone, so an agent that moved away from
    https keeps its old domain. Pass as_of columns of a single run to see only that run.
    """
    seen = checks.where("uri_host <> ''") \
        .select("agent_id", F.col("uri_host").alias("_host"),
                F.col("uri_root_domain").alias("_root"))
    return agents.join(seen, "agent_id", "left").withColumns({
        "host_changed": F.col("_host").isNotNull()
        & (~F.col("_host").eqNullSafe(F.col("uri_host"))
           | ~F.col("_root").eqNullSafe(F.col("uri_root_domain"))),
        "uri_host": F.coalesce("_host", "uri_host"),
        "uri_root_domain": F.when(F.col("_host").isNotNull(), F.col("_root"))
        .otherwise(F.col("uri_root_domain")),
    }).drop("_host", "_root")
