"""Block numbers to times: computed, and checked against the chain once per chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.constants import ANCHOR_BLOCK, ANCHOR_EPOCH_SECONDS, CHUNK_BLOCKS, \
    SECONDS_PER_BLOCK


def predicted_seconds(block: Column, anchor_block: int = ANCHOR_BLOCK,
                      anchor_seconds: int = ANCHOR_EPOCH_SECONDS) -> Column:
    return F.lit(anchor_seconds) + (block - F.lit(anchor_block)) * SECONDS_PER_BLOCK


def chunk_of(block: Column, start_block: int = ANCHOR_BLOCK, chunk: int = CHUNK_BLOCKS) -> Column:
    return F.floor((block - F.lit(start_block)) / F.lit(chunk))


def chunk_drift(events: DataFrame, blocks: DataFrame, start_block: int = ANCHOR_BLOCK,
                chunk: int = CHUNK_BLOCKS, anchor_block: int = ANCHOR_BLOCK,
                anchor_seconds: int = ANCHOR_EPOCH_SECONDS) -> DataFrame:
    """
    Per chunk: its highest block and how far the real time is from the predicted one.

    Drift is NULL where the chain has no time for that block; such a chunk keeps its
    predictions.
    """
    tops = events.groupBy(chunk_of(F.col("block_number"), start_block, chunk).alias("chunk")) \
        .agg(F.max("block_number").alias("top_block"))
    actual = F.unix_seconds("block_time")
    return tops.join(blocks.select(F.col("block_number").alias("top_block"),
                                   actual.alias("_actual")), "top_block", "left") \
        .select("chunk", "top_block",
                (F.col("_actual") - predicted_seconds(F.col("top_block"), anchor_block,
                                                      anchor_seconds)).alias("drift"))


def with_block_time(events: DataFrame, blocks: DataFrame | None = None,
                    start_block: int = ANCHOR_BLOCK, chunk: int = CHUNK_BLOCKS,
                    anchor_block: int = ANCHOR_BLOCK,
                    anchor_seconds: int = ANCHOR_EPOCH_SECONDS) -> DataFrame:
    """
    Add block_time.

    Without a table of real block times this is arithmetic alone. With one, chunks whose
    highest block disagrees with the prediction take the real times.
    """
    predicted = predicted_seconds(F.col("block_number"), anchor_block, anchor_seconds)
    if blocks is None:
        return events.withColumn("block_time", F.timestamp_seconds(predicted))
    drifted = chunk_drift(events, blocks, start_block, chunk, anchor_block, anchor_seconds) \
        .where("drift <> 0").select("chunk")
    # Only blocks of drifted chunks are looked up; usually that is none of them.
    lookup = blocks.select(
        "block_number", F.unix_seconds("block_time").alias("_actual"),
        chunk_of(F.col("block_number"), start_block, chunk).alias("chunk")) \
        .join(drifted, "chunk", "left_semi").select("block_number", "_actual")
    return events.join(lookup, "block_number", "left") \
        .withColumn("block_time", F.timestamp_seconds(F.coalesce("_actual", predicted))) \
        .drop("_actual")


def clock_report(drift: DataFrame) -> DataFrame:
    """One row: chunks checked, largest drift, chunks without a real time to check against."""
    return drift.agg(
        F.count("drift").alias("verifications"),
        F.coalesce(F.max(F.abs("drift")), F.lit(0)).alias("max_drift_seconds"),
        F.count_if(F.col("drift").isNull()).alias("unverified_chunks"))
