"""Scans of undecoded logs, and how far they can be trusted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.constants import CONFIRMATIONS, EVENT_TOPICS, REGISTRY_CONTRACT
from rollcall.functions import abi
from rollcall.schemas import RAW_LOGS

STORED_LOGS = RAW_LOGS + ", block_number bigint, topic0 string, block_range bigint"


def with_block_number(raw_logs: DataFrame) -> DataFrame:
    """
    Add block_number as a number.

    Stores that keep it as a column get block-range filters pushed into the scan; hex text
    cannot be compared as it stands.
    """
    return raw_logs.withColumn("block_number", abi.quantity(F.col("blockNumber")))


def write_logs(raw_logs: DataFrame, path: str, range_blocks: int) -> None:
    """
    Store logs so that scans can skip: lower-case address and first topic, the block number as a
    number, a folder for every `range_blocks` blocks. Logs without a readable number come too, in
    a folder of their own.
    """
    with_block_number(raw_logs).withColumns({
        "address": F.lower("address"), "topic0": F.lower(F.get("topics", F.lit(0))),
        "block_range": F.floor(F.col("block_number") / range_blocks)}) \
        .hint("rebalance", "block_range").sortWithinPartitions("block_range", "block_number") \
        .write.partitionBy("block_range").mode("append").parquet(path)


def stored_logs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED_LOGS).parquet(path)


def scan_logs(raw_logs: DataFrame, from_block: int | None = None, to_block: int | None = None,
              topics: Sequence[str] | None = None, contract: str = REGISTRY_CONTRACT,
              range_blocks: int | None = None) -> DataFrame:
    """
    Logs of one contract in a block range with one of the given event signatures.

    On stored logs every filter reaches the scan, and with `range_blocks`, as they were written
    with, only the folders of the range are opened; on raw ones hex texts are read for it.
    """
    rows = raw_logs if "block_number" in raw_logs.columns else with_block_number(raw_logs)
    stored = "topic0" in raw_logs.columns
    rows = rows.where((F.col("address") if stored else F.lower("address")) == contract.lower())
    if from_block is not None:
        rows = rows.where(F.col("block_number") >= from_block)
        if stored and range_blocks:
            rows = rows.where(F.col("block_range") >= from_block // range_blocks)
    if to_block is not None:
        rows = rows.where(F.col("block_number") <= to_block)
        if stored and range_blocks:
            rows = rows.where(F.col("block_range") <= to_block // range_blocks)
    wanted = list(EVENT_TOPICS.values()) if topics is None else list(topics)
    topic = F.col("topic0") if stored else F.lower(F.get("topics", F.lit(0)))
    return rows.where(topic.isin(*[t.lower() for t in wanted]))


def recent_logs(logs: DataFrame, count: int) -> DataFrame:
    """The last `count` logs in chain order."""
    return logs.withColumn("_index", abi.quantity(F.col("logIndex"))) \
        .orderBy(F.col("block_number").desc(), F.col("_index").desc()).limit(count).drop("_index")


def confirmed_through(tip: Column, confirmations: int = CONFIRMATIONS) -> Column:
    """The highest block that a short reorganisation can no longer change."""
    return tip - F.lit(confirmations)


def readable_through(ranges: DataFrame, start_block: int) -> DataFrame:
    """
    The last block before the first gap in what was read, as one row `commit_to`.

    `ranges` holds (from_block, to_block, readable), one row per requested range, a few
    thousand per million blocks. A range that failed, or was never asked for, is a gap.
    """
    in_order = Window.orderBy("from_block").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max("to_block").over(in_order), F.lit(start_block - 1))
    read = ranges.where("readable").withColumn("_reached", F.greatest(
        reached, F.lit(start_block - 1)))
    # The end of the contiguous part is the reach before the first range that starts beyond it.
    gap = F.min(F.when(F.col("from_block") > F.col("_reached") + 1, F.col("_reached")))
    return read.agg(F.coalesce(gap, F.max("to_block"), F.lit(start_block - 1)).alias("commit_to"))
