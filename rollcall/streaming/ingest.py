"""
Continuous ingest: raw log files or stored logs in, event log, current state and progress out.

Each micro-batch is one chunk, and costs what the chunk holds, not what was stored before. Its new
events go to a folder of their own, and what they say about each agent is one more partial state;
both become visible with the batch's commit, which also moves the cursor. Only a batch whose blocks
begin below the highest stored one has to look for events that are stored already, and then in the
batches of those blocks.

Partial states are merged by levels: `merge_every` batches make a run of the first level, as many such
runs one of the second, and so on. So an agent's state lies in few runs, a batch is merged again only
as often as there are levels, and a run is cut by a hash of the agent, so that a look at few agents
opens few files.

A batch that is repeated after a failure writes to a new folder; what the first try left is never
read.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollcall.constants import ANCHOR_BLOCK, ANCHOR_EPOCH_SECONDS, CHUNK_BLOCKS, \
    CONFIRMATIONS, STALL_HOURS, ZERO_ADDRESS
from rollcall.functions.abi import quantity
from rollcall.operators.blocktime import with_block_time
from rollcall.operators.decode import decode_logs, ingestible, keep_raw_when_needed
from rollcall.operators.dedupe import LOG_KEY, new_rows
from rollcall.operators.state import finished_state, merged_state, partial_state
from rollcall.schemas import PARTIAL_STATES, RAW_LOGS, REGISTRATION_EVENTS
from rollcall.session import discard
from rollcall.sources import logs, tables
from rollcall.streaming.commits import Commits
from rollcall.streaming.ranges import BlockRanges

EVENTS = REGISTRATION_EVENTS + ", batch_id bigint, attempt string, block_range bigint"


@dataclass(frozen=True)
class Store:
    """
    Where one stream keeps its tables, on storage every executor reads.

    A batch's events lie in a folder for every `range_blocks` blocks. Partial states are merged
    `merge_every` at a time; merged runs are cut into `buckets` by a hash of the agent.
    """

    root: str
    range_blocks: int
    stream: str = "identity_registry_base"
    merge_every: int = 8
    buckets: int = 16

    @property
    def events(self) -> str:
        return f"{self.root}/registration_events"

    @property
    def agents(self) -> str:
        return f"{self.root}/agents"

    @property
    def changes(self) -> str:
        return f"{self.root}/agent_changes"

    @property
    def progress(self) -> str:
        return f"{self.root}/progress"

    @property
    def unconfirmed(self) -> str:
        return f"{self.root}/unconfirmed"

    @property
    def unreadable(self) -> str:
        return f"{self.root}/unreadable"

    @property
    def checkpoint(self) -> str:
        return f"{self.root}/checkpoint"


@dataclass(frozen=True)
class Settings:
    confirmations: int = CONFIRMATIONS
    store_raw_data: bool = False
    only_known_topics: bool = True
    anchor_block: int = ANCHOR_BLOCK
    anchor_seconds: int = ANCHOR_EPOCH_SECONDS
    chunk_blocks: int = CHUNK_BLOCKS
    zero_address: str = ZERO_ADDRESS


def raw_log_stream(spark: SparkSession, path: str, files_per_batch: int | None = None,
                   fmt: str = "parquet") -> DataFrame:
    """A folder of log files as a stream; files_per_batch bounds the size of a batch."""
    reader = spark.readStream.format(fmt).schema(RAW_LOGS)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def commits(spark: SparkSession, store: Store) -> Commits:
    return Commits(spark, store.progress)


def read_progress(spark: SparkSession, store: Store) -> DataFrame:
    """One row for each batch: what it took in, or the error of its last try."""
    return commits(spark, store).rows()


def last_run(spark: SparkSession, store: Store) -> DataFrame:
    """One row: the status and error of the batch that was tried last; nulls before the first."""
    return read_progress(spark, store).agg(
        F.max_by("status", F.struct("batch_id", "run_at")).alias("status"),
        F.max_by("error", F.struct("batch_id", "run_at")).alias("error"))


def cursor(spark: SparkSession, store: Store) -> DataFrame:
    """One row: the highest ingested block, events ingested so far, time of the last advance."""
    return read_progress(spark, store).where("status = 'ok'").agg(
        F.max("last_block").alias("last_block"),
        F.coalesce(F.sum("inserted"), F.lit(0)).alias("events_ingested"),
        F.max(F.when(F.col("last_block").isNotNull(), F.col("run_at"))).alias("last_advance_at"))


def stall_report(spark: SparkSession, store: Store, limit_hours: float = STALL_HOURS) -> DataFrame:
    """Hours since the cursor last moved; never having moved counts as stalled."""
    hours = (F.unix_micros(F.current_timestamp()) - F.unix_micros("last_advance_at")) / 3.6e9
    return cursor(spark, store).select(
        hours.alias("hours_since_advance"),
        F.coalesce(hours > limit_hours, F.lit(True)).alias("stalled"))


def ingest_batch(batch: DataFrame, batch_id: int, store: Store, settings: Settings,
                 blocks: DataFrame | None = None, ranges: DataFrame | None = None,
                 tip: int | None = None, through: int | None = None) -> None:
    """
    Take one batch of raw logs into the store.

    Logs above the committed height wait in a side table until a later batch confirms them: those
    less than `confirmations` blocks below the tip, and those behind a gap in `ranges`
    (from_block, to_block, readable) or above the block `through`, if given. The tip is the highest
    of `tip` and of the blocks of `blocks`, if given, and of any log. Logs whose block number cannot be read are kept apart and counted.
    A batch that fails leaves its error in the progress and is tried again by the stream; one that
    is committed already is left as it is.
    """
    done = commits(batch.sparkSession, store)
    if done.get(batch_id) is None:
        try:
            row = _take_in(batch, batch_id, store, settings, blocks, ranges, tip, through,
                           done.get(batch_id - 1) or {})
            done.add(batch_id, {"stream": store.stream, **row})
        except Exception as failure:
            if done.get(batch_id) is None:
                done.fail(batch_id, {"stream": store.stream, "error": str(failure)[:500]})
            raise
    # The one before is needed if this batch is repeated, older ones never.
    discard(batch.sparkSession, f"{store.unconfirmed}/version={batch_id - 2}")
    merge_states(batch.sparkSession, store, batch_id)


def _highest(*numbers: int | None) -> int | None:
    return max((n for n in numbers if n is not None), default=None)


def _take_in(batch: DataFrame, batch_id: int, store: Store, settings: Settings,
             blocks: DataFrame | None, ranges: DataFrame | None, tip: int | None,
             through: int | None, before: dict) -> dict:
    spark = batch.sparkSession
    waiting = tables.read(spark, f"{store.unconfirmed}/version={batch_id - 1}", RAW_LOGS)
    raw = batch.select("address", "topics", "data", "blockNumber", "transactionHash", "logIndex")
    if waiting is not None:
        raw = raw.unionByName(waiting)
    if settings.only_known_topics:
        raw = ingestible(raw)
    decoded = decode_logs(raw).persist()
    try:
        # A few numbers; everything else stays distributed.
        seen, unreadable = decoded.agg(
            F.max("block_number"), F.count_if(F.col("block_number").isNull())).first()
        top = blocks.agg(F.max("block_number")).first()[0] if blocks is not None else None
        tip = _highest(seen, before.get("tip"), top, tip)
        last_block = None if tip is None else tip - settings.confirmations
        if ranges is not None and last_block is not None:
            last_block = min(last_block, logs.readable_through(ranges, settings.anchor_block)
                             .first()["commit_to"])
        if through is not None and last_block is not None:
            last_block = min(last_block, through)
        highest = -1 if last_block is None else last_block
        height, number = F.lit(highest), quantity(F.col("blockNumber"))
        # If nothing waits, the logs are not read again for it: the table is written empty.
        left = number > height if seen is not None and seen > highest else F.lit(False)
        raw.where(left).write.mode("overwrite") \
            .parquet(f"{store.unconfirmed}/version={batch_id}")
        if unreadable:
            tables.overwrite_partitions(raw.where(number.isNull()).withColumn(
                "batch", F.lit(batch_id)), store.unreadable, "batch")
        confirmed = decoded.where(F.col("block_number") <= height)
        first, last, events, agents, sanitized = confirmed.agg(
            F.min("block_number"), F.max("block_number"), F.count(F.lit(1)),
            F.countDistinct("agent_id"), F.count_if("sanitized")).first()
        inserted, attempt = 0, uuid.uuid4().hex
        if events:
            near = blocks.where(F.col("block_number").between(first, last)) \
                if blocks is not None else None
            timed = with_block_time(confirmed, near, settings.anchor_block,
                                    settings.chunk_blocks, settings.anchor_block,
                                    settings.anchor_seconds)
            rows = keep_raw_when_needed(timed, settings.store_raw_data) \
                .withColumn("ingested_at", F.current_timestamp())
            again = first <= (before.get("top_block") or -1)
            known = committed_events(spark, store, first, last) if again else None
            own, inserted = _store_events(rows, known, f"{store.events}/batch_id={batch_id}"
                                                       f"/attempt={attempt}", store)
            if inserted:
                partial_state(own, settings.zero_address).sortWithinPartitions("agent_id") \
                    .write.mode("overwrite").parquet(f"{store.changes}/batch={batch_id}")
        if not inserted:
            # A first try may have left something that is not of this one.
            discard(spark, f"{store.changes}/batch={batch_id}")
        return {"last_block": last_block, "tip": tip, "events": events, "inserted": inserted,
                "agents": agents, "sanitized": sanitized, "unreadable": unreadable,
                "attempt": attempt, "first_block": first, "through": last,
                "top_block": _highest(before.get("top_block"), last)}
    finally:
        decoded.unpersist()


def _store_events(rows: DataFrame, known: DataFrame | None, path: str,
                  store: Store) -> tuple[DataFrame, int]:
    """
    Write the events that are not known yet; what was written, and how many.

    Rows are dealt evenly to files of a good size, also where one range has nearly all of them.
    """
    columns = [c.strip().split(" ")[0] for c in REGISTRATION_EVENTS.split(",")]
    seen = Observation()
    new_rows(rows, known, LOG_KEY) \
        .select(*columns, F.floor(F.col("block_number") / store.range_blocks).alias("block_range")) \
        .hint("rebalance", "block_range").observe(seen, F.count(F.lit(1)).alias("n")) \
        .write.partitionBy("block_range").parquet(path)
    own = rows.sparkSession.read.schema(REGISTRATION_EVENTS + ", block_range bigint").parquet(path)
    return own, seen.get["n"]


def committed_events(spark: SparkSession, store: Store, low: int | None = None,
                     high: int | None = None) -> DataFrame:
    """Events that commits name, of blocks low to high if given: only their folders are read."""
    stored = tables.read(spark, store.events, EVENTS)
    if stored is None:
        return spark.createDataFrame([], EVENTS)
    if low is not None:
        stored = stored.where(F.col("block_range").between(
            low // store.range_blocks, high // store.range_blocks))
    return stored.join(commits(spark, store).named(low, high), ["batch_id", "attempt"], "left_semi")


def _span(store: Store, batch_id: int) -> int:
    """How many batches the merged run that ends at a batch holds: the largest power that fits."""
    span = 1
    while (batch_id + 1) % (span * store.merge_every) == 0:
        span *= store.merge_every
    return span


def _runs(spark: SparkSession, store: Store, end: int, span: int, merged: bool) -> list[str]:
    """
    The folders that together hold `span` batches up to `end`: the merged run, if it is wanted and
    complete, or else the runs that it is made of.
    """
    if span == 1:
        path = f"{store.changes}/batch={end}"
        return [path] if tables.exists(spark, f"{path}/_SUCCESS") else []
    if merged and tables.exists(spark, f"{store.agents}/version={end}/_SUCCESS"):
        return [f"{store.agents}/version={end}"]
    part = span // store.merge_every
    return [path for k in range(store.merge_every) for path in _runs(
        spark, store, end - k * part, part, k > 0)]


def _partial_states(spark: SparkSession, store: Store) -> list[str]:
    """The folders of all runs, at most merge_every - 1 for each level."""
    end, out = commits(spark, store).last(), []
    while end >= 0:
        span = _span(store, end)
        out += _runs(spark, store, end, span, True)
        end -= span
    return out


def _read_runs(spark: SparkSession, store: Store, paths: list[str],
               agents: list[str] | None = None) -> DataFrame:
    """The partial states in runs; of some agents only, from their buckets."""
    parts = []
    for path in paths:
        rows = spark.read.schema(PARTIAL_STATES + ", bucket int").parquet(path)
        if agents is not None:
            rows = rows.where(F.col("agent_id").isin(agents))
            if path.startswith(f"{store.agents}/"):
                rows = rows.where(F.col("bucket").isin([_bucket(F.lit(a), store)
                                                        for a in agents]))
        parts.append(rows.drop("bucket"))
    out = spark.createDataFrame([], PARTIAL_STATES)
    for rows in parts:
        out = out.unionByName(rows)
    return out


def _bucket(agent_id: Column, store: Store) -> Column:
    return F.pmod(F.xxhash64(agent_id), F.lit(store.buckets)).cast("int")


def merge_states(spark: SparkSession, store: Store, batch_id: int) -> None:
    """
    Merge the runs that end at a batch, if it completes a level.

    A merged run counts once it is complete; what it is made of is removed after that. Removed or
    not, it is never read again.
    """
    span, path = _span(store, batch_id), f"{store.agents}/version={batch_id}"
    if span == 1 or tables.exists(spark, f"{path}/_SUCCESS"):
        return
    paths = _runs(spark, store, batch_id, span, False)
    if not paths:
        return
    merged_state(_read_runs(spark, store, paths)) \
        .withColumn("bucket", _bucket(F.col("agent_id"), store)).hint("rebalance", "bucket") \
        .sortWithinPartitions("bucket", "agent_id") \
        .write.partitionBy("bucket").mode("overwrite").parquet(path)
    for part in paths:
        discard(spark, part)


def start_ingest(spark: SparkSession, source: str, store: Store, settings: Settings = Settings(),
                 files_per_batch: int | None = None, blocks: DataFrame | None = None,
                 ranges: DataFrame | None = None, fmt: str = "parquet",
                 once: bool = True) -> StreamingQuery:
    """
    Start the stream. With once=True it ends when the files present now are taken in, which
    is how a scheduled, bounded run works; otherwise it keeps waiting for files.
    """
    stream = raw_log_stream(spark, source, files_per_batch, fmt)
    writer = stream.writeStream.option("checkpointLocation", store.checkpoint).foreachBatch(
        lambda batch, batch_id: ingest_batch(batch, batch_id, store, settings, blocks, ranges))
    return (writer.trigger(availableNow=True) if once
            else writer.trigger(processingTime="1 minute")).start()


def last_stored_block(logs_path: str, spark: SparkSession) -> tuple[int, int] | None:
    """The first and the last block of stored logs."""
    found = logs.stored_logs(spark, logs_path).agg(F.min("block_number"),
                                                   F.max("block_number")).first()
    return None if found[0] is None else (found[0], found[1])


def run_blocks(spark: SparkSession, logs_path: str, store: Store, settings: Settings = Settings(),
               max_blocks: int | None = None, max_seconds: float | None = None,
               chunk: int = 1_000_000, tip: int | None = None,
               blocks: DataFrame | None = None) -> str:
    """
    Take stored logs (`logs.write_logs`, with the store's range_blocks) in by block ranges: one
    bounded run. Why it ended: "confirmed", "max blocks" or "max seconds".

    The run begins behind the last block of the run before, or at the first stored one, and takes
    at most `max_blocks` blocks, `chunk` in a batch, none that has fewer than `confirmations` blocks
    below the tip: `tip`, or else the last stored block. After `max_seconds` no further batch
    begins. A batch reads the folders of its own blocks only. A run that is killed is continued by the
    next one.
    """
    span = last_stored_block(logs_path, spark)
    if span is None:
        return "confirmed"
    tip = span[1] if tip is None else tip
    done = commits(spark, store)
    last = done.get(done.last()) or {}
    start = span[0] if last.get("last_block") is None else last["last_block"] + 1
    confirmed = tip - settings.confirmations
    target = confirmed if max_blocks is None else min(confirmed, start + max_blocks - 1)
    if target < start:
        return "confirmed"
    spark.dataSource.register(BlockRanges)
    stream = spark.readStream.format("block_ranges").option("start", start) \
        .option("target", target).option("chunk", chunk)
    if max_seconds is not None:
        stream = stream.option("deadline", time.time() + max_seconds)

    def take(admitted: DataFrame, batch_id: int) -> None:
        for low, high in admitted.collect():
            rows = logs.stored_logs(spark, logs_path).where(
                F.col("block_number").between(low, high)
                & F.col("block_range").between(low // store.range_blocks,
                                               high // store.range_blocks))
            ingest_batch(rows, batch_id, store, settings, blocks, tip=tip, through=high)
    run = stream.load().writeStream.option("checkpointLocation", store.checkpoint) \
        .foreachBatch(take).start()
    try:
        run.processAllAvailable()
    finally:
        run.stop()
    reached = (done.get(done.last()) or {}).get("last_block", start - 1)
    return "max seconds" if reached < target else \
        "max blocks" if target < confirmed else "confirmed"


def stored_agents(spark: SparkSession, store: Store,
                  agents: list[str] | None = None) -> DataFrame:
    """
    The current state: merged runs and later changes, put together when read; of some agents only,
    if a list of few ids is given, from their buckets.
    """
    return finished_state(merged_state(_read_runs(spark, store, _partial_states(spark, store),
                                                  agents)))


def stored_events(spark: SparkSession, store: Store) -> DataFrame:
    return committed_events(spark, store).drop("batch_id", "attempt", "block_range")
