"""A batch without waiting logs reads its logs once."""

from pyspark.sql import functions as F

from rollcall.constants import ANCHOR_BLOCK, EVENT_TOPICS
from rollcall.schemas import RAW_LOGS
from rollcall.session import fresh_path
from rollcall.streaming import ingest


def _taken(spark, confirmations):
    """How often a block number was read, and the waiting logs, after a batch of 40 logs."""
    reads = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def block(number):
        reads.add(1)
        return hex(ANCHOR_BLOCK + number)

    rows = spark.range(40).select(
        F.lit("0xreg").alias("address"),
        F.array(F.lit(EVENT_TOPICS["Transfer"]), F.lit("0x1"), F.lit("0x2"), F.lit("0x3")).alias("topics"),
        F.lit("0x").alias("data"), block.asNondeterministic()("id").alias("blockNumber"),
        F.concat(F.lit("0xTX"), "id").alias("transactionHash"), F.lit("0x1").alias("logIndex"))
    store = ingest.Store(fresh_path(spark, "store"), range_blocks=1_000)
    ingest.ingest_batch(rows, 0, store, ingest.Settings(confirmations=confirmations))
    left = spark.read.schema(RAW_LOGS).parquet(f"{store.unconfirmed}/version=0")
    return reads.value, left.count()


def test_logs_are_read_once_if_none_waits(spark):
    assert _taken(spark, 0) == (40, 0)


def test_waiting_logs_are_kept(spark):
    assert _taken(spark, 5) == (80, 5)
