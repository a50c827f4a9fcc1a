"""From undecoded logs to flat event rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from rollcall.constants import EVENT_TOPICS, TOPIC_METADATA_SET, TOPIC_METADATA_UPDATE, \
    TOPIC_REGISTERED, TOPIC_TRANSFER, TOPIC_URI_UPDATED
from rollcall.functions import abi
from rollcall.functions.staging import stage
from rollcall.functions.text import has_nul, without_nul


def _follow_offsets(df: DataFrame, wanted: Sequence[Column]) -> DataFrame:
    """
    Follow the offset words at the head of the data to their lengths and payloads.

    Argument i gets _payload{i} (hex digits), or a reason in _fault{i}; both stay NULL where
    `wanted[i]` does not hold.
    """
    digits, size = F.col("_digits"), F.col("_size")
    offset, length = (lambda i: F.col(f"_offset{i}")), (lambda i: F.col(f"_length{i}"))
    df = stage(df, {f"_wanted{i}": F.coalesce(want, F.lit(False))
                    for i, want in enumerate(wanted)})
    df = stage(df, {f"_head{i}": F.when(F.col(f"_wanted{i}"), abi.word_at(digits, F.lit(32 * i)))
                    for i in range(len(wanted))})
    df = stage(df, {f"_offset{i}": abi.small_number(F.col(f"_head{i}"))
                    for i in range(len(wanted))})
    df = stage(df, {f"_tail{i}": F.when(offset(i) + 32 <= size, abi.word_at(digits, offset(i)))
                    for i in range(len(wanted))})
    df = stage(df, {f"_length{i}": abi.small_number(F.col(f"_tail{i}"))
                    for i in range(len(wanted))})

    def fault(i: int) -> Column:
        reason = (F.when(digits.isNull(), "data is not hex")
                  .when(size < 32 * (i + 1), "data too short")
                  .when(offset(i).isNull() | (offset(i) + 32 > size), "offset past the end")
                  .when(length(i).isNull() | (offset(i) + 32 + length(i) > size),
                        "length past the end"))
        return F.when(F.col(f"_wanted{i}"), reason)

    df = stage(df, {f"_fault{i}": fault(i) for i in range(len(wanted))})
    return stage(df, {
        f"_payload{i}": F.when(
            F.col(f"_wanted{i}") & F.col(f"_fault{i}").isNull(),
            F.substr(digits, ((offset(i) + 32) * 2 + 1).cast("int"), (length(i) * 2).cast("int")))
        for i in range(len(wanted))})


def decode_logs(raw_logs: DataFrame) -> DataFrame:
    """
    One flat row per log. A log that cannot be decoded becomes type `unknown` with the reason
    in decode_error and its payload intact; fields read before the fault are kept.
    """
    topics = F.col("topics")
    topic = lambda i: F.get(topics, F.lit(i))
    kind = F.lit(None).cast("string")
    for name, signature in EVENT_TOPICS.items():
        kind = F.when(F.col("_topic0") == signature, name).otherwise(kind)

    df = stage(raw_logs, {"_topic0": F.coalesce(F.lower(topic(0)), F.lit("")),
                          "_digits": abi.bare_hex(F.col("data"))})
    df = stage(df, {"_kind": kind,
                    "_size": F.coalesce(F.char_length("_digits") / 2, F.lit(0)).cast("bigint")})
    is_transfer = F.coalesce(F.col("_kind") == "Transfer", F.lit(False))
    is_metadata = F.col("_kind") == "MetadataSet"
    sets_uri = F.col("_kind").isin("Registered", "URIUpdated")
    id_topic = F.when(is_transfer, topic(3)).otherwise(topic(1))
    df = stage(df, {"_word": F.when(F.col("_kind").isNotNull(), abi.topic_word(id_topic))})
    df = _follow_offsets(df, [sets_uri | is_metadata, is_metadata])

    # Topics are read left to right, so a missing one hides those after it.
    ends_read = F.col("_word").isNotNull()
    reads_id = F.when(is_transfer, topic(1).isNotNull() & topic(2).isNotNull() & ends_read) \
        .otherwise(ends_read)
    reads_holder = F.when(is_transfer, topic(1).isNotNull()).when(sets_uri, ends_read) \
        .otherwise(False)
    complete = reads_id & (~sets_uri | topic(2).isNotNull())
    df = stage(df, {
        "decode_error": F.when(F.col("_kind").isNull(), "unknown topic0")
        .when(~complete, "topic missing or not a number")
        .otherwise(F.coalesce("_fault0", "_fault1"))})
    decoded = F.col("decode_error").isNull()
    df = stage(df, {
        "_text": F.when(decoded, abi.utf8_lenient(F.col("_payload0"))),
        "_value": F.when(decoded & is_metadata, abi.text_or_hex(F.col("_payload1"))),
    })
    return df.select(
        F.when(decoded, F.col("_kind")).otherwise("unknown").alias("event_type"),
        F.when(reads_id, abi.decimal_text("_word")).alias("agent_id"),
        F.when(reads_id, F.col("_word")).alias("agent_id_hex"),
        abi.quantity(F.col("blockNumber")).alias("block_number"),
        F.lower("transactionHash").alias("tx_hash"),
        abi.quantity(F.col("logIndex")).cast("int").alias("log_index"),
        F.col("_topic0").alias("topic0"),
        F.when(reads_holder, abi.topic_address(topic(2))).alias("owner"),
        F.when(is_transfer, abi.topic_address(topic(1))).alias("from_address"),
        F.when(sets_uri, without_nul(F.col("_text"))).alias("agent_uri"),
        F.when(is_metadata, without_nul(F.col("_text"))).alias("metadata_key"),
        without_nul(F.col("_value")).alias("metadata_value"),
        topics.alias("raw_topics"),
        F.coalesce(F.col("data"), F.lit("0x")).alias("raw_data"),
        "decode_error",
        (has_nul(F.col("_text")) | has_nul(F.col("_value"))).alias("sanitized"),
    )


def keep_raw_when_needed(events: DataFrame, store_raw_data: bool = False) -> DataFrame:
    """Keep the payload if asked to, if it was not decoded, or if its text had to be altered."""
    keep = F.lit(store_raw_data) | (F.col("event_type") == "unknown") | F.col("sanitized")
    return events.withColumn("raw_data", F.when(keep, F.col("raw_data")))


def ingestible(raw_logs: DataFrame) -> DataFrame:
    """Only the four event types are ingested; cache-refresh notices and the rest are not."""
    return raw_logs.where(F.lower(F.get("topics", F.lit(0)))
                          .isin(*EVENT_TOPICS.values()))


def is_ignored_topic(topic0: Column) -> Column:
    return F.lower(topic0) == TOPIC_METADATA_UPDATE


def lenient_string(data: Column) -> Column:
    """
    The study's reading of one ABI string: short data is '', and a payload cut off before its
    declared length is taken as far as it goes.
    """
    digits = abi.bare_hex(data)
    size = F.char_length(digits) / 2
    offset = abi.small_number(abi.word_at(digits, F.lit(0)))
    tail = F.when(offset <= size, F.substr(digits, (offset * 2 + 1).cast("int")))
    # A length word cut off by the end of the data is still read as a number.
    length_word = F.substr(tail, F.lit(1), F.lit(64))
    length = F.when(F.char_length(length_word) == 0, F.lit(0)).otherwise(
        abi.small_number(F.lpad(length_word, 64, "0")))
    # A declared length beyond any data means "to the end".
    take = F.coalesce(F.least(length, size.cast("bigint")), size.cast("bigint"))
    payload = F.substr(tail, F.lit(65), (take * 2).cast("int"))
    text = abi.utf8_lenient(payload)
    return F.coalesce(F.when(size >= 64, text), F.lit(""))


def study_registrations(raw_logs: DataFrame) -> DataFrame:
    """The study's row per Registered log: six columns, lenient decoding, nothing lower-cased."""
    topic = lambda i: F.get("topics", F.lit(i))
    return (
        raw_logs.where(F.lower(topic(0)) == TOPIC_REGISTERED)
        .withColumn("_word", abi.topic_word(topic(1)))
        .select(
            abi.decimal_text("_word").alias("agent_id"),
            F.concat(F.lit("0x"), F.right(topic(2), F.lit(40))).alias("owner"),
            lenient_string(F.col("data")).alias("agent_uri_at_registration"),
            abi.quantity(F.col("blockNumber")).alias("block_number"),
            F.col("transactionHash").alias("tx_hash"),
            abi.quantity(F.col("logIndex")).cast("int").alias("log_index"),
        ))


__all__ = [
    "decode_logs", "ingestible", "is_ignored_topic", "keep_raw_when_needed", "lenient_string",
    "study_registrations", "TOPIC_METADATA_SET", "TOPIC_REGISTERED", "TOPIC_TRANSFER",
    "TOPIC_URI_UPDATED",
]
