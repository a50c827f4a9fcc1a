"""The study's CSV and text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rollcall.functions.text import strip
from rollcall.operators.sample import numbered

# --- fixed values: column orders of the study's files -----------------------------------

URI_COLUMNS = ("agent_uri_current", "agent_uri_at_registration", "agent_uri", "uri")
REGISTERED_COLUMNS = (
    "agent_id", "owner", "agent_uri_at_registration", "agent_uri_current",
    "uri_changed_after_registration", "block_number", "timestamp", "datetime_utc", "tx_hash",
    "log_index")
MONTHLY_COLUMNS = ("month", "registered", "cumulative")
RESOLVED_COLUMNS = REGISTERED_COLUMNS + ("resolve_status",)
LIVENESS_COLUMNS = (
    "agent_id", "owner", "uri_raw", "uri_source", "s1_uri_present", "uri_scheme",
    "resolved_url", "s2_resolved", "http_status", "latency_ms", "content_type",
    "content_bytes", "fetch_error", "s3_valid_json", "json_error", "type_field_raw",
    "s4_schema_match", "registry_field_present", "registry_matches", "s5_has_services",
    "services_count", "service_types", "endpoints_total", "endpoints_checked",
    "endpoints_ok", "s6_any_endpoint_alive", "endpoint_details", "funnel_stage",
    "checked_at")

# Quotes are doubled inside quoted fields. Without the last option Spark's reader takes NUL for the
# character that escapes an escape, and drops it.
_QUOTES = {"quote": '"', "escape": '"', "charToEscapeQuoteEscaping": '"'}


# `from_csv` takes U+FFFF for the end of its text, so it goes there as two other characters.
_END, _MARK = "\uffff", "\ufdd0"


def _without_end(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_MARK), F.lit(_MARK + "0")), F.lit(_END), F.lit(_MARK + "1"))


def _with_end(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(_MARK + "1"), F.lit(_END)), F.lit(_MARK + "0"), F.lit(_MARK))


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file as text columns; quotes are doubled inside quoted fields."""
    return spark.read.csv(path, header=True, multiLine=True, inferSchema=False, **_QUOTES)


def read_cut_table(spark: SparkSession, path: str) -> DataFrame:
    """
    What `read_table` reads, by as many tasks as the files have blocks.

    A line break ends a record if the quotes before it, counted from the start of the file, are
    even in number. Every block counts the quotes of its lines on its own, and what comes before it in its
    file adds up over the blocks, of which a file has few. So each line knows whether it begins a
    record and the number of that record; only lines of records that have several are put together.

    Files must be UTF-8 with a header of one line each, the same in all. Blank lines between
    records are left out; a quote that is never closed makes the rest of its file one record, as it
    does for `read_table`.
    """
    columns = read_table(spark, path).columns
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"), "value", (quotes % 2).alias("odd"))
    block = Window.partitionBy("file", "block").orderBy("line")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    counted = lines.withColumn("within", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    # One row for each block. If a quote is open where it begins, its other lines begin records.
    blocks = counted.groupBy("file", "block").agg(
        F.sum("odd").alias("odd"), F.count_if(F.col("within") == 0).alias("even_starts"),
        F.count_if(F.col("within") == 1).alias("odd_starts"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("open", F.coalesce(F.sum("odd").over(earlier), F.lit(0)) % 2)
    starts = F.when(F.col("open") == 0, F.col("even_starts")).otherwise(F.col("odd_starts"))
    blocks = blocks.withColumn("records", F.coalesce(F.sum(starts).over(earlier), F.lit(0))) \
        .select("file", "block", "open", "records")
    start = (F.col("within") == F.col("open")).cast("long")
    placed = counted.join(blocks, ["file", "block"]).withColumn("start", start).withColumn(
        "record", F.col("records") + F.sum("start").over(block)) \
        .withColumn("whole", (F.col("start") == 1) & (F.col("odd") == 0))
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "line", "value"))),
                                    lambda x: x["value"]), "\n")
    texts = placed.where("whole").select("record", "value").unionByName(
        placed.where("NOT whole").groupBy("file", "record").agg(text.alias("value"))
        .select("record", "value"))
    schema = ", ".join(f"`{c.replace('`', '``')}` string" for c in columns)
    value = F.regexp_replace("value", "\r$", "")
    rows = texts.where(F.col("record") > 1).where(value != "").select(
        F.from_csv(_without_end(value), schema, _QUOTES).alias("r")).select("r.*")
    return rows.select(*[_with_end(F.col(f"`{c.replace('`', '``')}`")).alias(c) for c in columns])


def agent_uris(rows: DataFrame, uri_column: str | None = None) -> DataFrame:
    """
    (agent_id, owner, uri, uri_source) of a CSV table.

    A named column is used if the table has it, its empty values too; otherwise the first of
    the known columns that is not empty.
    """
    text = lambda c: F.coalesce(F.col(c), F.lit("")) if c in rows.columns else F.lit("")
    if uri_column is not None and uri_column in rows.columns:
        uri, source = text(uri_column), F.lit(uri_column)
    else:
        present = [c for c in URI_COLUMNS if c in rows.columns]
        uri = F.coalesce(*[F.nullif(F.col(c), F.lit("")) for c in present], F.lit(""))
        source = F.coalesce(*[F.when(F.nullif(F.col(c), F.lit("")).isNotNull(), c)
                              for c in present], F.lit(""))
    return rows.select(text("agent_id").alias("agent_id"), text("owner").alias("owner"),
                       uri.alias("uri"), source.alias("uri_source"))


def uris_from_text(spark: SparkSession, path: str) -> DataFrame:
    """
    One URI per line; the line number is the agent id.

    Lines keep their order within a file and files are taken in the order of their names.
    """
    lines = spark.read.text(path).select(
        F.input_file_name().alias("_file"), F.monotonically_increasing_id().alias("_line"),
        strip(F.col("value")).alias("uri"))
    return numbered(lines, ["_file", "_line"]).select(
        F.col("position").cast("string").alias("agent_id"), F.lit("").alias("owner"), "uri",
        F.lit("txt").alias("uri_source"))


def write_table(df: DataFrame, path: str, columns: Sequence[str], append: bool = False) -> None:
    """
    Fixed column order; a resumed run appends to what is there.

    Values are written as they are: Spark's writer would cut white space and controls at both ends.
    """
    df.select(*columns).write.csv(path, header=True, quote='"', escape='"', emptyValue="",
                                  ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
                                  mode="append" if append else "overwrite")
