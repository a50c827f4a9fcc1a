"""Log scans, decoding, deduplication, continuous ingest and samples."""

from __future__ import annotations

import contextlib

from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rollcall.constants import ANCHOR_BLOCK, ANCHOR_EPOCH_SECONDS, TOPIC_METADATA_SET, \
    ZERO_ADDRESS
from rollcall.operators import blocktime, decode, dedupe, sample
from rollcall.plans import bindings as b
from rollcall.plans.catalog import query
from rollcall.session import fresh_path, materialise
from rollcall.sources import logs
from rollcall.streaming import ingest

_DECODED = ["event_type", "agent_id", "block_number", "tx_hash", "log_index", "owner",
            "from_address", "agent_uri", "metadata_key", "metadata_value", "sanitized"]


@query("decode_logs", f"WITH {b.DECODED_SQL} SELECT {', '.join(_DECODED)} FROM decoded")
def decode_logs(spark, sf_dir):
    return decode.decode_logs(b.raw_logs(spark, sf_dir)).select(*_DECODED) \
        .withColumn("log_index", F.col("log_index").cast("bigint"))


@query("unknown_logs", f"""WITH {b.DECODED_SQL} SELECT
    CASE WHEN source_type = 'error' THEN 'unknown topic0' WHEN source_type = 'purchase'
        THEN 'topic missing or not a number' ELSE 'past the end' END AS reason,
    agent_id IS NOT NULL AS keeps_id, true AS keeps_raw, count(*) AS n
    FROM decoded WHERE event_type = 'unknown' GROUP BY ALL""")
def unknown_logs(spark, sf_dir):
    """Where undecodable logs end up, and that their payload is kept."""
    rows = decode.keep_raw_when_needed(decode.decode_logs(b.raw_logs(spark, sf_dir)))
    reason = F.regexp_replace("decode_error", "^(offset|length) past the end$|^data too short$",
                              "past the end")
    return rows.where("event_type = 'unknown'").groupBy(
        reason.alias("reason"), F.col("agent_id").isNotNull().alias("keeps_id"),
        F.col("raw_data").isNotNull().alias("keeps_raw")).agg(F.count(F.lit(1)).alias("n"))


def metadata_logs(spark, sf_dir):
    """Whole document texts as metadata values, ABI-encoded."""
    word = lambda number: F.lpad(F.lower(F.hex(number)), 64, "0")
    docs = b.table(spark, sf_dir, "documents").select(
        "doc_id", F.lower(F.hex(F.encode(
            F.when(F.col("doc_id") % 2 == 0, F.col("text"))
            .otherwise(F.replace(F.col("text"), F.lit("\n"), F.lit(" "))), "UTF-8"))).alias("hex"))
    bytes_long = (F.char_length("hex") / 2).cast("bigint")
    padded = F.rpad(F.col("hex"), (F.ceil(F.char_length("hex") / 64.0) * 64).cast("int"), "0")
    data = F.concat(F.lit("0x"), word(F.lit(64)), word(F.lit(128)), word(F.lit(4)),
                    F.lit("6e6f7465".ljust(64, "0")), word(bytes_long), padded)
    return docs.select(
        F.lit("").alias("address"),
        F.array(F.lit(TOPIC_METADATA_SET), F.concat(F.lit("0x"), word(F.col("doc_id"))),
                F.lit("0x00")).alias("topics"),
        data.alias("data"), F.concat(F.lit("0x"), F.hex(F.col("doc_id"))).alias("blockNumber"),
        F.concat(F.lit("0x"), F.col("doc_id").cast("string")).alias("transactionHash"),
        F.lit("0x0").alias("logIndex"))


@query("decode_metadata_texts", r"""SELECT CAST(doc_id AS VARCHAR) AS agent_id,
    'note' AS metadata_key, CASE WHEN regexp_full_match(t, '(?:[^\p{C}\p{Z}]| )+')
        THEN t ELSE '0x' || lower(hex(encode(t))) END AS metadata_value
    FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text
        ELSE replace(text, chr(10), ' ') END AS t FROM documents)""")
def decode_metadata_texts(spark, sf_dir):
    return decode.decode_logs(metadata_logs(spark, sf_dir)) \
        .select("agent_id", "metadata_key", "metadata_value")


@query("scan_logs", f"""WITH {b.DECODED_SQL} SELECT tx_hash, block_number FROM decoded
    WHERE source_type IN ('signup', 'view') AND block_number
        BETWEEN {ANCHOR_BLOCK + 100_000} AND {ANCHOR_BLOCK + 600_000}""")
def scan_logs(spark, sf_dir):
    """Logs are stored with columns that scans can skip by, then one range is read."""
    path = fresh_path(spark, "logs")
    logs.write_logs(b.raw_logs(spark, sf_dir), path, 250_000)
    rows = logs.scan_logs(logs.stored_logs(spark, path), ANCHOR_BLOCK + 100_000,
                          ANCHOR_BLOCK + 600_000,
                          [decode.TOPIC_REGISTERED, decode.TOPIC_URI_UPDATED],
                          range_blocks=250_000)
    return rows.select(F.lower("transactionHash").alias("tx_hash"), "block_number")


@query("recent_logs", f"""WITH {b.DECODED_SQL} SELECT tx_hash, block_number FROM decoded
    ORDER BY block_number DESC, log_index DESC LIMIT 300""")
def recent_logs(spark, sf_dir):
    rows = logs.with_block_number(b.raw_logs(spark, sf_dir))
    return logs.recent_logs(rows, 300).select(F.lower("transactionHash").alias("tx_hash"),
                                              "block_number")


@query("ingestible_logs", f"""WITH {b.DECODED_SQL} SELECT source_type = 'error' AS other,
    count(*) AS n FROM decoded WHERE source_type <> 'error' GROUP BY 1""")
def ingestible_logs(spark, sf_dir):
    rows = decode.ingestible(b.raw_logs(spark, sf_dir))
    other = decode.is_ignored_topic(F.get("topics", F.lit(0)))
    return rows.groupBy(other.alias("other")).agg(F.count(F.lit(1)).alias("n"))


@query("log_dedupe", """SELECT l_orderkey, count(DISTINCT l_linenumber) AS n
    FROM lineitem GROUP BY 1""")
def log_dedupe(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    return dedupe.first_of_each(lines, ["l_orderkey", "l_linenumber"]) \
        .groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))


@query("append_new_events", """SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate >= '1998-01-01' EXCEPT SELECT l_orderkey, l_linenumber FROM lineitem
    WHERE l_shipdate < '1998-01-01'""")
def append_new_events(spark, sf_dir):
    lines = b.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    return dedupe.new_rows(lines.where(late), lines.where(~late),
                           ["l_orderkey", "l_linenumber"]).drop("l_shipdate")


@query("replace_checks", """SELECT l_orderkey, l_linenumber, bool_or(late) AS second_pass FROM
    (SELECT DISTINCT l_orderkey, l_linenumber, l_shipdate >= '1998-01-01' AS late FROM lineitem)
    GROUP BY ALL""")
def replace_checks(spark, sf_dir):
    keys = ["l_orderkey", "l_linenumber"]
    late = F.col("l_shipdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    lines = b.table(spark, sf_dir, "lineitem").select(*keys, late.alias("second_pass"))
    first = dedupe.first_of_each(lines.where("NOT second_pass"), keys)
    return dedupe.replace_rows(first, lines.where("second_pass"), keys)


@query("ingest_counters", f"""WITH {b.DECODED_SQL}, chunk AS (SELECT * FROM decoded
        WHERE ts >= '2024-01-15'), old AS (SELECT tx_hash FROM decoded WHERE ts < '2024-01-20')
    SELECT count(*) AS events, count(*) FILTER (WHERE tx_hash NOT IN (SELECT tx_hash FROM old))
        AS inserted, count(*) FILTER (WHERE tx_hash IN (SELECT tx_hash FROM old)) AS already_known,
        count(DISTINCT agent_id) AS agents, count(*) FILTER (WHERE sanitized) AS sanitized
    FROM chunk""")
def ingest_counters(spark, sf_dir):
    """A chunk that overlaps what is stored already."""
    block = lambda day: ANCHOR_BLOCK + (day - 1) * 43_200
    rows = materialise(decode.decode_logs(b.raw_logs(spark, sf_dir)).select(
        "tx_hash", "log_index", "agent_id", "block_number", "sanitized"), "decoded")
    chunk = rows.where(F.col("block_number") >= block(15))
    stored = rows.where(F.col("block_number") < block(20))
    return dedupe.append_counters(chunk, dedupe.new_rows(chunk, stored, dedupe.LOG_KEY))


# --- block times ------------------------------------------------------------------------

# Real block times: exact, but an hour late from the middle of the history on; one in
# nine hundred blocks has no known time.
_TIMES_SQL = f"""WITH {b.DECODED_SQL},
    blocks AS (SELECT DISTINCT block_number, {ANCHOR_EPOCH_SECONDS}
        + (block_number - {ANCHOR_BLOCK}) * 2
        + CASE WHEN block_number > {ANCHOR_BLOCK + 600_000} THEN 3600 ELSE 0 END AS seconds
        FROM decoded WHERE block_number % 900 <> 0),
    chunks AS (SELECT CAST(floor((block_number - {ANCHOR_BLOCK}) / 5000.0) AS BIGINT) AS chunk,
        max(block_number) AS top_block FROM decoded GROUP BY 1),
    drifts AS (SELECT chunk, top_block,
        seconds - ({ANCHOR_EPOCH_SECONDS} + (top_block - {ANCHOR_BLOCK}) * 2) AS drift
        FROM chunks LEFT JOIN blocks ON block_number = top_block)"""


def _block_table(raw):
    numbers = logs.with_block_number(raw).select("block_number").distinct()
    late = F.when(F.col("block_number") > ANCHOR_BLOCK + 600_000, 3600).otherwise(0)
    return numbers.where("block_number % 900 <> 0").withColumn(
        "block_time", F.timestamp_seconds(
            blocktime.predicted_seconds(F.col("block_number")) + late))


@query("block_times", f"""{_TIMES_SQL} SELECT tx_hash, CASE WHEN drift <> 0
        THEN coalesce(seconds, {ANCHOR_EPOCH_SECONDS} + (block_number - {ANCHOR_BLOCK}) * 2)
        ELSE {ANCHOR_EPOCH_SECONDS} + (block_number - {ANCHOR_BLOCK}) * 2 END AS seconds
    FROM decoded JOIN drifts
        ON chunk = CAST(floor((block_number - {ANCHOR_BLOCK}) / 5000.0) AS BIGINT)
    LEFT JOIN blocks USING (block_number)""")
def block_times(spark, sf_dir):
    raw = b.log_table(spark, sf_dir)
    rows = logs.with_block_number(raw).select(
        F.lower("transactionHash").alias("tx_hash"), "block_number")
    return blocktime.with_block_time(rows, _block_table(raw)) \
        .select("tx_hash", F.unix_seconds("block_time").alias("seconds"))


@query("block_clock", f"""{_TIMES_SQL} SELECT count(drift) AS verifications,
    coalesce(max(abs(drift)), 0) AS max_drift_seconds,
    count(*) FILTER (WHERE drift IS NULL) AS unverified_chunks FROM drifts""")
def block_clock(spark, sf_dir):
    raw = b.log_table(spark, sf_dir)
    rows = logs.with_block_number(raw).select("block_number")
    return blocktime.clock_report(blocktime.chunk_drift(rows, _block_table(raw)))


@query("readable_through", """WITH ranges AS (SELECT CAST(day(ts) AS BIGINT) * 100 AS from_block,
        CAST(day(ts) AS BIGINT) * 100 + 99 AS to_block, count(*) FILTER (WHERE event_id % 5000 = 0
            AND day(ts) > 3) = 0 AS readable FROM events GROUP BY ALL)
    SELECT coalesce((SELECT min(from_block) - 1 FROM ranges WHERE NOT readable),
        (SELECT max(to_block) FROM ranges)) AS commit_to""")
def readable_through(spark, sf_dir):
    """Days as block ranges; a day that holds a certain event could not be read."""
    day = F.day("ts").cast("bigint")
    bad = F.count_if((F.col("event_id") % 5000 == 0) & (day > 3))
    ranges = b.table(spark, sf_dir, "events").groupBy((day * 100).alias("from_block")).agg(
        (bad == 0).alias("readable")).withColumn("to_block", F.col("from_block") + 99)
    return logs.readable_through(ranges, 100)


# --- continuous ingest ------------------------------------------------------------------

STREAM_STATE_SQL = f"""{b.DECODED_SQL}, top AS (SELECT max(block_number) - 50 AS height
        FROM decoded WHERE source_type <> 'error'),
    ev AS (SELECT decoded.* FROM decoded, top WHERE source_type <> 'error'
        AND block_number <= height),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY agent_id, event_type = 'Registered'
            ORDER BY block_number, log_index) AS reg_no,
        row_number() OVER (PARTITION BY agent_id, event_type IN ('Registered', 'URIUpdated')
            ORDER BY block_number DESC, log_index DESC) AS uri_no,
        row_number() OVER (PARTITION BY agent_id, event_type = 'Transfer'
            ORDER BY block_number DESC, log_index DESC) AS hold_no FROM ev),
    tally AS (SELECT agent_id, count(*) FILTER (WHERE event_type = 'URIUpdated') AS uri_changes,
        count(*) FILTER (WHERE event_type = 'Transfer' AND from_address <> '{ZERO_ADDRESS}')
            AS transfers FROM ev GROUP BY 1)
    SELECT reg.agent_id, coalesce(hold.owner, reg.owner) AS owner, reg.owner AS minted_to,
        CAST(transfers AS INT) AS transfer_count, reg.block_number AS registered_block,
        {ANCHOR_EPOCH_SECONDS} + (reg.block_number - {ANCHOR_BLOCK}) * 2 AS registered_at,
        reg.tx_hash AS registered_tx, coalesce(reg.agent_uri, '') AS uri_at_registration,
        coalesce(uri.agent_uri, '') AS current_uri, uri.block_number AS current_uri_block,
        CAST(uri.log_index AS INT) AS current_uri_log_index,
        CAST(uri_changes AS INT) AS uri_change_count
    FROM (SELECT * FROM ranked WHERE event_type = 'Registered' AND reg_no = 1) reg
    LEFT JOIN (SELECT * FROM ranked WHERE event_type IN ('Registered', 'URIUpdated')
        AND uri_no = 1) uri USING (agent_id)
    LEFT JOIN (SELECT * FROM ranked WHERE event_type = 'Transfer' AND hold_no = 1) hold
        USING (agent_id)
    LEFT JOIN tally USING (agent_id)"""


FILE_LOGS = 250_000


def _files(rows) -> int:
    """How many files logs are dealt to: eight, or as many as keep each at a bounded size."""
    return max(8, -(-rows.count() // FILE_LOGS))


@query("stream_ingest", f"WITH {STREAM_STATE_SQL}")
def stream_ingest(spark, sf_dir):
    """
    The logs as files, taken in batch by batch; the last files repeat logs of the first.
    """
    source = fresh_path(spark, "logs")
    raw = b.log_table(spark, sf_dir)
    half = logs.with_block_number(raw).where(F.col("block_number") < ANCHOR_BLOCK + 648_000) \
        .drop("block_number")
    files = _files(raw)
    for rows in (half, raw):
        rows.repartition(files).write.mode("append").parquet(source)
    store = ingest.Store(fresh_path(spark, "store"), range_blocks=500_000)
    run = ingest.start_ingest(spark, source, store, files_per_batch=files)
    run.awaitTermination()
    return ingest.stored_agents(spark, store) \
        .withColumn("registered_at", F.unix_seconds("registered_at"))


RUN_BLOCKS = 500_000


def _bounded(spark, sf_dir):
    """Three runs over stored logs: one of so many blocks, one without time, one to the end."""
    path = fresh_path(spark, "logs")
    logs.write_logs(decode.ingestible(b.raw_logs(spark, sf_dir)), path, 500_000)
    store = ingest.Store(fresh_path(spark, "store"), range_blocks=500_000, merge_every=2)
    ended = []
    for bounds in ({"max_blocks": RUN_BLOCKS}, {"max_seconds": 0}, {}):
        why = ingest.run_blocks(spark, path, store, chunk=400_000, **bounds)
        ended.append((len(ended) + 1, why, ingest.cursor(spark, store).first()["last_block"]))
    return store, ended


@query("bounded_ingest", f"WITH {STREAM_STATE_SQL}")
def bounded_ingest(spark, sf_dir):
    """The state after runs that stop at a block and go on behind it."""
    store, _ = _bounded(spark, sf_dir)
    return ingest.stored_agents(spark, store) \
        .withColumn("registered_at", F.unix_seconds("registered_at"))


@query("bounded_runs", f"""WITH {b.DECODED_SQL}, span AS (
    SELECT min(block_number) AS low, max(block_number) - 50 AS height FROM decoded
    WHERE source_type <> 'error'), runs AS (
    SELECT *, least(low + {RUN_BLOCKS} - 1, height) AS first_end FROM span)
    SELECT 1 AS run, CASE WHEN first_end < height THEN 'max blocks' ELSE 'confirmed' END AS ended,
        first_end AS last_block FROM runs
    UNION ALL SELECT 2, CASE WHEN first_end < height THEN 'max seconds' ELSE 'confirmed' END,
        first_end FROM runs
    UNION ALL SELECT 3, 'confirmed', height FROM runs""")
def bounded_runs(spark, sf_dir):
    """Why each of the runs ended, and the cursor behind it."""
    _, ended = _bounded(spark, sf_dir)
    return spark.createDataFrame(ended, "run int, ended string, last_block bigint")


@query("stream_gap", f"""WITH {STREAM_STATE_SQL.replace(
    "max(block_number) - 50 AS height", f"max({ANCHOR_BLOCK} + 299999) AS height")}""")
def stream_gap(spark, sf_dir):
    """The same logs with a range that could not be read: nothing behind it is taken in."""
    source = fresh_path(spark, "logs")
    files = _files(b.table(spark, sf_dir, "events"))
    b.raw_logs(spark, sf_dir).repartition(files).write.parquet(source)
    store = ingest.Store(fresh_path(spark, "store"), range_blocks=500_000)
    first = F.col("id") * 100_000 + ANCHOR_BLOCK
    ranges = spark.range(0, 40).select(
        first.alias("from_block"), (first + 99_999).alias("to_block"),
        (F.col("id") != 3).alias("readable"))
    ingest.start_ingest(spark, source, store, ranges=ranges).awaitTermination()
    return ingest.stored_agents(spark, store) \
        .withColumn("registered_at", F.unix_seconds("registered_at"))


@query("stall_report", f"""WITH {b.DECODED_SQL} SELECT 'never run' AS store, true AS stalled,
    CAST(NULL AS VARCHAR) AS status, CAST(NULL AS BIGINT) AS last_block
    UNION ALL SELECT 'just run', false, 'ok', max(block_number) - 50 FROM decoded
    WHERE source_type <> 'error'
    UNION ALL SELECT 'failed', true, 'error', NULL""")
def stall_report(spark, sf_dir):
    """Three stores: one that nothing was taken into, one that is up to date, one that failed."""
    batch = b.log_table(spark, sf_dir)
    stores = {n: ingest.Store(fresh_path(spark, "store"), range_blocks=500_000)
              for n in ("never run", "just run", "failed")}
    ingest.ingest_batch(batch, 0, stores["just run"], ingest.Settings())
    broken = batch.withColumn("data", F.assert_true(F.col("blockNumber") == "").cast("string"))
    with contextlib.suppress(PySparkException):
        ingest.ingest_batch(broken, 0, stores["failed"], ingest.Settings())
    rows = [ingest.stall_report(spark, s).crossJoin(ingest.last_run(spark, s))
            .crossJoin(ingest.cursor(spark, s)).select(
                F.lit(n).alias("store"), "stalled", "status", "last_block")
            for n, s in stores.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


# --- samples ----------------------------------------------------------------------------

@query("sample_every_53", """SELECT event_id FROM (SELECT event_id,
    row_number() OVER (ORDER BY ts, event_id) AS n FROM events) WHERE n % 53 = 0""")
def sample_every_53(spark, sf_dir):
    return sample.every_nth(b.table(spark, sf_dir, "events").select("ts", "event_id"), 53,
                            ["ts", "event_id"]).select("event_id")


@query("last_events", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 100")
def last_events(spark, sf_dir):
    return sample.last_rows(b.table(spark, sf_dir, "events").select("ts", "event_id"), 100,
                            ["ts", "event_id"]).select("event_id")


_HASH = "('0x' || substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8))::BIGINT"


@query("panel_hash", f"SELECT CAST(o_orderkey AS VARCHAR) AS agent_id FROM orders "
                     f"WHERE {_HASH} < 4294967296 // 7")
def panel_hash(spark, sf_dir):
    agents = b.table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string")
                                                     .alias("agent_id"))
    return sample.panel_candidates(agents, 7)


def _panel_agents(spark, sf_dir):
    """Orders as agents. Those of 1995 joined the panel earlier, at a rate of one in five."""
    agents = b.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("agent_id"),
        F.col("o_custkey").cast("string").alias("owner"),
        F.col("o_orderdate").cast("timestamp").alias("registered_at"),
        F.when(F.col("o_orderkey") % 5 == 0, "").otherwise("https://a.test").alias("current_uri"),
        (F.col("o_orderkey") % 3).cast("int").alias("uri_change_count"))
    early = F.year("registered_at") == 1995
    joined = early & (sample.panel_hash(F.col("agent_id")) < sample.PANEL_HASH_SPACE // 5)
    return agents.withColumns({
        "in_panel": joined,
        "panel_added_at": F.when(joined, F.col("registered_at")),
        "panel_stratum": F.when(joined, "early")})


_PANEL_SQL = f"""WITH base AS (SELECT CAST(o_orderkey AS VARCHAR) AS agent_id, o_orderkey,
        o_custkey, strftime(o_orderdate, '%Y-%m') AS month, {_HASH} AS h,
        year(o_orderdate) = 1995 AND {_HASH} < 4294967296 // 5 AS early FROM orders),
    rated AS (SELECT *, greatest(1, CAST(round_even((SELECT count(*) FROM base) / 1500.0, 0)
        AS BIGINT)) AS rate FROM base),
    panel AS (SELECT *, early OR h < 4294967296 // rate AS in_panel,
        CASE WHEN early THEN 'early' WHEN h < 4294967296 // rate THEN month END AS stratum
        FROM rated)"""


@query("panel_growth", f"{_PANEL_SQL} SELECT agent_id, in_panel, stratum AS panel_stratum FROM panel")
def panel_growth(spark, sf_dir):
    return sample.draw_panel(_panel_agents(spark, sf_dir), target=1500) \
        .select("agent_id", "in_panel", "panel_stratum")


@query("panel_dry_run", """SELECT count(*) AS agents, count(*) FILTER (WHERE early)
        AS already_in_panel, count(*) FILTER (WHERE NOT early AND h < 4294967296 // 10) AS would_add,
        count(*) FILTER (WHERE early OR h < 4294967296 // 10) AS panel_would_become
    FROM """ + f"""(SELECT {_HASH} AS h, year(o_orderdate) = 1995 AND {_HASH} < 4294967296 // 5
        AS early FROM orders)""")
def panel_dry_run(spark, sf_dir):
    return sample.panel_dry_run(_panel_agents(spark, sf_dir), 10)


@query("panel_composition", f"""{_PANEL_SQL},
    p AS (SELECT stratum, count(*) AS in_panel FROM panel WHERE in_panel GROUP BY 1),
    r AS (SELECT month AS stratum, count(*) AS n FROM base GROUP BY 1)
    SELECT stratum, in_panel, coalesce(n, 0) AS in_registry,
        CASE WHEN coalesce(n, 0) > 0 THEN floor(100.0 * in_panel / CAST(n AS DOUBLE) * 10000.0 + 0.5)
            / 10000.0 ELSE 0.0 END AS share_pct FROM p LEFT JOIN r USING (stratum)""")
def panel_composition(spark, sf_dir):
    from rollcall.functions.text import round_half_up

    return sample.panel_composition(sample.draw_panel(_panel_agents(spark, sf_dir), target=1500)) \
        .withColumn("share_pct", round_half_up(F.col("share_pct"), 4))


@query("panel_summary", f"""{_PANEL_SQL} SELECT count(*) FILTER (WHERE o_orderkey % 5 <> 0)
    AS with_uri, count(*) FILTER (WHERE o_orderkey % 3 > 0) AS changed,
    count(DISTINCT o_custkey) AS owners FROM panel WHERE in_panel""")
def panel_summary(spark, sf_dir):
    return sample.panel_summary(sample.draw_panel(_panel_agents(spark, sf_dir), target=1500))


@query("panel_selection", f"""{_PANEL_SQL} SELECT agent_id,
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'https://a.test' END AS current_uri
    FROM panel WHERE in_panel ORDER BY o_orderkey LIMIT 200""")
def panel_selection(spark, sf_dir):
    from rollcall.operators.runs import agents_to_check

    return agents_to_check(sample.draw_panel(_panel_agents(spark, sf_dir), target=1500), limit=200)


