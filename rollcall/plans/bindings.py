"""
The engine's inputs derived from the benchmark tables.

The derivations are written in the SQL that Spark and DuckDB share, so both sides of a
comparison start from the same rows. What the operators then do with them is written twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.constants import STAGES, TOPIC_METADATA_SET, TOPIC_METADATA_UPDATE, \
    TOPIC_REGISTERED, TOPIC_TRANSFER, TOPIC_URI_UPDATED, ZERO_ADDRESS, ANCHOR_BLOCK, \
    REGISTRY_CONTRACT
from rollcall.functions.staging import stage
from rollcall.session import materialise

_SCHEMAS: dict[str, object] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A benchmark table. Its schema is read from the file once per process."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """
    Deal rows out to all cores before costly work on each, whatever their number.

    The benchmark files are one row group each, which a scan cannot cut.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


# --- event log from `events` ------------------------------------------------------------

BLOCK_OF = "CAST(floor(({micros} - 1704067200000000) / 2000000.0) AS BIGINT)"

EVENT_COLUMNS = f"""
    CAST(user_id AS STRING) AS agent_id,
    event_id AS log_index,
    'tx' || CAST(event_id AS STRING) AS tx_hash,
    CASE event_type WHEN 'signup' THEN 'Registered' WHEN 'view' THEN 'URIUpdated'
        WHEN 'purchase' THEN 'Transfer' WHEN 'click' THEN 'MetadataSet'
        ELSE 'unknown' END AS event_type,
    CASE WHEN event_type IN ('signup', 'view', 'purchase')
        THEN 'o' || CAST(event_id % 40 AS STRING) END AS owner,
    CASE WHEN event_type <> 'purchase' THEN NULL WHEN event_id % 3 = 0 THEN '{ZERO_ADDRESS}'
        ELSE 'o' || CAST(event_id % 7 AS STRING) END AS from_address,
    CASE WHEN event_type NOT IN ('signup', 'view') THEN NULL WHEN event_id % 5 = 0 THEN ''
        ELSE 'https://h' || CAST(event_id % 97 AS STRING) || '.test/a' END AS agent_uri,
    ts AS block_time"""


def _split(columns: str) -> list[str]:
    """Split a select list at its top-level commas."""
    parts, depth, start = [], 0, 0
    for i, ch in enumerate(columns):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            parts.append(columns[start:i])
            start = i + 1
    return [p.strip() for p in parts + [columns[start:]] if p.strip()]


def _select(df: DataFrame, columns: str) -> DataFrame:
    return df.selectExpr(*_split(columns))


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    block = BLOCK_OF.format(micros="unix_micros(CAST(ts AS TIMESTAMP))")
    return _select(table(spark, sf_dir, "events"),
                   EVENT_COLUMNS + f", {block} AS block_number")


EVENT_LOG_SQL = f"""event_log AS (
    SELECT {EVENT_COLUMNS}, {BLOCK_OF.format(micros="epoch_us(ts)")} AS block_number
    FROM events)"""


# --- checks: a chain of stages over any table -------------------------------------------

def _flags(conditions: list[str]) -> str:
    """Stage i holds if conditions 1..i hold."""
    parts = []
    for i, (key, _) in enumerate(STAGES):
        chain = " AND ".join(f"({c})" for c in conditions[:i + 1])
        parts.append(f"({chain}) AS {key}")
    return ", ".join(parts)


_FAILURES = """CASE
    WHEN {censored} THEN CASE WHEN {id} % 3 = 0 THEN 'robots_disallowed'
        WHEN {id} % 3 = 1 THEN 'undetermined' ELSE 'excluded_by_request' END
    WHEN live_strict THEN NULL
    WHEN s6_endpoint_alive THEN 'generic_hosts_only'
    WHEN s5_has_services THEN 'all_endpoints_dead'
    WHEN s4_schema_match THEN 'no_services'
    WHEN s3_valid_json THEN 'schema_mismatch'
    WHEN s2_resolved THEN 'not_json'
    WHEN s1_uri_present THEN CASE WHEN {id} % 2 = 0 THEN 'http_404_not_found'
        ELSE 'timeout_read' END
    ELSE 'empty_uri' END AS failure_category,
    (s6_endpoint_alive AND NOT live_strict) AS generic_only,
    CASE WHEN s5_has_services THEN {id} % 4 + 1 ELSE 0 END AS endpoints_total,
    CASE WHEN s6_endpoint_alive THEN {id} % 2 + 1 ELSE 0 END AS endpoints_ok,
    CASE WHEN live_strict THEN 1 ELSE 0 END AS endpoints_ok_specific"""

_STAGE_COUNT = " + ".join(f"CASE WHEN {key} THEN 1 ELSE 0 END" for key, _ in STAGES[:6])

ORDER_BASE = "o_orderkey AS id, CAST(o_orderkey AS STRING) AS agent_id, " \
    "CASE WHEN o_custkey % 50 = 0 THEN '' ELSE 'O' || CAST(o_custkey AS STRING) END AS owner, " \
    "o_orderdate AS registered_at, o_orderstatus AS state, " + _flags([
        "o_totalprice > 50000", "o_orderkey % 10 <> 0", "o_orderkey % 7 <> 0",
        "o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')", "o_orderkey % 3 <> 0",
        "o_custkey % 4 = 0", "o_orderkey % 13 <> 0"])
ORDER_REST = "*, " + _FAILURES.format(censored="state = 'P'", id="id") \
    + f", ({_STAGE_COUNT}) AS funnel_stage"

def _document_base(first_line: str, last_line: str) -> str:
    return "doc_id AS id, CAST(doc_id AS STRING) AS agent_id, " \
        f"CASE WHEN doc_id % 29 = 0 THEN '' ELSE 'O' || md5({first_line}) END AS owner, " \
        "CASE WHEN doc_id % 31 = 0 THEN NULL WHEN doc_id % 17 = 0 THEN 'ipfs.io' " \
        f"ELSE md5({last_line}) || '.test' END AS uri_root_domain, " + _flags([
            "n_chars > 300", "doc_id % 11 <> 0", "lang <> 'de'", "doc_id % 3 <> 0",
            "n_chars > 600", "doc_id % 4 <> 1", "doc_id % 5 <> 0"])


DOCUMENT_BASE = _document_base("split_part(text, chr(10), 1)", "split_part(text, chr(10), -1)")
# The same rows in Spark, whose split_part cuts a whole text by a pattern to give one part of it;
# this looks for one line break, from the start or from the end.
_SPARK_DOCUMENT_BASE = _document_base("substring_index(text, chr(10), 1)",
                                      "substring_index(text, chr(10), -1)")
DOCUMENT_REST = "*, " + _FAILURES.format(censored="id % 10 = 7", id="id") \
    + f", ({_STAGE_COUNT}) AS funnel_stage"


def order_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of one run, one per order; owners are customers, months are order dates."""
    return _select(_select(table(spark, sf_dir, "orders"), ORDER_BASE), ORDER_REST)


ORDER_CHECKS_SQL = f"""order_base AS (SELECT {ORDER_BASE} FROM orders),
order_checks AS (SELECT {ORDER_REST} FROM order_base),
analysed AS (SELECT * FROM order_checks WHERE coalesce(failure_category, '') NOT IN
    ('excluded_by_request', 'robots_disallowed', 'undetermined'))"""


def document_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    Checks of one run, one per document; first and last lines tie documents together.

    The keys are made where the texts are read, so no text is ever moved.
    """
    base = _select(table(spark, sf_dir, "documents"), _SPARK_DOCUMENT_BASE)
    # The two keys come from whole texts; compute them once per document.
    keys = {"owner": "_owner", "uri_root_domain": "_root"}
    base = stage(base.withColumnsRenamed(keys), {k: F.col(v) for k, v in keys.items()})
    return _select(base.drop(*keys.values()), DOCUMENT_REST)


def check_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    The same checks as a stored table, for jobs that read them more than once.

    They are dealt out by agent, since a file of texts that a scan cannot cut comes in one piece.
    """
    return materialise(document_checks(spark, sf_dir).repartition("agent_id"), "checks")


DOCUMENT_CHECKS_SQL = f"""document_base AS (SELECT {DOCUMENT_BASE} FROM documents),
document_checks AS (SELECT {DOCUMENT_REST} FROM document_base),
analysed AS (SELECT * FROM document_checks WHERE coalesce(failure_category, '') NOT IN
    ('excluded_by_request', 'robots_disallowed', 'undetermined'))"""

# Components of owners and domains, by transitive closure.
PROJECTS_SQL = DOCUMENT_CHECKS_SQL + """,
linked AS (SELECT *, CASE WHEN owner <> '' THEN 'o ' || lower(owner) END AS o,
    CASE WHEN uri_root_domain <> 'ipfs.io' THEN 'd ' || lower(uri_root_domain) END AS d
    FROM analysed),
edges AS (SELECT DISTINCT o AS a, d AS b FROM linked WHERE o IS NOT NULL AND d IS NOT NULL),
arcs AS (SELECT a, b FROM edges UNION ALL SELECT b, a FROM edges),
reach(v, r) AS (SELECT DISTINCT a, a FROM arcs
    UNION SELECT reach.v, arcs.b FROM reach JOIN arcs ON reach.r = arcs.a),
roots AS (SELECT v, min(r) AS root FROM reach GROUP BY v),
projects AS (SELECT linked.*, coalesce(roots.root, o, d, 'a ' || agent_id) AS project
    FROM linked LEFT JOIN roots ON roots.v = coalesce(o, d))"""


# --- check history from `events` --------------------------------------------------------

RUN_BASE = "CAST(day(ts) AS BIGINT) AS id"
RUN_REST = """id, CASE WHEN id % 9 = 0 THEN 'sweep' ELSE 'panel' END AS kind,
    CASE WHEN id % 11 = 0 THEN 'failed' ELSE 'completed' END AS status"""
HISTORY_KEYS = "CAST(day(ts) AS BIGINT) AS run_id, CAST(user_id AS STRING) AS agent_id"


def check_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = table(spark, sf_dir, "events").groupBy(F.expr("CAST(day(ts) AS BIGINT)").alias("id")) \
        .agg(F.min("ts").cast("timestamp").alias("started_at"))
    return days.selectExpr(*_split(RUN_REST + ", started_at"))


def check_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One check per user and day."""
    keyed = table(spark, sf_dir, "events").selectExpr(
        *_split(HISTORY_KEYS + ", ts, event_id, value, props"))
    return keyed.groupBy("run_id", "agent_id").agg(
        F.min("ts").cast("timestamp").alias("checked_at"),
        F.max(F.expr("event_id % 4 <> 0")).alias("live_strict"),
        F.min("event_id").alias("id"),
        F.when(F.min("event_id") % 6 == 0, "undetermined").alias("failure_category"),
        F.sha2(F.max("props"), 256).alias("doc_sha256"))


def history_agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered users; every 25th user id is missing, every 10th has no date."""
    return table(spark, sf_dir, "events").where("user_id % 25 <> 3").select("user_id").distinct() \
        .selectExpr("CAST(user_id AS STRING) AS agent_id",
                    "CASE WHEN user_id % 10 <> 4 THEN CAST(make_date(2023, "
                    "CAST(user_id % 12 + 1 AS INT), 1) AS TIMESTAMP) END AS registered_at")


HISTORY_SQL = f"""runs_base AS (SELECT DISTINCT {RUN_BASE} FROM events),
runs AS (SELECT {RUN_REST} FROM runs_base),
checks AS (SELECT run_id, agent_id, min(epoch_us(ts)) AS seen_at, bool_or(event_id % 4 <> 0) AS live,
    min(event_id) AS id,
    CASE WHEN min(event_id) % 6 = 0 THEN 'undetermined' END AS failure_category,
    max(props) AS props
    FROM (SELECT {HISTORY_KEYS}, ts, event_id, props FROM events) GROUP BY run_id, agent_id),
agents AS (SELECT DISTINCT CAST(user_id AS STRING) AS agent_id,
    CASE WHEN user_id % 10 <> 4 THEN '2023-' || lpad(CAST(user_id % 12 + 1 AS STRING), 2, '0')
    END AS month FROM events WHERE user_id % 25 <> 3),
history AS (SELECT checks.agent_id, seen_at, live, month, failure_category FROM checks
    JOIN runs ON runs.id = checks.run_id AND kind = 'panel' AND status = 'completed'
    JOIN agents USING (agent_id))"""


# --- undecoded logs from `events` -------------------------------------------------------

UNKNOWN_TOPIC = "0x" + "ee" * 32


def _word(number: str) -> str:
    return f"lpad(lower(hex({number})), 64, '0')"


def _padded(digits: str) -> str:
    """Hex digits filled up to whole words."""
    return f"rpad({digits}, CAST(ceil(length({digits}) / 64.0) * 64 AS INT), '0')"


def raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """
    One ABI-encoded log per event, with the faults a registry shows: cut-off payloads, missing
    topics, NUL characters, unknown signatures, ids beyond 64 bits.
    """
    block = BLOCK_OF.format(micros="unix_micros(CAST(ts AS TIMESTAMP))")
    base = spread(table(spark, sf_dir, "events")).selectExpr(
        "event_id", "user_id", "event_type", "props", f"{block} + {ANCHOR_BLOCK} AS block",
        "CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 23 = 0 "
        "THEN 'https://h' || (event_id % 97) || '.t' || chr(0) || 'est/ü' "
        "ELSE 'https://h' || (event_id % 97) || '.test/ü' END AS uri",
        "'k' || (event_id % 3) AS meta_key",
        "CASE event_id % 3 WHEN 0 THEN lower(hex(concat(chr(1), props))) "
        "WHEN 1 THEN lower(hex(props)) ELSE '' END AS meta_hex")
    wide = f"CASE WHEN event_id % 19 = 0 THEN lpad(lower(hex(user_id)) || repeat('0', 16), 64, '0')" \
           f" ELSE {_word('user_id')} END"
    holder = "repeat('0', 24) || 'AB' || lpad(hex(event_id % 40), 38, '0')"
    sender = "repeat('0', 24) || CASE WHEN event_id % 3 = 0 THEN repeat('0', 40) " \
             "ELSE lpad(hex(event_id % 7 + 1), 40, '0') END"
    staged = base.selectExpr("*", f"'0x' || {wide} AS id_topic", f"'0x' || {holder} AS holder",
                             f"'0x' || {sender} AS sender", "lower(hex(uri)) AS uri_hex",
                             "lower(hex(meta_key)) AS key_hex")
    text_data = f"{_word('32')} || {_word('CAST(length(uri_hex) / 2 AS INT)')} || " \
                f"{_padded('uri_hex')}"
    meta_data = f"{_word('64')} || {_word('128')} || " \
                f"{_word('CAST(length(key_hex) / 2 AS INT)')} || {_padded('key_hex')} || " \
                f"{_word('CAST(length(meta_hex) / 2 AS INT)')} || {_padded('meta_hex')}"
    staged = staged.selectExpr("*", f"""CASE WHEN event_type IN ('signup', 'view')
        THEN {text_data} WHEN event_type = 'click' THEN {meta_data} ELSE '' END AS digits""")
    topics = f"""CASE event_type
        WHEN 'signup' THEN array('{TOPIC_REGISTERED}', id_topic, holder)
        WHEN 'view' THEN array(upper('{TOPIC_URI_UPDATED}'), id_topic, holder)
        WHEN 'purchase' THEN CASE WHEN event_id % 37 = 0
            THEN array('{TOPIC_TRANSFER}', sender, holder)
            ELSE array('{TOPIC_TRANSFER}', sender, holder, id_topic) END
        WHEN 'click' THEN array('{TOPIC_METADATA_SET}', id_topic,
            '0x' || lpad(md5(props), 64, '0'))
        ELSE CASE WHEN event_id % 2 = 0 THEN array('{TOPIC_METADATA_UPDATE}', id_topic)
            ELSE array('{UNKNOWN_TOPIC}') END END"""
    return staged.selectExpr(
        f"'{REGISTRY_CONTRACT}' AS address", f"{topics} AS topics",
        "'0x' || CASE WHEN event_id % 31 = 0 "
        "THEN substr(digits, 1, CAST(length(digits) / 2 AS INT)) ELSE digits END AS data",
        "'0x' || lower(hex(block)) AS blockNumber",
        "'0xTX' || event_id AS transactionHash", "'0x' || lower(hex(event_id)) AS logIndex")


def log_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same logs as a stored table, for jobs that read it more than once."""
    return materialise(raw_logs(spark, sf_dir), "logs")


# What decoding those logs must give, from the events themselves.
DECODED_SQL = f"""log_base AS (SELECT *,
    {BLOCK_OF.format(micros="epoch_us(ts)")} + {ANCHOR_BLOCK} AS block_number,
    event_id % 31 = 0 AND event_type IN ('signup', 'view', 'click') AS cut,
    event_id % 37 = 0 AND event_type = 'purchase' AS short,
    CASE WHEN event_id % 19 = 0
        THEN CAST(CAST(user_id AS HUGEINT) * 18446744073709551616 AS VARCHAR)
        ELSE CAST(user_id AS VARCHAR) END AS id_text FROM events),
decoded AS (SELECT
    CASE WHEN cut OR short OR event_type = 'error' THEN 'unknown'
        WHEN event_type = 'signup' THEN 'Registered' WHEN event_type = 'view' THEN 'URIUpdated'
        WHEN event_type = 'purchase' THEN 'Transfer' ELSE 'MetadataSet' END AS event_type,
    CASE WHEN event_type <> 'error' AND NOT short THEN id_text END AS agent_id,
    block_number, '0xtx' || event_id AS tx_hash, CAST(event_id AS BIGINT) AS log_index,
    CASE WHEN event_type IN ('signup', 'view', 'purchase')
        THEN '0xab' || lpad(lower(to_hex(event_id % 40)), 38, '0') END AS owner,
    CASE WHEN event_type <> 'purchase' THEN NULL
        WHEN event_id % 3 = 0 THEN '{ZERO_ADDRESS}'
        ELSE '0x' || lpad(lower(to_hex(event_id % 7 + 1)), 40, '0') END AS from_address,
    CASE WHEN event_type NOT IN ('signup', 'view') OR cut THEN NULL
        WHEN event_id % 5 = 0 THEN ''
        ELSE 'https://h' || (event_id % 97) || '.test/ü' END AS agent_uri,
    CASE WHEN event_type = 'click' AND NOT cut THEN 'k' || (event_id % 3) END AS metadata_key,
    CASE WHEN event_type <> 'click' OR cut THEN NULL
        WHEN event_id % 3 = 0 THEN '0x' || lower(hex(encode(chr(1) || props)))
        WHEN event_id % 3 = 1 THEN props ELSE '0x' END AS metadata_value,
    event_type IN ('signup', 'view') AND NOT cut AND event_id % 5 <> 0 AND event_id % 23 = 0
        AS sanitized,
    ts, event_type AS source_type, event_id
    FROM log_base)"""


# --- documents, fetches and probes from `orders` ----------------------------------------

CANONICAL = "https://eips.ethereum.org/eips/eip-8004#registration-v1"

# Four independent numbers per order: which URI, which answer, which document, which luck.
CASE_COLUMNS = """o_orderkey AS k, o_orderkey % 12 AS u,
    CAST(floor(o_orderkey / 12.0) AS BIGINT) % 10 AS q,
    CAST(floor(o_orderkey / 120.0) AS BIGINT) % 8 AS d,
    o_custkey AS c, o_orderdate AS seen"""


def order_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(spread(table(spark, sf_dir, "orders")), CASE_COLUMNS)


BODY = f"""CASE d
    WHEN 0 THEN '{{"name": "agent ' || k || '"}} trailing'
    WHEN 1 THEN '[1, 2]'
    WHEN 2 THEN '{{"type": "other", "n": ' || k || '}}'
    WHEN 3 THEN '{{"type": "{CANONICAL}", "services": []}}'
    WHEN 4 THEN '{{"type": " {CANONICAL.upper()} ", "skills": [{{"name": "x"}}, 7]}}'
    WHEN 5 THEN '{{"@type": "erc8004:registration", "services": [{{"type": "web", "endpoint": '
        || '"https://s' || c || '.dead.test/a"}}, "https://t.dead.test/", {{"url": "", '
        || '"href": "mailto:x"}}]}}'
    WHEN 6 THEN '{{"type": 5, "registrations": [{{"agentId": ' || k || ', "agentRegistry": '
        || '"EIP155:8453:{REGISTRY_CONTRACT[:10].upper()}{REGISTRY_CONTRACT[10:]}"}}], "services": '
        || '{{"z": "https://github.com/a", "b": {{"url": "https://s' || c || '.test/x"}}}}}}'
    ELSE '{{"type": ["ERC8004:Registration", 1], "endpoints": ["https://e1.test/", '
        || '"https://e2.test/", "https://e3.test/", "https://e4.test/", "https://e5.test/", '
        || '"https://e6.test/"]}}' END"""


def case_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, d, c, body): a document per order, in eight kinds."""
    return order_cases(spark, sf_dir).selectExpr("k", "d", "c", f"{BODY} AS body")


def probe_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both passes of run 1: everyone in pass 1, in pass 2 those that will look throttled."""
    cases = order_cases(spark, sf_dir).selectExpr("*", f"{BODY} AS body")
    first = cases.selectExpr("CAST(1 AS BIGINT) AS run_id", "CAST(k AS STRING) AS agent_id",
                             "1 AS pass", "k", "u", "q", "d", "c", "seen", "body", """CASE
        WHEN u = 0 THEN '' WHEN u = 1 THEN '  ' WHEN u = 2 THEN 'ipfs://ipfs/cid' || k
        WHEN u = 3 THEN 'data:application/json;x=1;base64,' || base64(CAST(body AS BINARY))
        WHEN u = 4 THEN 'ftp://x' WHEN u = 5 THEN 'HTTP://U:p@H' || (c % 97) || '.Site.test:80/a'
        ELSE 'https://a' || (c % 97) || '.b.co.uk/' || k END AS uri""",
                             "CAST(seen AS TIMESTAMP) AS checked_at")
    again = first.where("(u >= 5 AND q = 3) OR (u >= 3 AND u <> 4 AND d = 5 AND c % 2 = 0 "
                        "AND (u = 3 OR q >= 5))").withColumn("pass", F.lit(2))
    return first.unionByName(again)


def fetches(targets: DataFrame) -> DataFrame:
    """The crawler's attempts for those targets."""
    blank = "CAST(NULL AS STRING)"
    web = targets.where("u >= 5").selectExpr(
        "run_id", "agent_id", "pass", "0 AS pos", "uri AS target", "false AS excluded",
        "NOT (q = 4) AS robots_allowed",
        "CASE WHEN q = 0 THEN 404 WHEN q IN (1, 4) THEN NULL WHEN q = 3 THEN "
        "CASE WHEN pass = 1 OR c % 3 = 1 THEN 429 WHEN c % 3 = 2 THEN 404 ELSE 200 END "
        "ELSE 200 END AS status",
        f"CASE WHEN q = 1 THEN 'ReadTimeout' ELSE {blank} END AS error_class",
        "'slow' AS error_message", "CAST(k % 900 AS INT) AS latency_ms",
        "'application/json' AS content_type", "length(body) AS bytes",
        f"CASE WHEN q = 2 THEN ' \\n ' WHEN q IN (0, 1, 4) THEN {blank} ELSE body END AS body")
    ipfs = targets.where("u = 2").selectExpr("*", "explode(array(0, 1, 2, 3, 7)) AS pos").where(
        "pos <= 1 OR (pos = 2 AND q % 3 = 1) OR (pos > 2 AND q % 3 = 1 AND c % 5 = 0)").selectExpr(
        "run_id", "agent_id", "pass", "pos",
        "element_at(array('https://ipfs.io/ipfs/', 'https://dweb.link/ipfs/', "
        "'https://gateway.pinata.cloud/ipfs/', 'https://fourth.test/ipfs/'), "
        "least(pos, 3) + 1) || 'cid' || k AS target",
        "(pos = 1 AND q % 3 = 2) AS excluded", "true AS robots_allowed",
        "CASE WHEN pos = 0 OR (pos = 2 AND c % 5 = 0) THEN 504 "
        "WHEN pos = 1 AND q % 3 = 2 THEN NULL WHEN pos = 7 THEN 404 ELSE 200 END AS status",
        f"{blank} AS error_class", f"{blank} AS error_message",
        "CAST(k % 900 AS INT) AS latency_ms", "'text/plain' AS content_type",
        "length(body) AS bytes",
        "CASE WHEN pos = 1 AND q % 3 = 1 THEN '' ELSE body END AS body")
    return web.unionByName(ipfs)


def endpoint_probes(targets: DataFrame) -> DataFrame:
    """Requests to declared endpoints; some servers refuse HEAD but serve GET."""
    base = targets.where("d >= 5").selectExpr(
        "run_id", "agent_id", "pass", "d", "c", "explode(sequence(0, 4)) AS pos")
    head = base.selectExpr("*", "'HEAD' AS method", """CASE
        WHEN d = 5 AND pos = 0 THEN 500
        WHEN d = 5 THEN CASE WHEN c % 2 = 1 THEN 404 ELSE 429 END
        WHEN d = 6 AND pos = 0 THEN 405
        WHEN d = 6 THEN CASE WHEN c % 3 = 0 THEN 503 ELSE 302 END
        ELSE 200 END AS status""")
    get = head.where("status >= 400").selectExpr(
        "run_id", "agent_id", "pass", "d", "c", "pos", "'GET' AS method", """CASE
        WHEN d = 6 AND pos = 0 THEN 200
        WHEN d = 5 AND pos = 1 AND pass = 2 AND c % 4 = 0 THEN 200
        ELSE status END AS status""")
    return head.unionByName(get).selectExpr(
        "run_id", "agent_id", "pass", "pos", "CAST(NULL AS STRING) AS url", "method",
        "false AS excluded", "true AS robots_allowed", "CAST(status AS INT) AS status",
        "CAST(NULL AS STRING) AS error_class", "CAST(NULL AS STRING) AS error_message",
        "CAST(c % 300 AS INT) AS latency_ms")
