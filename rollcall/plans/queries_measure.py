"""URIs, hosts, documents and graded checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from rollcall.constants import GATEWAYS, GENERIC_HOSTS, HTTP_CATEGORIES, MAX_ENDPOINTS, \
    SHARED_HOSTS
from rollcall.functions import failures, uri
from rollcall.functions.document import analyse_documents
from rollcall.functions.staging import stage
from rollcall.functions.text import sha256_hex
from rollcall.operators import state, verdict
from rollcall.plans import bindings as b
from rollcall.plans.catalog import query
from rollcall.session import materialise

# --- URIs -------------------------------------------------------------------------------

_URI = """CASE k % 9 WHEN 0 THEN '' WHEN 1 THEN chr(9) || ' ' || chr(10)
    WHEN 2 THEN ' HTTPS://a.test/' || k || chr(10) WHEN 3 THEN 'http://a.test'
    WHEN 4 THEN 'IPFS://ipfs/x' || k WHEN 5 THEN '//ipfs/x' || k
    WHEN 6 THEN 'bafy' || repeat('x', CAST(k % 60 AS INT)) WHEN 7 THEN 'Data:,a' ELSE 'AR://x' END"""


def _uris(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k") \
        .selectExpr("k", f"{_URI} AS uri")


@query("uri_scheme", f"""SELECT k, CASE k % 9 WHEN 0 THEN 'empty' WHEN 1 THEN 'empty'
    WHEN 2 THEN 'https' WHEN 3 THEN 'http' WHEN 4 THEN 'ipfs' WHEN 5 THEN 'other'
    WHEN 6 THEN CASE WHEN k % 60 > 36 THEN 'ipfs' ELSE 'other' END WHEN 7 THEN 'data'
    ELSE 'arweave' END AS scheme, trim({_URI}, ' ' || chr(9) || chr(10)) AS clean
    FROM (SELECT o_orderkey AS k FROM orders)""")
def uri_scheme(spark, sf_dir):
    rows = stage(_uris(spark, sf_dir), {"clean": uri.clean_uri(F.col("uri"))})
    return rows.select("k", uri.uri_scheme(F.col("clean")).alias("scheme"), "clean")


@query("gateway_candidates", f"""WITH gw(pos, base) AS (VALUES {', '.join(
        f"({i}, '{g}')" for i, g in enumerate(GATEWAYS))})
    SELECT k, pos, base || CASE k % 9 WHEN 4 THEN 'x' || k
        ELSE 'bafy' || repeat('x', CAST(k % 60 AS INT)) END AS url
    FROM (SELECT o_orderkey AS k FROM orders), gw
    WHERE k % 9 = 4 OR (k % 9 = 6 AND k % 60 > 36)""")
def gateway_candidates(spark, sf_dir):
    rows = stage(_uris(spark, sf_dir), {"clean": uri.clean_uri(F.col("uri"))})
    return rows.where(uri.uri_scheme(F.col("clean")) == "ipfs").select(
        "k", F.posexplode(uri.gateway_urls(F.col("clean"))).alias("pos", "url"))


@query("data_uri_text", """SELECT doc_id, CASE WHEN doc_id % 3 = 2 THEN text || '+%zz ü'
        ELSE text END AS text, CASE doc_id % 3 WHEN 0 THEN 'application/json'
        WHEN 1 THEN 'text/plain' ELSE 'text/html' END AS content_type FROM documents""")
def data_uri_text(spark, sf_dir):
    """Whole document texts as inline URIs: padded and unpadded base64, and percent-coded."""
    docs = b.table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = F.base64(F.encode("text", "UTF-8"))
    percent = F.replace(F.url_encode("text"), F.lit("+"), F.lit("%20"))
    inline = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("data:application/json;a=b;base64,"),
                                                       coded)) \
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("data:;base64,"),
                                                 F.rtrim(coded, F.lit("=")))) \
        .otherwise(F.concat(F.lit("data:text/html,"), percent, F.lit("+%zz%20%C3%BC")))
    rows = stage(docs.select("doc_id", inline.alias("uri")),
                 {"parts": uri.data_uri_parts(F.col("uri"))})
    return rows.select("doc_id", F.col("parts.text").alias("text"),
                       F.col("parts.content_type").alias("content_type"))


# --- hosts ------------------------------------------------------------------------------

_HOST_SQL = r"regexp_extract(url, '^https?://([^/?#:]*)', 1)"


@query("host_and_root_domain", f"""SELECT page_id, {_HOST_SQL} AS host,
    array_to_string(string_split({_HOST_SQL}, '.')[-2:], '.') AS root_domain
    FROM pages""")
def host_and_root_domain(spark, sf_dir):
    rows = stage(b.table(spark, sf_dir, "pages"), {"host": uri.host_of(F.col("url"))})
    return rows.select("page_id", "host", uri.registrable_domain(F.col("host")).alias("root_domain"))


_ODD_HOST = """CASE k % 8 WHEN 0 THEN 'a' || k || '.example.co.uk' WHEN 1 THEN '10.0.0.' || k % 9
    WHEN 2 THEN 'x' || k || '.github.io' WHEN 3 THEN 'b' || k || '.s3.eu-west-1.amazonaws.com'
    WHEN 4 THEN 'deep.a' || k || '.example.com' WHEN 5 THEN 'github.io'
    WHEN 6 THEN 't' || k || '.r2.dev' ELSE 'r2.markets' END"""


@query("tenant_hosts", """SELECT k, CASE k % 8 WHEN 0 THEN 'example.co.uk'
        WHEN 1 THEN '10.0.0.' || k % 9 WHEN 2 THEN 'x' || k || '.github.io'
        WHEN 3 THEN 'b' || k || '.s3.eu-west-1.amazonaws.com' WHEN 4 THEN 'example.com'
        WHEN 5 THEN 'github.io' WHEN 6 THEN 't' || k || '.r2.dev' ELSE 'r2.markets' END
        AS root_domain, k % 8 IN (3, 6) AS is_bucket, k % 8 IN (2, 3, 4, 5, 6) AS is_shared
    FROM (SELECT o_orderkey AS k FROM orders)""")
def tenant_hosts(spark, sf_dir):
    """Two-label suffixes, addresses and storage buckets, from odd URLs of every order."""
    odd = b.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k") \
        .selectExpr("k", f"'HTTPS://U_1:p@' || upper({_ODD_HOST}) || '.:8443/a b?c' AS url")
    rows = stage(odd, {"host": uri.host_of(F.col("url"))})
    return rows.select("k", uri.registrable_domain(F.col("host")).alias("root_domain"),
                       uri.is_bucket_host(F.col("host")).alias("is_bucket"),
                       uri.is_shared_hosting(F.col("host")).alias("is_shared"))


def _listed(names) -> str:
    return " OR ".join(f"host = '{n}' OR suffix(host, '.{n}')" for n in names)


@query("generic_hosts", f"""SELECT host, count(*) AS pages, ({_listed(GENERIC_HOSTS)}) AS generic,
    ({_listed(SHARED_HOSTS)}) AS shared FROM (SELECT {_HOST_SQL} AS host FROM pages) GROUP BY host""")
def generic_hosts(spark, sf_dir):
    return b.table(spark, sf_dir, "pages").groupBy(uri.host_of(F.col("url")).alias("host")).agg(
        F.count(F.lit(1)).alias("pages")).select(
        "host", "pages", uri.is_generic_host(F.col("host")).alias("generic"),
        uri.is_shared_hosting(F.col("host")).alias("shared"))


@query("excluded_hosts", f"""WITH hosts AS (SELECT page_id, {_HOST_SQL} AS host FROM pages),
    listed AS (SELECT DISTINCT regexp_replace(host, '^[^.]*[.]', '') AS name FROM hosts
        WHERE page_id % 5 = 0)
    SELECT page_id, EXISTS (SELECT 1 FROM listed WHERE host = name OR suffix(host, '.' || name))
        AS excluded FROM hosts""")
def excluded_hosts(spark, sf_dir):
    """Exclude what some pages' hosts lie below, everywhere."""
    pages = b.table(spark, sf_dir, "pages").select("page_id", "url")
    asked = pages.where("page_id % 5 = 0").select(
        F.regexp_replace(uri.host_of(F.col("url")), "^[^.]*[.]", "").alias("host"))
    return verdict.mark_excluded(pages, "url", asked).select("page_id", "excluded")


# --- names for failures -----------------------------------------------------------------

_NAMED = " ".join(f"WHEN {code} THEN '{name}'" for code, name in HTTP_CATEGORIES.items())


@query("http_category", f"""SELECT s AS status, CASE s {_NAMED} ELSE CASE
        WHEN s BETWEEN 300 AND 399 THEN 'http_' || s || '_redirect'
        WHEN s BETWEEN 400 AND 499 THEN 'http_' || s || '_client_error'
        WHEN s >= 500 THEN 'http_' || s || '_server_error' ELSE 'http_' || s END END AS category,
    count(*) AS n FROM (SELECT 100 + o_orderkey % 520 AS s FROM orders) GROUP BY 1, 2""")
def http_category(spark, sf_dir):
    return b.table(spark, sf_dir, "orders").selectExpr("100 + o_orderkey % 520 AS status") \
        .groupBy("status").agg(F.count(F.lit(1)).alias("n")) \
        .withColumn("category", failures.http_category(F.col("status")))


_ERRORS = [("ConnectTimeout", "", "timeout_connect"), ("ReadTimeout", "x", "timeout_read"),
           ("PoolTimeout", "", "timeout_pool"), ("WriteTimeout", "", "timeout_other"),
           ("ConnectError", "[Errno -2] Name or service not known", "dns_failure"),
           ("ConnectError", "CERTIFICATE_VERIFY failed", "tls_failure"),
           ("ConnectError", "refused", "connect_failure"),
           ("SSLZeroReturnError", "", "tls_failure"),
           ("TooManyRedirects", "", "too_many_redirects"),
           ("RemoteProtocolError", "", "protocol_error"),
           ("UnsupportedProtocol", "", "unsupported_scheme"),
           ("UnicodeError", "label too long", "bad_hostname"),
           ("ReadError", "", "transport_readerror")]


def _error_case(i: int) -> str:
    return "CASE k % 13 " + " ".join(f"WHEN {n} THEN '{e[i]}'" for n, e in enumerate(_ERRORS)) + " END"


@query("error_category", f"""SELECT {_error_case(2)} AS category, count(*) AS n
    FROM (SELECT o_orderkey AS k FROM orders) GROUP BY 1""")
def error_category(spark, sf_dir):
    rows = b.table(spark, sf_dir, "orders").selectExpr("o_orderkey AS k").selectExpr(
        f"{_error_case(0)} AS error_class", f"{_error_case(1)} AS message")
    return rows.groupBy(failures.error_category(F.col("error_class"), F.col("message"))
                        .alias("category")).agg(F.count(F.lit(1)).alias("n"))


# --- documents --------------------------------------------------------------------------

@query("json_object_test", """SELECT 'event' AS source, CAST(NULL AS VARCHAR) AS category,
        count(*) AS n FROM events
    UNION ALL SELECT 'text', 'not_json', count(*) FROM documents
    UNION ALL SELECT 'html', 'not_json', count(*) FROM pages
    UNION ALL SELECT 'list', 'json_not_object', count(*) FROM events
    UNION ALL SELECT 'tail', 'not_json', count(*) FROM events""")
def json_object_test(spark, sf_dir):
    """Whole texts of three tables; event properties as they are, in a list, and with a tail."""
    props = b.table(spark, sf_dir, "events").select("props")
    bodies = props.select(F.lit("event").alias("source"), F.col("props").alias("body")) \
        .unionByName(props.select(F.lit("list").alias("source"),
                                  F.concat(F.lit("["), "props", F.lit("]")).alias("body"))) \
        .unionByName(props.select(F.lit("tail").alias("source"),
                                  F.concat("props", F.lit("] x")).alias("body"))) \
        .unionByName(b.table(spark, sf_dir, "documents")
                     .select(F.lit("text").alias("source"), F.col("text").alias("body"))) \
        .unionByName(b.table(spark, sf_dir, "pages")
                     .select(F.lit("html").alias("source"), F.col("html").alias("body")))
    return analyse_documents(bodies, "body").groupBy(
        "source", F.col("analysis.json_category").alias("category")).agg(
        F.count(F.lit(1)).alias("n"))


@query("document_analysis", f"""SELECT k,
    CASE d WHEN 0 THEN 'not_json' WHEN 1 THEN 'json_not_object' END AS category,
    CASE d WHEN 2 THEN 'other' WHEN 3 THEN '{b.CANONICAL}' WHEN 4 THEN ' {b.CANONICAL.upper()} '
        WHEN 5 THEN 'erc8004:registration' WHEN 7 THEN 'ERC8004:Registration' ELSE '' END AS type,
    d IN (3, 4, 5, 7) AS canonical, d = 6 AS registry_present, d = 6 AS registry_matches,
    d >= 3 AS schema_match,
    CASE d WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN 2 WHEN 7 THEN 6 ELSE 0 END AS services,
    CASE d WHEN 5 THEN 3 WHEN 6 THEN 2 WHEN 7 THEN 6 ELSE 0 END AS endpoints,
    CASE d WHEN 5 THEN 'https://s' || c || '.dead.test/a https://t.dead.test/ mailto:x'
        WHEN 6 THEN 'https://github.com/a https://s' || c || '.test/x'
        WHEN 7 THEN 'https://e1.test/ https://e2.test/ https://e3.test/ https://e4.test/ '
            || 'https://e5.test/' ELSE '' END AS urls
    FROM (SELECT {b.CASE_COLUMNS} FROM orders)""")
def document_analysis(spark, sf_dir):
    found = F.col("analysis")
    return analyse_documents(b.case_documents(spark, sf_dir), "body").select(
        "k", found["json_category"].alias("category"), found["type_field_raw"].alias("type"),
        found["type_is_canonical"].alias("canonical"),
        found["registry_field_present"].alias("registry_present"),
        found["registry_field_matches"].alias("registry_matches"),
        found["schema_match"].alias("schema_match"), found["services_count"].alias("services"),
        found["endpoints_total"].alias("endpoints"),
        F.array_join(found["urls"], " ").alias("urls"))


@query("doc_fingerprint", "SELECT doc_id, sha256(text) AS doc_sha256 FROM documents")
def doc_fingerprint(spark, sf_dir):
    return b.table(spark, sf_dir, "documents").select(
        "doc_id", sha256_hex(F.col("text")).alias("doc_sha256"))


# --- graded checks ----------------------------------------------------------------------

# The outcome of every case by construction. `reached` says whether a document came back.
GRADED_SQL = f"""cases AS (SELECT {b.CASE_COLUMNS} FROM orders),
    passes AS (SELECT *, 1 AS pass FROM cases UNION ALL SELECT *, 2 FROM cases
        WHERE (u >= 5 AND q = 3) OR (u >= 3 AND u <> 4 AND d = 5 AND c % 2 = 0
            AND (u = 3 OR q >= 5))),
    fetched AS (SELECT *, CASE WHEN u IN (0, 1) THEN 'empty_uri' WHEN u = 4 THEN 'unsupported_scheme'
        WHEN u = 2 THEN CASE WHEN q % 3 = 2 THEN 'excluded_by_request' END
        WHEN u = 3 THEN NULL
        WHEN q = 0 THEN 'http_404_not_found' WHEN q = 1 THEN 'timeout_read'
        WHEN q = 2 THEN 'empty_body' WHEN q = 4 THEN 'robots_disallowed'
        WHEN q = 3 THEN CASE WHEN pass = 1 OR c % 3 = 1 THEN 'http_429_rate_limited'
            WHEN c % 3 = 2 THEN 'http_404_not_found' END END AS miss FROM passes),
    probed AS (SELECT *, CASE d WHEN 5 THEN CASE WHEN pass = 2 AND c % 2 = 0 AND c % 4 = 0 THEN 1
                ELSE 0 END
            WHEN 6 THEN CASE WHEN c % 3 = 0 THEN 1 ELSE 2 END WHEN 7 THEN 5 END AS ok,
        CASE d WHEN 5 THEN CASE WHEN pass = 2 AND c % 2 = 0 AND c % 4 = 0 THEN 1 ELSE 0 END
            WHEN 6 THEN CASE WHEN c % 3 = 0 THEN 0 ELSE 1 END WHEN 7 THEN 5 END AS specific
        FROM fetched),
    graded AS (SELECT k, u, q, d, c, pass, CASE WHEN miss = 'empty_uri' THEN 0
            WHEN miss IS NOT NULL THEN 1 WHEN d IN (0, 1) THEN 2 WHEN d = 2 THEN 3
            WHEN d IN (3, 4) THEN 4 WHEN ok = 0 THEN 5 ELSE 6 END AS stage,
        CASE WHEN miss IS NOT NULL THEN miss WHEN d = 0 THEN 'not_json'
            WHEN d = 1 THEN 'json_not_object' WHEN d = 2 THEN 'schema_mismatch'
            WHEN d = 3 THEN 'no_services' WHEN d = 4 THEN 'services_without_urls'
            WHEN ok = 0 THEN 'all_endpoints_dead' WHEN specific = 0 THEN 'generic_hosts_only'
            END AS category,
        miss IS NULL AND coalesce(specific, 0) > 0 AS live,
        CASE WHEN miss IS NULL AND d >= 4 THEN CASE d WHEN 4 THEN 2 WHEN 5 THEN 3 WHEN 6 THEN 2
            ELSE 6 END ELSE 0 END AS services,
        CASE WHEN miss IS NULL AND d >= 5 THEN CASE d WHEN 5 THEN 3 WHEN 6 THEN 2 ELSE 6 END
            ELSE 0 END AS endpoints,
        CASE WHEN miss IS NULL THEN coalesce(ok, 0) ELSE 0 END AS ok,
        CASE WHEN miss IS NULL THEN coalesce(specific, 0) ELSE 0 END AS specific,
        CASE WHEN u = 2 THEN CASE WHEN q % 3 = 2 THEN 504 ELSE 200 END
            WHEN u < 5 OR q IN (1, 4) THEN NULL WHEN q = 0 THEN 404
            WHEN q = 3 THEN CASE WHEN pass = 1 OR c % 3 = 1 THEN 429 WHEN c % 3 = 2 THEN 404
                ELSE 200 END ELSE 200 END AS status
        FROM probed),
    throttled AS (SELECT *, category = 'http_429_rate_limited'
            OR (category = 'all_endpoints_dead' AND c % 2 = 0) AS slow FROM graded)"""


def _graded(spark, sf_dir):
    targets = materialise(b.probe_targets(spark, sf_dir), "targets")
    return verdict.grade(targets.select("run_id", "agent_id", "pass", "uri", "checked_at"),
                         b.fetches(targets), b.endpoint_probes(targets))


@query("verdict", f"""WITH {GRADED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id, pass,
    stage AS funnel_stage, category AS failure_category, live AS live_strict,
    ok > 0 AND specific = 0 AS generic_only, services AS services_count,
    endpoints AS endpoints_total, least(endpoints, {MAX_ENDPOINTS}) AS endpoints_checked,
    ok AS endpoints_ok, specific AS endpoints_ok_specific, status AS http_status,
    CASE WHEN category IS NULL THEN NULL ELSE least(stage + 1, 6) END AS failure_stage
    FROM graded""")
def graded_checks(spark, sf_dir):
    return _graded(spark, sf_dir).select(
        "agent_id", "pass", F.col("funnel_stage").cast("int"), "failure_category", "live_strict",
        "generic_only", "services_count", "endpoints_total", "endpoints_checked", "endpoints_ok",
        "endpoints_ok_specific", "http_status", F.col("failure_stage").cast("int"))


@query("document_selection", f"""WITH {GRADED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id, pass,
    CASE WHEN u = 2 THEN CASE q % 3 WHEN 0 THEN 'https://dweb.link/ipfs/cid' || k
            WHEN 1 THEN CASE WHEN c % 5 = 0 THEN 'https://fourth.test/ipfs/cid' || k
                ELSE 'https://gateway.pinata.cloud/ipfs/cid' || k END
            ELSE 'https://ipfs.io/ipfs/cid' || k END
        WHEN u = 3 THEN 'inline' WHEN u >= 5 AND q <> 4 THEN CASE WHEN u = 5
            THEN 'HTTP://U:p@H' || (c % 97) || '.Site.test:80/a'
            ELSE 'https://a' || (c % 97) || '.b.co.uk/' || k END END AS resolved_url,
    CASE WHEN stage > 1 OR category = 'empty_uri' THEN NULL
        WHEN category = 'unsupported_scheme' THEN 'other'
        WHEN category = 'excluded_by_request' THEN 'dweb.link'
        WHEN category IN ('robots_disallowed', 'empty_body') THEN CASE WHEN u = 5
            THEN 'h' || (c % 97) || '.site.test' ELSE 'a' || (c % 97) || '.b.co.uk' END
        WHEN category = 'timeout_read' THEN 'ReadTimeout: slow'
        WHEN category IN ('http_404_not_found', 'http_429_rate_limited') THEN status || ' from '
            || CASE WHEN u = 5 THEN 'h' || (c % 97) || '.site.test'
                ELSE 'a' || (c % 97) || '.b.co.uk' END END AS failure_detail
    FROM graded""")
def document_selection(spark, sf_dir):
    return _graded(spark, sf_dir).select(
        "agent_id", "pass", "resolved_url",
        F.when(F.col("funnel_stage") <= 1, F.col("failure_detail")).alias("failure_detail"))


@query("endpoint_rollup", f"""WITH {GRADED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id, pass,
    CASE d WHEN 5 THEN '500 ' || CASE WHEN c % 2 = 1 THEN '404'
            WHEN pass = 2 AND c % 4 = 0 THEN '200' ELSE '429' END || ' unsupported_scheme'
        WHEN 6 THEN '200 ' || CASE WHEN c % 3 = 0 THEN '503' ELSE '302' END
        ELSE '200 200 200 200 200' END AS statuses,
    CASE d WHEN 5 THEN '' WHEN 6 THEN 'github.com' ELSE '' END AS generic
    FROM graded WHERE endpoints > 0""")
def endpoint_rollup(spark, sf_dir):
    details = F.col("endpoint_details")
    return _graded(spark, sf_dir).where(details.isNotNull()).select(
        "agent_id", "pass",
        F.array_join(F.transform(details, lambda e: e["status"]), " ").alias("statuses"),
        F.array_join(F.transform(F.filter(details, lambda e: e["generic"]), lambda e: e["host"]),
                     " ").alias("generic"))


_RECONCILED_SQL = f"""{GRADED_SQL},
    first AS (SELECT * FROM throttled WHERE pass = 1), second AS (SELECT * FROM throttled
        WHERE pass = 2),
    final AS (SELECT first.k, coalesce(first.slow, false) AND second.k IS NOT NULL AS retried,
        CASE WHEN coalesce(first.slow, false) AND second.k IS NOT NULL THEN
            CASE WHEN second.slow THEN 'undetermined' ELSE second.category END
            ELSE first.category END AS category,
        CASE WHEN coalesce(first.slow, false) AND second.k IS NOT NULL THEN second.live
            ELSE first.live END AS live
        FROM first LEFT JOIN second USING (k))"""


@query("retry_reconcile", f"""WITH {_RECONCILED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id,
    retried, category AS failure_category, live AS live_strict FROM final""")
def retry_reconcile(spark, sf_dir):
    return verdict.reconcile(_graded(spark, sf_dir)) \
        .select("agent_id", "retried", "failure_category", "live_strict")


@query("retry_counters", f"""WITH {_RECONCILED_SQL} SELECT CAST(1 AS BIGINT) AS run_id,
    count(*) FILTER (WHERE retried) AS retried,
    count(*) FILTER (WHERE retried AND live) AS recovered,
    count(*) FILTER (WHERE retried AND category = 'undetermined') AS undetermined FROM final""")
def retry_counters(spark, sf_dir):
    return verdict.retry_counters(verdict.reconcile(_graded(spark, sf_dir)))


@query("agent_hosts", f"""WITH {GRADED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id,
    CASE WHEN u = 5 THEN 'h' || (c % 97) || '.site.test'
        WHEN u > 5 THEN 'a' || (c % 97) || '.b.co.uk' ELSE 'old.test' END AS uri_host,
    CASE WHEN u = 5 THEN 'site.test' WHEN u > 5 THEN 'b.co.uk' ELSE 'old.test' END
        AS uri_root_domain, u >= 5 AS host_changed FROM graded WHERE pass = 1""")
def agent_hosts(spark, sf_dir):
    targets = b.probe_targets(spark, sf_dir).where("pass = 1")
    first = verdict.target_hosts(targets.select("agent_id", "uri"))
    agents = targets.select("agent_id", F.lit("old.test").alias("uri_host"),
                            F.lit("old.test").alias("uri_root_domain"))
    return state.with_agent_hosts(agents, first)


@query("stored_documents", f"""WITH {GRADED_SQL} SELECT CAST(k AS VARCHAR) AS agent_id, pass,
    CASE WHEN u = 2 THEN CASE WHEN q % 3 = 0 THEN 1 WHEN c % 5 = 0 THEN 3 ELSE 2 END ELSE 0 END
        AS pos, md5({b.BODY}) AS digest FROM graded WHERE stage >= 3""")
def stored_documents(spark, sf_dir):
    """Texts of the JSON objects behind the checks, fetched or inline, one per agent and pass."""
    targets = materialise(b.probe_targets(spark, sf_dir), "targets")
    return verdict.documents_of_run(targets, b.fetches(targets)).select(
        "agent_id", "pass", "pos", F.md5("body").alias("digest"))


@query("gateway_coverage", f"""SELECT count(*) AS agents, 3 * count(*) AS urls
    FROM (SELECT {b.CASE_COLUMNS} FROM orders) WHERE u = 2""")
def gateway_coverage(spark, sf_dir):
    targets = b.probe_targets(spark, sf_dir).where("pass = 1 AND u = 2")
    return targets.select("agent_id", F.explode(uri.gateway_urls(F.col("uri"))).alias("url")) \
        .agg(F.countDistinct("agent_id").alias("agents"), F.count("url").alias("urls"))
