"""
Grading: fetch attempts and endpoint probes in, one graded check per agent and run out.

Documents are inspected in the scan that reads them. What is shuffled afterwards is the
findings, a few hundred bytes per attempt, never the documents. An agent's attempts are taken in
their order, its probes, of which five count, by position into a fixed number of columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.constants import CANONICAL_TYPES, GATEWAYS, MAX_DOCUMENT_BYTES, MAX_ENDPOINTS, \
    STUDY_CANONICAL_TYPES, STUDY_GATEWAYS, UNDETERMINED_DETAIL
from rollcall.functions.document import analyse_documents, categorise_documents
from rollcall.functions.failures import error_category, http_category, looks_throttled
from rollcall.functions.staging import stage
from rollcall.functions.text import is_blank
from rollcall.functions.uri import clean_uri, data_uri_parts, dot_suffixes, host_of, \
    is_generic_host, registrable_domain, uri_scheme
from rollcall.schemas import ENDPOINT_DETAILS

# The agent first: rows are sorted by the beginning of the first column where that tells them apart,
# and a run's number never does.
KEY = ["agent_id", "run_id", "pass"]
HOME = ["agent_id", "run_id"]


@dataclass(frozen=True)
class Dialect:
    """Where the daily monitor and the one-off study define a stage differently."""

    name: str
    canonical_types: Sequence[str]
    gateways: Sequence[str]
    type_length: int
    error_length: int
    study: bool


MONITOR = Dialect("monitor", CANONICAL_TYPES, GATEWAYS, 400, 200, False)
STUDY = Dialect("study", STUDY_CANONICAL_TYPES, STUDY_GATEWAYS, 200, 160, True)


def excluded_names(hosts: DataFrame, excluded: DataFrame) -> DataFrame:
    """
    Those of the distinct hosts that are on the exclusion list or below one that is.

    A host is split into its dot suffixes, so the suffix test is an equality join.
    """
    listed = excluded.select(F.lower("host").alias("_suffix")).distinct()
    return hosts.select("host").where("host <> ''").distinct() \
        .withColumn("_suffix", F.explode(dot_suffixes(F.lower("host")))) \
        .join(listed, "_suffix", "left_semi").select("host").distinct()


def mark_excluded(rows: DataFrame, url: str, excluded: DataFrame) -> DataFrame:
    """Set the column `excluded` from the exclusion list."""
    hosted = rows.withColumn("host", host_of(F.col(url)))
    names = excluded_names(hosted, excluded).withColumn("_listed", F.lit(True))
    return hosted.join(names, "host", "left") \
        .withColumn("excluded", F.coalesce("_listed", F.lit(False))).drop("_listed", "host")


def _capped(body: Column, limit: int) -> Column:
    """The crawler's own limit on a document's size, for tables that kept more."""
    head = F.make_valid_utf8(F.substring(F.encode(body, "UTF-8"), 1, limit).cast("string"))
    return F.when(F.octet_length(body) > limit, head).otherwise(body)


def _inline_attempts(targets: DataFrame, dialect: Dialect) -> DataFrame:
    """Documents that are part of the URI itself, as attempts that need no fetching."""
    parts = data_uri_parts(F.col("_clean"), keep_parameters=dialect.study)
    inline = stage(targets, {"_clean": clean_uri(F.col("uri"))}) \
        .where(uri_scheme(F.col("_clean")) == "data")
    inline = stage(inline, {"_parts": parts})
    text = F.col("_parts.text")
    return inline.select(
        *KEY, F.lit(0).alias("pos"),
        F.when(text.isNotNull(), "inline").alias("target"),
        F.lit(False).alias("excluded"), F.lit(True).alias("robots_allowed"),
        F.lit(None).cast("int").alias("status"),
        F.when(text.isNull(), "InlineDataError").alias("error_class"),
        F.lit("").alias("error_message"),
        F.when(text.isNotNull(), F.lit(0)).alias("latency_ms"),
        F.when(text.isNotNull(), F.col("_parts.content_type")).alias("content_type"),
        F.char_length(text).alias("bytes"),
        text.alias("body"), F.lit(True).alias("inline"))


def all_attempts(targets: DataFrame, fetches: DataFrame, dialect: Dialect = MONITOR) -> DataFrame:
    """Fetched documents and those that are part of a URI."""
    return fetches.withColumn("inline", F.lit(False)) \
        .unionByName(_inline_attempts(targets, dialect))


def _judged_attempts(targets: DataFrame, fetches: DataFrame, dialect: Dialect,
                     max_bytes: int) -> DataFrame:
    """All attempts with their outcome, and the document to look at where one came back."""
    attempts = all_attempts(targets, fetches, dialect)
    host = host_of(F.col("target"))
    in_2xx = F.coalesce((F.col("status") >= 200) & (F.col("status") < 300), F.lit(False))
    answered = F.col("error_class").isNull()
    no_text = (F.coalesce("body", F.lit("")) == "") if dialect.study else is_blank(F.col("body"))
    blocked = F.lit(False) if dialect.study else F.col("excluded") | ~F.col("robots_allowed")
    message = F.concat(F.col("error_class"), F.lit(": "),
                       F.substring(F.coalesce("error_message", F.lit("")), 1,
                                   dialect.error_length))
    category = (
        F.when(F.lit(not dialect.study) & F.col("excluded"), "excluded_by_request")
        .when(F.lit(not dialect.study) & ~F.col("robots_allowed"), "robots_disallowed")
        .when(F.col("inline") & ~answered, "data_uri_malformed")
        .when(~answered, error_category(F.col("error_class"), F.col("error_message")))
        .when(~F.col("inline") & ~in_2xx, F.coalesce(http_category(F.col("status")),
                                                     F.lit("prober_error")))
        .when((F.lit(dialect.study) | ~F.col("inline")) & no_text, "empty_body"))
    detail = (
        F.when(F.col("_category").isin("excluded_by_request", "robots_disallowed"), host)
        .when(~answered, message)
        .when(F.col("_category") == "empty_body", host)
        .when(F.col("_category").isNotNull(),
              F.concat(F.col("status").cast("string"), F.lit(" from "), host)))
    judged = stage(attempts, {"_category": category, "_blocked": blocked})
    ok = F.col("_category").isNull()
    # The study stops at the first 2xx answer even if it is empty.
    stops = (answered & (in_2xx | F.col("inline"))) if dialect.study else ok | F.col("_blocked")
    return stage(judged, {
        "_detail": detail, "_ok": ok, "_stops": stops,
        "_error": F.when(~answered, message),
        "_document": F.when(ok, _capped(F.col("body"), max_bytes))})


def fetch_outcomes(targets: DataFrame, fetches: DataFrame, dialect: Dialect = MONITOR,
                   exact_json: bool = False, max_bytes: int = MAX_DOCUMENT_BYTES) -> DataFrame:
    """One row per attempt with its outcome and, where a document came back, its findings."""
    judged = _judged_attempts(targets, fetches, dialect, max_bytes)
    found = analyse_documents(judged, "_document", dialect.canonical_types, dialect.type_length,
                              dialect.study, exact_json, services_of_all=False)
    return found.select(
        *KEY, "pos", F.col("_stops").alias("stops"), F.col("_ok").alias("ok"),
        F.col("_blocked").alias("blocked"), F.col("_category").alias("category"),
        F.col("_detail").alias("detail"), "target", "status", "latency_ms", "content_type",
        "bytes", F.col("_error").alias("error"), "inline",
        F.when(F.col("_ok"), F.col("analysis")).alias("analysis"))


def choose_attempt(outcomes: DataFrame) -> DataFrame:
    """
    The attempt that decides, and the last one actually made, with their positions.

    Attempts are taken in order of `pos`, however many there are, up to the first that ends the
    search: a usable document, or a refusal that is ours. Without one the last attempt decides.
    Attempts recorded after the end are ignored. One distribution and one sort serve all windows, and
    no row is packed to be compared: an attempt knows its neighbours. A refusal ends the search, so
    the last attempt made is the deciding one or the one before it.
    """
    fields = [c for c in outcomes.columns if c not in KEY]
    in_order = Window.partitionBy(*KEY).orderBy("pos", "stops", "category", "target")
    ended = F.max("stops").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    attempt = F.struct(*fields)
    decides = ~F.coalesce("_ended", F.lit(False)) \
        & (F.coalesce("stops", F.lit(False)) | F.col("_last"))
    return outcomes.withColumns({
        "_ended": ended, "_last": F.lead(F.lit(1)).over(in_order).isNull(),
        "_before": F.lag(attempt).over(in_order)}).where(decides).select(
        *KEY, attempt.alias("decided"),
        F.when(F.col("blocked"), F.col("_before")).otherwise(attempt).alias("made"))


def gather_probes(probes: DataFrame, dialect: Dialect = MONITOR) -> DataFrame:
    """
    The final answer of each of the first five endpoints, one row per agent.

    A GET was only sent where HEAD did not do, so it overrides HEAD.
    """
    error = F.col("error_class") if dialect.study \
        else error_category(F.col("error_class"), F.col("error_message"))
    shown = F.when(F.lit(not dialect.study) & F.col("excluded"), "excluded_by_request") \
        .when(F.lit(not dialect.study) & ~F.col("robots_allowed"), "robots_disallowed") \
        .otherwise(F.coalesce(F.col("status").cast("string"), error))
    asked = F.lit(dialect.study) | (~F.col("excluded") & F.col("robots_allowed"))
    answer = F.struct(
        F.when(F.col("method") == "GET", 0).otherwise(1).alias("rank"), shown.alias("shown"),
        asked.alias("asked"), (asked & F.coalesce(
            F.col("status").between(200, 399), F.lit(False))).alias("ok"), "latency_ms")
    wanted = probes.where(F.col("pos") < MAX_ENDPOINTS)
    return wanted.groupBy(*KEY).agg(*[
        F.min(F.when(F.col("pos") == i, answer)).alias(f"_p{i}")
        for i in range(MAX_ENDPOINTS)])


def _endpoint_details(urls: Column, dialect: Dialect) -> Column:
    """One entry for each URL. `_host0` to `_host4` are their hosts, as functions over arrays would
    take every part of a host's pattern again wherever the host is used, without compiled code."""
    def one(i: int) -> Column:
        url, answer, host = F.get(urls, F.lit(i)), F.col(f"_p{i}"), F.col(f"_host{i}")
        web = F.lower(url).rlike("^https?://")
        asked = web & F.coalesce(answer["asked"], F.lit(True))
        return F.struct(
            (url if dialect.study else F.substring(url, 1, 200)).alias("url"),
            host.alias("host"), (web & F.coalesce(answer["ok"], F.lit(False))).alias("ok"),
            F.when(~web, "unsupported_scheme")
            .otherwise(F.coalesce(answer["shown"], F.lit("not_probed"))).alias("status"),
            F.when(asked, answer["latency_ms"]).alias("latency_ms"),
            (asked & is_generic_host(host)).alias("generic"))

    return F.slice(F.array(*[one(i) for i in range(MAX_ENDPOINTS)]), F.lit(1), F.size(urls))


def _staged(targets: DataFrame, fetches: DataFrame, probes: DataFrame, dialect: Dialect,
            exact_json: bool) -> DataFrame:
    # Windows, aggregation and joins have one key, so each row moves once, and probes are folded
    # before. An earlier repartition by a part of the key does not serve the joins: Spark wants rows
    # dealt by all keys of a join, and would move them again.
    chosen = choose_attempt(fetch_outcomes(targets, fetches, dialect, exact_json))
    cleaned = stage(targets, {"_clean": clean_uri(F.col("uri"))})
    rows = stage(cleaned, {"uri_scheme": uri_scheme(F.col("_clean"))}) \
        .join(chosen, KEY, "left").join(gather_probes(probes, dialect), KEY, "left")
    fetchable = F.col("uri_scheme").isin("http", "https", "ipfs", "data")
    found = F.col("decided.analysis")
    yes = lambda c: F.coalesce(c, F.lit(False))
    enough = (F.col("decided.analysis.services_count") > 0) if dialect.study else \
        (F.col("decided.analysis.endpoints_total") > 0)
    s2 = fetchable & yes(F.col("decided.ok"))
    s3 = s2 & found["json_category"].isNull()
    s4 = s3 & yes(found["schema_match"])
    rows = stage(rows, {"s1": F.col("uri_scheme") != "empty", "_fetchable": fetchable,
                        "s2": s2, "s3": s3, "s4": s4, "s5": s4 & yes(enough)})
    rows = stage(rows, {f"_host{i}": host_of(F.get(found["urls"], F.lit(i)))
                        for i in range(MAX_ENDPOINTS)})
    rows = stage(rows, {"endpoint_details": F.when(
        F.col("s5"), _endpoint_details(found["urls"], dialect)).cast(ENDPOINT_DETAILS)})
    rows = stage(rows, {"_alive": F.coalesce(
        F.filter("endpoint_details", lambda e: e["ok"]), F.array().cast(ENDPOINT_DETAILS))})
    s6 = F.size("_alive") > 0
    reached = sum((F.when(c, 1).otherwise(0) for c in (*(F.col(f"s{i}") for i in range(1, 6)), s6)),
                  F.lit(0))
    return stage(rows, {
        "_ok": F.size("_alive"), "_specific": F.size(F.filter("_alive", lambda e: ~e["generic"])),
        "s6": s6, "funnel_stage": reached})


def grade(targets: DataFrame, fetches: DataFrame, probes: DataFrame,
          exact_json: bool = False) -> DataFrame:
    """
    Checks in the monitor's dialect, one per target (run_id, agent_id, pass, uri, checked_at).

    `pass` is 1 for the normal pass and 2 for the slow one; see `reconcile`.
    """
    rows = _staged(targets, fetches, probes, MONITOR, exact_json)
    found, decided, made = F.col("decided.analysis"), F.col("decided"), F.col("made")
    web = F.col("uri_scheme").isin("http", "https")
    host = host_of(F.col("_clean"))
    strict = F.col("s6") & (F.col("_specific") > 0)
    generic_only = F.col("s6") & (F.col("_specific") == 0)
    no_record = F.col("_fetchable") & decided.isNull()
    category = (
        F.when(~F.col("s1"), "empty_uri")
        .when(~F.col("_fetchable"), "unsupported_scheme")
        .when(no_record, "prober_error")
        .when(~F.col("s2"), decided["category"])
        .when(~F.col("s3"), found["json_category"])
        .when(~F.col("s4"), "schema_mismatch")
        .when(found["services_count"] == 0, "no_services")
        .when(~F.col("s5"), "services_without_urls")
        .when(~F.col("s6"), "all_endpoints_dead")
        .when(generic_only, "generic_hosts_only"))
    gateways = str(len(GATEWAYS))
    exhausted = (F.col("uri_scheme") == "ipfs") & ~decided["blocked"]
    detail = (
        F.when(~F.col("s1"), "")
        .when(~F.col("_fetchable"), F.col("uri_scheme"))
        .when(no_record, "no attempt recorded")
        .when(~F.col("s2") & exhausted,
              F.concat(F.lit(f"all {gateways} gateways failed; last: "), decided["category"]))
        .when(~F.col("s2"), decided["detail"])
        .when(found["json_category"] == "not_json", "the text is not one JSON value")
        .when(~F.col("s3"), F.concat(F.lit("top level is "), found["top_level"]))
        .when(~F.col("s4"), F.concat(F.lit("type='"), F.substring(found["type_field_raw"], 1, 120),
                                     F.lit("'")))
        .when(found["services_count"] == 0, "")
        .when(~F.col("s5"), F.concat(found["services_count"].cast("string"),
                                     F.lit(" service entries, none with a URL")))
        .when(~F.col("s6"), F.array_join(
            F.transform("endpoint_details", lambda e: e["status"]), ", "))
        .when(generic_only, F.array_join(F.array_sort(F.array_distinct(
            F.transform("_alive", lambda e: e["host"]))), ", ")))
    stage = (F.when(category.isNull(), F.lit(None).cast("int"))
             .when(no_record, 2)
             .otherwise(F.least(F.col("funnel_stage") + 1, F.lit(6))))
    zero = F.lit(0)
    yes = lambda c: F.coalesce(c, F.lit(False))
    return rows.select(
        "run_id", "agent_id", "pass", "checked_at",
        F.coalesce("uri", F.lit("")).alias("uri_checked"),
        F.lit("current_uri").alias("uri_source"), "uri_scheme",
        made["target"].alias("resolved_url"),
        F.col("s1").alias("s1_uri_present"), F.col("s2").alias("s2_resolved"),
        F.col("s3").alias("s3_valid_json"), F.col("s4").alias("s4_schema_match"),
        F.col("s5").alias("s5_has_services"), F.col("s6").alias("s6_endpoint_alive"),
        strict.alias("live_strict"), F.col("funnel_stage").cast("smallint"),
        F.when(F.col("s3"), found["type_field_raw"]).alias("type_field_raw"),
        (F.col("s3") & yes(found["type_is_canonical"])).alias("type_is_canonical"),
        (F.col("s3") & yes(found["registry_field_present"])).alias("registry_field_present"),
        (F.col("s3") & yes(found["registry_field_matches"])).alias("registry_field_matches"),
        stage.cast("smallint").alias("failure_stage"), category.alias("failure_category"),
        F.nullif(F.substring(detail, 1, 500), F.lit("")).alias("failure_detail"),
        made["status"].alias("http_status"), made["latency_ms"].alias("latency_ms"),
        made["content_type"].alias("content_type"), made["bytes"].alias("content_bytes"),
        F.when(F.col("s4"), found["services_count"]).otherwise(zero).alias("services_count"),
        F.when(F.col("s4"), found["endpoints_total"]).otherwise(zero).alias("endpoints_total"),
        F.when(F.col("s5"), F.size(found["urls"])).otherwise(zero).alias("endpoints_checked"),
        F.col("_ok").alias("endpoints_ok"), F.col("_specific").alias("endpoints_ok_specific"),
        generic_only.alias("generic_only"), "endpoint_details",
        F.when(F.col("s2"), found["doc_sha256"]).alias("doc_sha256"),
        F.when(web, host).alias("uri_host"),
        F.when(web, registrable_domain(host)).alias("uri_root_domain"))


def target_hosts(targets: DataFrame) -> DataFrame:
    """
    The targets with uri_host and uri_root_domain, as `grade` gives them: of the URI alone, null
    unless it is a web address. Nothing has to be fetched or graded for them.
    """
    rows = stage(stage(targets, {"_clean": clean_uri(F.col("uri"))}), {
        "_host": F.when(uri_scheme(F.col("_clean")).isin("http", "https"), host_of(F.col("_clean")))})
    return rows.withColumns({"uri_host": F.col("_host"),
                             "uri_root_domain": registrable_domain(F.col("_host"))}) \
        .drop("_clean", "_host")


def reconcile(checks: DataFrame) -> DataFrame:
    """
    One check per run and agent from a normal and a slow pass.

    The slow pass counts only where the first looked throttled, and then at face value; what
    is throttled twice becomes `undetermined`. Adds `retried`.
    """
    throttled = looks_throttled(F.col("live_strict"), F.col("failure_category"),
                                F.col("endpoint_details"))
    columns = [c for c in checks.columns if c not in ("run_id", "agent_id", "pass")]
    home = Window.partitionBy(*HOME)
    # Of several rows of a pass the earliest first and the latest second one count.
    turn = F.row_number().over(Window.partitionBy(*HOME, "pass").orderBy(
        F.when(F.col("pass") == 1, F.col("checked_at")).asc_nulls_first(),
        F.when(F.col("pass") == 2, F.col("checked_at")).desc_nulls_last()))
    # One distribution and one sort serve both windows.
    chosen = checks.where(F.col("pass").isin(1, 2)).repartition(*HOME) \
        .withColumns({"_throttled": throttled, "_turn": turn}).where("_turn = 1") \
        .withColumns({"_first": F.max(F.when(F.col("pass") == 1, F.col("_throttled"))).over(home),
                      "_both": F.count(F.lit(1)).over(home) == 2})
    retried = F.coalesce(F.col("_first"), F.lit(False)) & F.col("_both")
    kept = chosen.withColumn("retried", retried) \
        .where((F.col("pass") == F.when(F.col("retried"), 2).otherwise(1)))
    twice = F.col("retried") & F.col("_throttled")
    replaced = {
        "failure_category": F.when(twice, "undetermined").otherwise(F.col("failure_category")),
        "failure_detail": F.when(twice, UNDETERMINED_DETAIL).otherwise(F.col("failure_detail")),
    }
    return kept.select("run_id", "agent_id",
                       *[replaced.get(c, F.col(c)).alias(c) for c in columns], "retried")


def retry_counters(reconciled: DataFrame) -> DataFrame:
    """Per run: how many were retried, now live, and throttled again."""
    again = F.col("retried") & (F.col("failure_category") == "undetermined")
    return reconciled.groupBy("run_id").agg(
        F.count_if("retried").alias("retried"),
        F.count_if(F.col("retried") & F.col("live_strict")).alias("recovered"),
        F.count_if(again).alias("undetermined"))


def grade_study(targets: DataFrame, fetches: DataFrame, probes: DataFrame,
                exact_json: bool = False) -> DataFrame:
    """
    Checks in the study's dialect: six flags, looser stage 5, no censoring, text columns.

    Targets are (run_id, agent_id, pass, uri, owner, uri_source, checked_at).
    """
    rows = _staged(targets, fetches, probes, STUDY, exact_json)
    found, decided = F.col("decided.analysis"), F.col("decided")
    text = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    unsupported = F.col("s1") & ~F.col("_fetchable")
    inline_error = decided["inline"] & decided["error"].isNotNull()
    status = F.when(decided["inline"] & decided["error"].isNull(), "data") \
        .otherwise(text(decided["status"]))
    error = (F.when(unsupported, F.concat(F.lit("unsupported_scheme:"), F.col("uri_scheme")))
             .when(inline_error, "data_uri_decode: malformed")
             .otherwise(text(decided["error"])))
    in_s4, in_s3 = F.col("s4"), F.col("s3")
    when_text = lambda condition, c: F.when(condition, text(c)).otherwise("")
    yes = lambda c: F.coalesce(c, F.lit(False))
    bad_json = F.when(F.col("s2") & ~in_s3, F.when(
        found["json_category"] == "not_json", "not JSON").otherwise(
        F.concat(F.lit("top-level "), found["top_level"], F.lit(", expected object")))) \
        .otherwise("")
    return rows.select(
        "agent_id", "owner", F.coalesce("uri", F.lit("")).alias("uri_raw"), "uri_source",
        F.col("s1").alias("s1_uri_present"), "uri_scheme",
        text(decided["target"]).alias("resolved_url"),
        F.col("s2").alias("s2_resolved"), status.alias("http_status"),
        text(decided["latency_ms"]).alias("latency_ms"),
        text(decided["content_type"]).alias("content_type"),
        text(decided["bytes"]).alias("content_bytes"), error.alias("fetch_error"),
        in_s3.alias("s3_valid_json"), bad_json.alias("json_error"),
        when_text(in_s3, found["type_field_raw"]).alias("type_field_raw"),
        in_s4.alias("s4_schema_match"),
        when_text(in_s3, found["registry_field_present"]).alias("registry_field_present"),
        when_text(in_s3, found["registry_field_matches"]).alias("registry_matches"),
        F.col("s5").alias("s5_has_services"),
        when_text(in_s4, found["services_count"]).alias("services_count"),
        when_text(in_s4, found["service_types"]).alias("service_types"),
        when_text(F.col("s5"), found["endpoints_total"]).alias("endpoints_total"),
        when_text(F.col("s5"), F.size(found["urls"])).alias("endpoints_checked"),
        when_text(F.col("s5") & (F.size(found["urls"]) > 0), F.col("_ok")).alias("endpoints_ok"),
        F.col("s6").alias("s6_any_endpoint_alive"),
        F.substring(when_text(F.col("s5"), F.to_json("endpoint_details")), 1, 900)
        .alias("endpoint_details"),
        F.col("funnel_stage").cast("smallint"), "checked_at", yes(found.isNotNull()).alias("graded"))


def documents_of_run(targets: DataFrame, fetches: DataFrame, dialect: Dialect = MONITOR,
                     exact_json: bool = False) -> DataFrame:
    """
    (agent_id, run_id, pass, pos, body): the JSON object behind each check that has one, of the
    attempt that decided it, inline documents too.

    Documents are only asked whether they are objects, and once; the texts of those that are move on
    with their attempts.
    """
    judged = categorise_documents(_judged_attempts(targets, fetches, dialect, MAX_DOCUMENT_BYTES),
                                  "_document", exact_json)
    attempts = judged.select(
        *KEY, "pos", F.col("_stops").alias("stops"), F.col("_blocked").alias("blocked"),
        F.col("_category").alias("category"), "target",
        F.when(F.col("_ok") & F.col("json_category").isNull(), F.col("body")).alias("body"))
    return choose_attempt(attempts).where("decided.body IS NOT NULL") \
        .join(targets.select(*KEY), KEY, "left_semi") \
        .select(*KEY, F.col("decided.pos").alias("pos"), F.col("decided.body").alias("body"))


__all__ = [
    "MONITOR", "STUDY", "Dialect", "all_attempts", "choose_attempt", "documents_of_run", "excluded_names",
    "fetch_outcomes", "gather_probes", "grade", "grade_study", "mark_excluded", "reconcile",
    "retry_counters", "target_hosts"]
