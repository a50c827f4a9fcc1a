"""A probe run from attempts to stored checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from rollcall.operators import verdict
from rollcall.plans import measure
from rollcall.schemas import ENDPOINT_PROBES, FETCHES
from rollcall.session import fresh_path
from rollcall.sources import tables

LIVE = '{"type":"erc8004:registration","services":["https://ok.test/x"]}'
NOW = dt.datetime(2026, 3, 1)


def fetch(agent, pos, status=200, body=LIVE, **kw):
    row = dict(run_id=1, agent_id=agent, pos=pos, target=f"https://g{pos}.test/", excluded=False,
               robots_allowed=True, status=status, error_class=None, error_message=None,
               latency_ms=5, content_type="x", bytes=1, body=body)
    row["pass"] = 1
    row.update({("pass" if k == "turn" else k): v for k, v in kw.items()})
    names = [c.split()[0] for c in FETCHES.split(",")]
    return tuple(row[n] for n in names)


def probe(agent, status, method="HEAD", pos=0, turn=1):
    return (1, agent, turn, pos, None, method, False, True, status, None, None, 3)


@pytest.fixture(scope="module")
def graded(spark):
    uris = {
        "third": "ipfs://a", "excluded": "ipfs://b", "late": "ipfs://c", "robots": "https://r",
        "recovers": "https://x", "stays": "https://y", "head": "https://z", "none": "https://n",
        "inline": "data:," + LIVE.replace("https://ok.test/x", "mailto:a"), "bad": "data:a;base64,e",
        "exhausted": "ipfs://e"}
    fetches = [
        fetch("third", 0, 504, None), fetch("third", 1, 200, " \n"), fetch("third", 2),
        fetch("excluded", 0, 500, None), fetch("excluded", 1, None, None, excluded=True),
        fetch("late", 0), fetch("late", 1, 404, None),
        fetch("robots", 0, None, None, robots_allowed=False),
        fetch("recovers", 0, 429, None), fetch("recovers", 0, turn=2),
        fetch("stays", 0, 403, None), fetch("stays", 0, 403, None, turn=2),
        fetch("head", 0),
        fetch("exhausted", 0, 504, None), fetch("exhausted", 1, None, None,
                                               error_class="ConnectTimeout"),
    ]
    probes = [probe("third", 200), probe("late", 500), probe("late", 200, "GET"),
              probe("recovers", 204, turn=2), probe("head", 405), probe("head", 404, "GET")]
    agents = spark.createDataFrame([(a, u, True) for a, u in uris.items()],
                                   "agent_id string, current_uri string, in_panel boolean")
    targets = measure.targets_of(agents, 1, F.lit(NOW))
    return measure.grade_run(targets, spark.createDataFrame(fetches, FETCHES),
                             spark.createDataFrame(probes, ENDPOINT_PROBES)).cache()


EXPECTED = {
    "third": (6, None, True, "https://g2.test/", 200),
    "excluded": (1, "excluded_by_request", False, "https://g0.test/", 500),
    "late": (6, None, True, "https://g0.test/", 200),
    "robots": (1, "robots_disallowed", False, None, None),
    "recovers": (6, None, True, "https://g0.test/", 200),
    "stays": (1, "undetermined", False, "https://g0.test/", 403),
    "head": (5, "all_endpoints_dead", False, "https://g0.test/", 200),
    "none": (1, "prober_error", False, None, None),
    "inline": (5, "all_endpoints_dead", False, "inline", None),
    "bad": (1, "data_uri_malformed", False, None, None),
    "exhausted": (1, "timeout_connect", False, "https://g1.test/", None),
}


@pytest.mark.parametrize("agent", EXPECTED)
def test_outcome(graded, agent):
    row = graded.where(F.col("agent_id") == agent).collect()
    assert len(row) == 1
    r = row[0]
    assert (r.funnel_stage, r.failure_category, r.live_strict, r.resolved_url, r.http_status) \
        == EXPECTED[agent]


def test_details(graded):
    rows = {r.agent_id: r for r in graded.collect()}
    assert rows["exhausted"].failure_detail == "all 3 gateways failed; last: timeout_connect"
    assert rows["excluded"].failure_detail == "g1.test"
    assert rows["inline"].failure_detail == "unsupported_scheme"
    assert rows["head"].failure_detail == "404"
    assert [r for r in rows if rows[r].retried] == ["recovers", "stays"] or \
        {r for r in rows if rows[r].retried} == {"recovers", "stays"}
    counted = verdict.retry_counters(graded).first()
    assert (counted.retried, counted.recovered, counted.undetermined) == (2, 1, 1)


def test_funnel_is_monotone(graded):
    flags = ["s1_uri_present", "s2_resolved", "s3_valid_json", "s4_schema_match",
             "s5_has_services", "s6_endpoint_alive", "live_strict"]
    for row in graded.select(*flags).collect():
        assert list(row) == sorted(row, reverse=True)


def test_store_and_resume(spark, graded):
    path = fresh_path(spark, "test-checks")
    measure.store_run(graded, path)
    measure.store_run(graded, path)
    stored = spark.read.parquet(path)
    assert stored.count() == len(EXPECTED)
    agents = stored.select("agent_id", F.lit("u").alias("current_uri"), F.lit(True).alias("in_panel")) \
        .union(spark.sql("SELECT 'new', 'u', true"))
    left = measure.targets_of(agents, 1, F.lit(NOW), stored=stored)
    assert {r.agent_id for r in left.collect()} == {"new"}


def test_documents_are_kept(spark, graded):
    path = fresh_path(spark, "test-documents")
    rows = graded.select("run_id", "agent_id", F.lit("{}").alias("body"))
    tables.write_documents(rows, path)
    assert spark.read.parquet(path).count() == len(EXPECTED)


def test_attempts_have_no_last_position(spark):
    """A good answer at any position counts; what comes after it does not."""
    from rollcall.operators import verdict
    from rollcall.schemas import FETCHES

    def attempt(agent, pos, status, body="{}", **kw):
        return (1, agent, 1, pos, f"https://g{pos}.test/{agent}", kw.get("excluded", False),
                kw.get("allowed", True), status, kw.get("error"), None, 5, "t", 2, body)

    fetched = spark.createDataFrame([
        attempt("a", 0, 504), attempt("a", 3, 200), attempt("a", 9, 404),
        attempt("b", 0, 504), attempt("b", 40, 502), attempt("c", 0, 504),
        attempt("c", 5, None, excluded=True), attempt("d", 2, None), attempt("e", 7, 200, "[1]")],
        FETCHES)
    targets = spark.createDataFrame(
        [(1, x, 1, f"ipfs://{x}") for x in "abcde"]
        + [(1, "f", 1, "data:application/json,{\"x\": 1}"), (1, "g", 1, "data:,[1]")],
        "run_id bigint, agent_id string, pass int, uri string")
    outcomes = verdict.choose_attempt(verdict.fetch_outcomes(targets, fetched))
    got = {r.agent_id: (r.decided.pos, r.decided.category, r.made.pos if r.made else None)
           for r in outcomes.collect()}
    assert got == {"a": (3, None, 3), "b": (40, "http_502_bad_gateway", 40),
                   "c": (5, "excluded_by_request", 0), "d": (2, "prober_error", 2),
                   "e": (7, None, 7), "f": (0, None, 0), "g": (0, None, 0)}
    stored = {(r.agent_id, r.pos, r.body)
              for r in verdict.documents_of_run(targets, fetched).collect()}
    assert stored == {("a", 3, "{}"), ("f", 0, '{"x": 1}')}
