"""Literal rows with known answers."""

import json

import pytest
from pyspark.sql import functions as F

from rollcall.functions import abi, failures, stats, text, uri
from rollcall.functions.document import analyse_documents

BAFY = "bafy" + "a" * 40


@pytest.mark.parametrize("value, scheme", [
    (None, "empty"), ("", "empty"), ("  ", "empty"), ("\t\n \x1f", "empty"),
    ("HTTPS://a", "https"), ("http://a", "http"), ("IPFS://x", "ipfs"), ("/ipfs/x", "ipfs"),
    (BAFY, "ipfs"), ("Qm" + "x" * 10, "other"), ("data:,x", "data"), ("ar://x", "arweave"),
    ("ftp://x", "other"), (" https://a ", "https")])
def test_scheme(one, value, scheme):
    assert one("u string", [value], uri.uri_scheme(uri.clean_uri(F.col("u")))) == [scheme]


def test_gateways(one):
    urls, = one("u string", ["ipfs://ipfs/abc/x"], uri.gateway_urls(F.col("u")))
    assert urls == [g + "abc/x" for g in ("https://ipfs.io/ipfs/", "https://dweb.link/ipfs/",
                                          "https://gateway.pinata.cloud/ipfs/")]
    study, = one("u string", ["ipfs://ipfs/abc"], uri.gateway_urls(
        F.col("u"), ["g/"], unwrap_scheme_path=False))
    assert study == ["g/ipfs/abc"]


@pytest.mark.parametrize("value, content, kind", [
    ("data:application/json;base64,eyJhIjoxfQ", '{"a":1}', "application/json"),
    ("data:,a+b%20c", "a+b c", "text/plain"), ("data:text/html;x=1,%zz%C3%BC", "%zzü", "text/html"),
    ("data:x;base64,e", None, "x"), ("data:nothing", "", "nothing")])
def test_data_uri(one, value, content, kind):
    parts, = one("u string", [value], uri.data_uri_parts(F.col("u")))
    assert (parts["text"], parts["content_type"]) == (content, kind)


@pytest.mark.parametrize("value, host", [
    ("https://U:p@A.Example.COM.:8080/x", "a.example.com"), ("//b.test?q", "b.test"),
    ("https://[::1]:80/", "::1"), ("no host", ""), ("http://a_b.test/x y", "a_b.test")])
def test_host(one, value, host):
    assert one("u string", [value], uri.host_of(F.col("u"))) == [host]


@pytest.mark.parametrize("host, root", [
    ("a.b.example.co.uk", "example.co.uk"), ("10.0.0.1", "10.0.0.1"),
    ("x.github.io", "x.github.io"), ("github.io", "github.io"), ("a.b.c.com", "c.com"),
    ("b.s3.eu-west-1.amazonaws.com", "b.s3.eu-west-1.amazonaws.com"),
    ("b.s3.amazonaws.com", "b.s3.amazonaws.com"), ("s3.amazonaws.com", "amazonaws.com"),
    ("b.s3-amazonaws.com", "s3-amazonaws.com"), ("", ""), ("a.b.test.", "b.test")])
def test_root_domain(one, host, root):
    assert one("h string", [host], uri.registrable_domain(F.col("h"))) == [root]


@pytest.mark.parametrize("host, shared", [
    ("termix-platform-prod.s3.ap-southeast-1.amazonaws.com", True), ("ipfs.io", True),
    ("pinata.cloud", True), ("base.eth", True), ("ethereum.org", True),
    ("someone.github.io", True), ("myagent.vercel.app", True), ("voltplayground.xyz", False),
    ("olas.network", False), ("lobster3301.com", False), ("surfliquid.com", False),
    ("r2.markets", False), ("virtuals.io", False), (" X.COM. ", True), ("", False)])
def test_shared_hosting(one, host, shared):
    assert one("h string", [host], uri.is_shared_hosting(F.col("h"))) == [shared]


@pytest.mark.parametrize("status, name", [
    (404, "http_404_not_found"), (301, "http_301_redirect"), (418, "http_418_client_error"),
    (599, "http_599_server_error"), (100, "http_100"), (500, "http_500")])
def test_http_category(one, status, name):
    assert one("s int", [status], failures.http_category(F.col("s"))) == [name]


DETAILS = "array<struct<status string>>"


@pytest.mark.parametrize("live, category, statuses, slow", [
    (False, "all_endpoints_dead", ["404", "429"], True), (True, None, ["403"], False),
    (False, "all_endpoints_dead", ["404", "500", "403", "404", "404"], True),
    (False, "http_403_forbidden", None, True), (False, "not_json", ["429"], False)])
def test_throttled(one, live, category, statuses, slow):
    rows = [(live, category, None if statuses is None else [(s,) for s in statuses])]
    assert one(f"l boolean, c string, d {DETAILS}", rows,
               failures.looks_throttled(F.col("l"), F.col("c"), F.col("d"))) == [slow]


# Published proportions: successes, sample, percent, interval.
GOLDEN = [(11308, 98713, 11.46, 11.26, 11.66), (1621, 2248, 72.11, 70.22, 73.92),
          (909, 2248, 40.44, 38.43, 42.48), (153, 2248, 6.81, 5.84, 7.92),
          (137, 2248, 6.09, 5.18, 7.16), (96, 1553, 6.18, 5.09, 7.49),
          (81, 1553, 5.22, 4.22, 6.44), (81, 1514, 5.35, 4.33, 6.60),
          (66, 1514, 4.36, 3.44, 5.51), (16, 2248, 0.71, 0.44, 1.15),
          (124, 153, 81.05, 74.10, 86.47), (36, 43, 83.72, 70.03, 91.88),
          (36, 572, 6.29, 4.58, 8.59)]


def test_wilson(one):
    got = one("k bigint, n bigint", [(k, n) for k, n, *_ in GOLDEN],
              *stats.wilson_columns(F.col("k"), F.col("n")))
    assert got == [(n, k, pct, low, high) for k, n, pct, low, high in GOLDEN]
    study, = one("k bigint, n bigint", [(82, 1204)],
                 *stats.wilson_columns(F.col("k"), F.col("n"), digits=1))
    assert study == (1204, 82, 6.8, 5.5, 8.4)
    assert one("k bigint, n bigint", [(0, 0)], *stats.wilson_columns(F.col("k"), F.col("n"))) \
        == [(0, 0, None, None, None)]
    assert one("k bigint, n bigint", [(0, 0)],
               *stats.wilson_columns(F.col("k"), F.col("n"), empty="zero"))[0][3:] == (0.0, 0.0)


def test_wide_numbers(spark):
    numbers = [0, 1, 2 ** 60 - 1, 2 ** 60, 2 ** 64, 10 ** 27, 2 ** 200 + 12345, 2 ** 256 - 1]
    frame = spark.createDataFrame([(f"{n:064x}",) for n in numbers], "w string")
    assert [r[0] for r in frame.select(abi.decimal_text("w")).collect()] == [
        str(n) for n in numbers]


def test_metadata_values(one):
    values = ["hello world".encode(), b"", b"tab\t", b"\xff\x00", "ü €".encode(), b"a\n"]
    got = one("h string", [v.hex() for v in values], abi.text_or_hex(F.col("h")))
    assert got == ["hello world", "0x", "0x74616209", "0xff00", "ü €", "0x610a"]


def test_iso(spark):
    row = spark.sql("SELECT timestamp '2026-02-03 04:05:06' AS a, "
                    "timestamp '2026-02-03 04:05:06.5' AS b, CAST(NULL AS TIMESTAMP) AS c")
    assert tuple(row.select(*[text.iso(F.col(c)) for c in "abc"]).first()) == (
        "2026-02-03T04:05:06+00:00", "2026-02-03T04:05:06.500000+00:00", None)


REGISTRY = "eip155:8453:0x8004a169fb4a3325136eb29fa0ceb6d2e539a432"
BODIES = [
    # body, category, type, registry present, matches, services, urls
    ('{"a":1,"a":2}', None, "", False, False, 0, []),
    ("[1]", "json_not_object", "", False, False, 0, []),
    ("5", "json_not_object", "", False, False, 0, []),
    ("null", "json_not_object", "", False, False, 0, []),
    ("{bad", "not_json", "", False, False, 0, []),
    ('{"a":1} x', "not_json", "", False, False, 0, []),
    ('{"a":1}] x', "not_json", "", False, False, 0, []),
    ('{"a":1}, {"b":2}', "not_json", "", False, False, 0, []),
    ("{'a':1}", "not_json", "", False, False, 0, []),
    ("", "not_json", "", False, False, 0, []),
    (' \n{"type":5,"@type":"x"} ', None, "x", False, False, 0, []),
    ('{"type":["a",1,"b"]}', None, "a,b", False, False, 0, []),
    ('{"type":[1,"b"],"kind":"k"}', None, "k", False, False, 0, []),
    ('{"type":""}', None, "", False, False, 0, []),
    ('{"registrations":[]}', None, "", False, False, 0, []),
    ('{"registrations":[{"agentRegistry":"other"}, 7]}', None, "", True, False, 0, []),
    (json.dumps({"registrations": [{}, {"agentRegistry": REGISTRY.upper()}]}), None, "", True,
     True, 0, []),
    ('{"services":[],"endpoints":["u"]}', None, "", False, False, 1, ["u"]),
    ('{"services":[{"url":"","href":"h"},{"name":"n"},3]}', None, "", False, False, 3, ["h"]),
    ('{"services":{"z":"u1","b":{"url":"u2"},"m":3}}', None, "", False, False, 3, ["u1", "u2"]),
    ('{"skills":["1","2","3","4","5","6"]}', None, "", False, False, 6, list("12345")),
]


@pytest.fixture(scope="module")
def findings(spark):
    rows = [(i, b[0]) for i, b in enumerate(BODIES)]
    frame = analyse_documents(spark.createDataFrame(rows, "i int, body string"), "body")
    return {r.i: r.analysis for r in frame.collect()}


@pytest.mark.parametrize("i", range(len(BODIES)))
def test_document(findings, i):
    a = findings[i]
    assert (a.json_category, a.type_field_raw, a.registry_field_present, a.registry_field_matches,
            a.services_count, a.urls) == BODIES[i][1:]


def test_exact_json(spark):
    frame = spark.createDataFrame([('{"type":"x","n":NaN,"m":[-Infinity]}',)], "body string")
    kinds = lambda exact: analyse_documents(frame, "body", exact_json=exact).first().analysis
    assert kinds(False).json_category == "not_json"
    assert (kinds(True).json_category, kinds(True).type_field_raw) == (None, "x")
