import random

import pytest
from pyspark.sql import functions as F

from rollcall.llm import urlfilter

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"), ("a.com", "/de/x", "allow"),
         ("a.com", "/de/x", "block"), ("", "/", "block"), (None, "/", "block"), ("net", None, "block"),
         ("org", "/", "allow")]


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end], rest[end:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = path[:min([path.index(c) for c in "?#" if c in path], default=len(path))]
    fits = [(len(h + p), len(h), v, h + p) for h, p, v in rules
            if h and p is not None and v and (host == h or host.endswith("." + h))
            and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[2] if best else "allow"


def urls():
    r = random.Random(4)
    out = [None, "", "x", "://", "http://", "http://ORG/", "http://org", "http://x.org?a/b",
           "a://b://c.org/", "http://Sub.Example.ORG/en/12#x", "http://notexample.org/es/",
           "http://.com/de/", "http://com./de/", "http://ÄB.com/fr/é?q", "http://u@a.com:80/de/",
           "http://a.com/de/x\nline/../?q", "HTTP://A.B.a.com/de/xyz", "http://com/" + "y" * 3000]
    out += [f"http://{r.choice(['a.', 'b.c.', ''])}{r.choice(['org', 'com', 'example.org', 'net'])}"
            f"{r.choice(['/', ''])}{r.choice(['es/', 'en/1', 'en/2', 'fr/', 'de/x', 'de'])}"
            for _ in range(200)]
    return out + out[:5]


@pytest.fixture
def pages(spark):
    rows = [(k if k % 7 else None, u, "old", "old", "old", "old", "old") for k, u in enumerate(urls())]
    return spark.createDataFrame(rows, "page_id long, url string, host string, path string, "
                                       "rule string, verdict string, key string")


def rules_frame(spark, rows):
    return spark.createDataFrame(rows, "host string, path string, verdict string")


def plain(rows):
    return sorted(map(repr, rows))


def test_verdicts_equal_brute_force(spark, pages):
    got = urlfilter.judge(pages, rules_frame(spark, RULES))
    assert got.count() == pages.count() and set(got.columns) == set(pages.columns)
    want = [(u, *brute(u, RULES)) for u in urls()]
    assert plain(map(tuple, got.select("url", "host", "path", "rule", "verdict").collect())) == \
        plain(want)


def test_many_rules_by_a_shuffled_filter(spark, pages, monkeypatch):
    monkeypatch.setattr(urlfilter, "BROADCAST_BLOCKS", 3)
    many = RULES + [(f"h{k}.org", f"/{k % 9}/", "block") for k in range(300)]
    got = urlfilter.judge(pages, rules_frame(spark, many), "block")
    want = [(u, r, "block" if r is None else v) for u in urls() for _, _, r, v in [brute(u, many)]]
    assert plain(map(tuple, got.select("url", "rule", "verdict").collect())) == plain(want)


def test_no_rules_and_no_pages(spark, pages):
    none = rules_frame(spark, [])
    assert {r["verdict"] for r in urlfilter.judge(pages, none).collect()} == {"allow"}
    assert urlfilter.judge(pages.limit(0), rules_frame(spark, RULES)).collect() == []


def test_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(4000).select(F.concat(F.lit("k"), "id").alias("key"))
    words = urlfilter.bloom_filter(listed, 1000)
    tried = spark.range(8000).select("id", F.concat(F.lit("k"), "id").alias("key"))
    hit = tried.join(words, urlfilter._block(tried["key"], 1000) == words["block"]) \
        .where(F.col("word").bitwiseAND(urlfilter._word(F.col("key")))
               == urlfilter._word(F.col("key")))
    counts = hit.groupBy((F.col("id") < 4000).alias("own")).count().collect()
    by = {r["own"]: r["count"] for r in counts}
    assert by[True] == 4000 and by.get(False, 0) < 400


def test_main_path_is_native(spark, pages):
    plan = urlfilter.judge(pages, rules_frame(spark, RULES)) \
        ._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
