"""
Judging URLs by listed hosts and paths, with a blocked Bloom filter before an exact join.

A URL has a few canonical keys under which a rule could list it: every suffix of its host at a
label boundary, with every prefix of its path that is as long as some rule's path. A Bloom filter
of the listed keys, cut into blocks of one 64-bit word each, lets possible hits through; an equality
join with the list removes the false ones. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

PROBES = 6
KEYS_PER_BLOCK = 4              # 16 bits a key
# Above this the filter's blocks are joined by a shuffle instead of a broadcast.
BROADCAST_BLOCKS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """From the first :// up to /, ?, # or the end, A-Z lower-cased; else empty."""
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(rest, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ?, # or the end; empty without a ://."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _key(host: Column, path: Column) -> Column:
    return F.concat_ws("/", F.length(host).cast("string"), host, path)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(1)), F.lit(blocks))


def _word(key: Column) -> Column:
    """The PROBES bits of a key in its block, six bits of a second hash for each."""
    spots = F.xxhash64(key, F.lit(2))
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(
        spots, 6 * k).bitwiseAND(63).cast("int")) for k in range(PROBES)]
    word = bits[0]
    for bit in bits[1:]:
        word = word.bitwiseOR(bit)
    return word


def bloom_filter(keys: DataFrame, blocks: int) -> DataFrame:
    """(block, word) of a table with the column key."""
    return keys.groupBy(_block(F.col("key"), blocks).alias("block")) \
        .agg(F.bit_or(_word(F.col("key"))).alias("word"))


def _candidates(urls: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path, key, at_host, at_path): every key under which a URL could be listed."""
    labels = F.split("host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(
        F.slice(labels, k, F.size(labels)), "."))
    cut = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return urls.select("host", "path", F.explode(hosts).alias("at_host")) \
        .where("at_host <> ''") \
        .select("*", F.explode(F.transform(
            cut, lambda n: F.substring("path", F.lit(1), n))).alias("at_path")) \
        .withColumn("key", _key(F.col("at_host"), F.col("at_path")))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """
    Add host, path, rule and verdict to pages (page_id, url, ...), replacing columns so named.

    rules: (host, path, verdict). A rule fits its host and all subdomains if the URL's path
    starts with the rule's; the longest rule (host and path together, then host) wins, and of
    equal ones a block. `rule` is host and path of the winner, else null; verdict the winner's,
    else `default`. A URL that is null or has no :// has an empty host and path, which no rule
    fits. Rules with a null or empty host, null path or null verdict are left out, repeated ones
    count once. Every row of pages gives one row, repeated ones too.

    URLs are judged once for each host and path. Rules may be many: nothing of their size is
    broadcast, and the filter is only while it has at most BROADCAST_BLOCKS words, which is
    counted first.
    """
    rules = rules.where("host <> '' and path is not null and verdict is not null") \
        .groupBy("host", "path").agg(F.max("verdict").alias("verdict")) \
        .withColumn("key", _key(F.col("host"), F.col("path")))
    shape = rules.agg(F.count(F.lit(1)).alias("n"),
                      F.sort_array(F.collect_set(F.length("path"))).alias("lengths")).first()
    judged = pages.withColumn("host", host_of(F.col("url"))) \
        .withColumn("path", path_of(F.col("url")))
    if not shape["n"]:
        return judged.withColumn("rule", F.lit(None).cast("string")) \
            .withColumn("verdict", F.lit(default))
    blocks = -(-shape["n"] // KEYS_PER_BLOCK)
    words = bloom_filter(rules, blocks)
    if blocks <= BROADCAST_BLOCKS:
        words = F.broadcast(words)
    urls = judged.select("host", "path").where("host <> ''").distinct()
    tried = _candidates(urls, shape["lengths"]) \
        .withColumn("block", _block(F.col("key"), blocks)).join(words, "block") \
        .where(F.col("word").bitwiseAND(_word(F.col("key"))) == _word(F.col("key")))
    hits = tried.select("host", "path", "key", "at_host", "at_path").join(
        rules.select("key", F.col("host").alias("at_host"), F.col("path").alias("at_path"),
                     "verdict"), ["key", "at_host", "at_path"])
    best = hits.groupBy("host", "path").agg(F.max(F.struct(
        (F.length("at_host") + F.length("at_path")).alias("size"),
        F.length("at_host").alias("part"), "verdict",
        F.concat("at_host", "at_path").alias("rule"))).alias("best"))
    found = best.select("host", "path", F.col("best.rule").alias("rule"),
                        F.col("best.verdict").alias("verdict"))
    return judged.drop("rule", "verdict").join(found, ["host", "path"], "left") \
        .withColumn("verdict", F.coalesce("verdict", F.lit(default)))
