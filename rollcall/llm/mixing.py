"""
Mixing sources to target weights.

The words of a source, one document behind the other, are cut into blocks of a fixed length. A source
gives as many slots of the mix as its target needs; output shards get their share of them by
multinomial draws. A source's slots are numbered over all shards and mapped to its blocks by
pseudorandom permutations of the block indices, one for each time that the source is gone through, so
no block comes again before all others have come as often. Blocks are joined to the slots by
index. Everything follows from the seed and the table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.ordering import running
from rollcall.llm.words import mix, word_slices
from rollcall.session import materialise

WEIGHTS = (5.0, 2.0, 1.0)
REPEATS = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1_000_000
SEED = 20_240
FEISTEL_ROUNDS = 6


def word_count(text: Column) -> Column:
    @F.arrow_udf("long")
    def counted(texts: pa.Array) -> pa.Array:
        parts = [words.counts for words in word_slices(texts)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0, np.int64), pa.int64())
    return counted(text)


def source_targets(sources: DataFrame, weights: tuple = WEIGHTS,
                   repeats: int = REPEATS) -> DataFrame:
    """
    Add target to sources (source, source_size): one row each, null a source of its own.

    Sources in code point order, null last, weigh as `weights` says, again and again. They share
    the sum of all sizes by weight; a target stops at `repeats` times its source's size, and what
    is above is shared by the others in the same way, until none is above.
    """
    numbered = running(sources.withColumn("_null", F.col("source").isNull())
                       .withColumn("_key", F.coalesce("source", F.lit(""))),
                       ["_null", "_key"], F.lit(1), "_place", "sources")
    share = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         (F.pmod("_place", F.lit(len(weights))) + 1).cast("int"))
    weighed = materialise(numbered.withColumn("_weight", share).drop("_null", "_key"), "weights")
    most = F.col("source_size") * repeats
    level = -1.0
    while True:
        # Sources at their limit stay there, as the level only rises.
        free = most > F.lit(level) * F.col("_weight")
        sums = weighed.agg(F.sum("source_size").alias("all"),
                           F.sum(F.when(~free, most)).alias("held"),
                           F.sum(F.when(free, F.col("_weight"))).alias("weight")).first()
        if not sums["weight"]:
            break
        new = (sums["all"] - (sums["held"] or 0)) / sums["weight"]
        if new <= level:
            break
        level = new
    return weighed.withColumn("target", F.least(
        most.cast("double"), F.lit(float(level)) * F.col("_weight"))).drop("_weight")


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """
    The places of some indices in a pseudorandom permutation of 0 to size - 1.

    A Feistel network permutes the next power of four; what falls outside goes through again.
    """
    half = max(1, (max(1, size - 1).bit_length() + 1) // 2)
    low = np.uint64(2 ** half - 1)
    keys = mix(np.uint64(key) + np.arange(FEISTEL_ROUNDS, dtype=np.uint64))

    def once(x):
        a, b = x >> np.uint64(half), x & low
        for k in keys:
            a, b = b, a ^ (mix(b ^ k) & low)
        return a << np.uint64(half) | b

    out = index.astype(np.uint64)
    open_ = np.arange(len(out))
    while len(open_):
        out[open_] = once(out[open_])
        open_ = open_[out[open_] >= size]
    return out.astype(np.int64)


def _seed_of(*parts) -> int:
    text = "\0".join(map(str, parts)).encode()
    return int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "little")


def _draws(seed: int, shards: int):
    """The slots that each output shard gets from a source, and the first one's number."""
    def draw(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples():
                name = _seed_of(seed, row.source is None, row.source)
                random = np.random.default_rng(name)
                counts = random.multinomial(row.slots, np.full(shards, 1 / shards))
                shard = np.flatnonzero(counts)
                first = np.cumsum(counts) - counts
                yield pd.DataFrame({"number": row.number, "blocks": row.blocks,
                                    "key": np.int64(name >> 2), "shard": shard,
                                    "first": first[shard], "count": counts[shard]})
    return draw


SLOTS = "number long, shard long, slot long, block long"


def _slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            for low in range(row["first"], row["first"] + row["count"], 100_000):
                slot = np.arange(low, min(low + 100_000, row["first"] + row["count"]))
                time = slot // row["blocks"]
                block = np.empty(len(slot), np.int64)
                for t in np.unique(time):
                    own = time == t
                    block[own] = permuted(slot[own] % row["blocks"], row["blocks"],
                                          _seed_of(row["key"], t))
                size = len(slot)
                yield pa.record_batch({
                    "number": pa.array(np.full(size, row["number"])),
                    "shard": pa.array(np.full(size, row["shard"])),
                    "slot": pa.array(slot), "block": pa.array(block)})


class Mix:
    """
    The mix of docs (doc_id, text, source, ...).

    placed    every row: doc_id, source, mark (hash of the text), size in words, source_size,
              target, number (of its source), start (words of its source before it), length
    slots     (number, shard, slot, block): which block each slot of the output takes
    segments  (number, start, doc_id, ..., block, low, high, times): the words low to high of a
              document that lie in a block, and how often the mix takes the block

    A null source is a source, a null text has no words and is in no block. Documents of a source
    stand in the order of doc_id, nulls first, and of a hash of the text; rows equal in both
    are alike, so which comes first makes no difference. `times` is REPEATS at most. An empty
    table gives empty ones. Other columns are not looked at.
    """

    def __init__(self, docs: DataFrame, weights: tuple = WEIGHTS, repeats: int = REPEATS,
                 block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
                 seed: int = SEED):
        sized = docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string")
            .alias("source"), F.xxhash64("text").alias("mark"), word_count(F.col("text"))
            .alias("size")).withColumn("key", F.concat(F.when(F.col("source").isNull(), "n")
                                       .otherwise("s"), F.coalesce("source", F.lit(""))))
        ordered = materialise(running(sized, ["key", "doc_id", "mark"], F.col("size"), "before",
                                      "sized"), "ordered")
        sources = ordered.groupBy("key").agg(
            F.first("source").alias("source"), F.sum("size").alias("source_size"),
            F.min("before").alias("base"))
        aimed = source_targets(sources.select("key", "source", "source_size", "base"), weights,
                               repeats)
        size = F.col("source_size")
        aimed = aimed.withColumn("length", F.ceil(
            size / F.greatest(F.ceil(size / block_words), F.lit(1)))) \
            .withColumn("blocks", F.when(size > 0, F.ceil(size / F.col("length"))).otherwise(0)) \
            .withColumn("slots", F.when(size > 0, F.least(
                F.round(F.col("target") * F.col("blocks") / size).cast("long"),
                F.col("blocks") * repeats)).otherwise(0)) \
            .withColumnRenamed("_place", "number")
        aimed = materialise(aimed, "targets")
        total = aimed.agg(F.sum("source_size")).first()[0] or 0
        shards = int(max(1, -(-total // shard_words)))
        draws = aimed.where("slots > 0").select("source", "number", "blocks", "slots") \
            .mapInPandas(_draws(seed, shards), "number long, blocks long, key long, shard long, "
                                               "first long, count long")
        self.slots = draws.repartition("number", "shard").mapInArrow(_slots, SLOTS)
        # A source may have a third of all rows; the sources' table is joined by a shuffle that
        # the adaptive planner splits, or broadcast where it proves small.
        self.placed = ordered.join(aimed.drop("source"), "key") \
            .withColumn("start", F.col("before") - F.col("base")) \
            .select("doc_id", "source", "mark", "size", "source_size", "target", "number", "start",
                    "length")
        # As many rows as blocks, though they come from a small table: never to be broadcast.
        times = self.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("times")) \
            .hint("merge")
        held = self.placed.where("size > 0").withColumn("block", F.explode(F.sequence(
            F.expr("start div length"), F.expr("(start + size - 1) div length"))))
        first = F.col("block") * F.col("length") - F.col("start")
        self.segments = held.withColumn("low", F.greatest(first, F.lit(0).cast("long"))) \
            .withColumn("high", F.least(first + F.col("length"), F.col("size"))) \
            .join(times, ["number", "block"]).drop("length")

    def taken(self) -> DataFrame:
        """(doc_id, size, source_size, target, taken) of every row: the words the mix takes of it,
        repeats counted."""
        by_doc = ["number", "start", "doc_id", "mark", "size"]
        words = self.segments.groupBy(*by_doc).agg(
            F.sum((F.col("high") - F.col("low")) * F.col("times")).alias("taken"))
        found = self.placed.join(words.select("number", "start", "size", "taken").hint("merge"),
                                 ["number", "start", "size"], "left")
        return found.select("doc_id", "size", "source_size", "target",
                            F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def _cut(text: Column, pieces: Column, copies: Column) -> Column:
    """For each of a text's copies in the mix, the words that are taken, as they stand."""
    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, takes: pa.Array, counts: pa.Array) -> pa.Array:
        out = []
        wanted, n = takes.to_pylist(), counts.to_pylist()
        for words in word_slices(texts):
            data = words.data.tobytes()
            for t in range(len(words)):
                row = words.row + t
                first, end = words.first[t], words.first[t + 1]
                # Words go on to where the next one starts, the last one to the text's end.
                starts = np.append(words.starts[first:end], words.offsets[t + 1])
                starts[0] = words.offsets[t]
                drawn: list[list[bytes]] = [[] for _ in range(n[row] or 0)]
                for piece in sorted(wanted[row] or [], key=lambda p: (p["nth"], p["low"])):
                    part = data[starts[piece["low"]]:starts[piece["high"]]]
                    for time in range(piece["times"]):
                        drawn[piece["nth"] * REPEATS + time].append(part)
                out.append([b"".join(x).decode() for x in drawn if x])
        return pa.array(out, pa.list_(pa.string()))
    return cut(text, pieces, copies)


def mixed(docs: DataFrame) -> DataFrame:
    """
    The documents of the mix, with all columns of docs (doc_id, text, source, ...).

    The n-th row of a document, of three at most, holds in order the words that the mix takes
    at least n times. Documents of which it takes nothing, also those without words, are not
    in it. Rows equal in doc_id, source and text share what is taken of them.
    """
    whole = Mix(docs)
    pieces = whole.segments.select(
        F.struct("doc_id", "source", "mark").alias("_doc"), "start", "low", "high",
        F.col("times").cast("int").alias("times"))
    # The copies of equal rows, told apart by where they stand.
    nth = F.transform("_all", lambda p: F.struct(
        (F.array_position("_starts", p["start"]) - 1).cast("int").alias("nth"), p["low"].alias("low"),
        p["high"].alias("high"), p["times"].alias("times")))
    takes = pieces.groupBy("_doc").agg(
        F.collect_list(F.struct("start", "low", "high", "times")).alias("_all"),
        F.sort_array(F.collect_set("start")).alias("_starts")) \
        .select(_packed("_doc").alias("_at"), nth.alias("_pieces"),
                (F.size("_starts") * REPEATS).alias("_copies"))
    own = F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                   F.col("source").cast("string").alias("source"),
                   F.xxhash64("text").alias("mark"))
    keyed = docs.withColumn("_own", own).withColumn("_at", _packed("_own")).drop("_own") \
        .dropDuplicates(["_at"])
    found = keyed.join(takes.hint("merge"), "_at")
    texts = found.withColumn("_texts", _cut(F.col("text"), F.col("_pieces"), F.col("_copies")))
    return texts.withColumn("_text", F.explode("_texts")) \
        .select(*[F.col("_text").alias("text") if c == "text" else F.col(c) for c in docs.columns])


def _packed(doc: str) -> Column:
    """A document's id, source and text mark as one text that is never null."""
    return F.to_json(F.col(doc))
