"""
Source divergence audit over the terms of a language, found by iceberg prefix refinement.

A term is kept if at least LEAST documents of its language have it. Kept terms are found level by
level: a level counts, for each prefix of so many bytes, the documents that have a term which begins so,
and discards prefixes of fewer than LEAST documents, as no term behind them can have more. The next level
looks only at longer prefixes of what stayed. It ends when no surviving prefix is shorter than its
term. Then the terms that survived are counted by source, and their exact document counts decide.

What a level tells the next one is a bitmap of FILTER_BITS of the surviving prefixes' hashes, so
what is broadcast never grows. A prefix that stays by a clash of hashes costs work, but changes
nothing, as the last count is of the terms themselves. Tasks add up what they count before the
shuffle, so that a frequent term is one row of a task.

Two sources of a language are compared over all kept terms: terms are dealt to blocks, a block gives
its part of the sum for each pair of sources, and the parts are added up.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.words import Words, mix, prefix_codes, stream, word_slices
from rollcall.session import materialise

LEAST = 3
FIRST_WIDTH, GROWTH = 6, 4      # bytes of the first level's prefixes; each later level's are longer
FILTER_BITS = 26
TALLY = 500_000                 # keys that a task adds up before it passes them on
BLOCK_COUNTS = 100_000          # counts of a block of terms
BLOCK_CELLS = 2_000_000         # sources times terms looked at together
TERM_RANKS = 200
SCALE = 1_000_000_000

# Terms are runs of letters and of whatever is not ASCII.
SEPARATES = np.ones(256, bool)
SEPARATES[128:] = False
for _low, _high in ("AZ", "az"):
    SEPARATES[ord(_low):ord(_high) + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ODD = stream(41, 1) | np.uint64(1)


def _keys(words: Words, at: np.ndarray, width: int, language: np.ndarray) -> np.ndarray:
    """A key of the prefix and language of each term in `at`; odd where the term goes on."""
    codes = mix(prefix_codes(words, at, width) ^ language[words.texts()[at]])
    return codes & ~np.uint64(1) | (words.ends[at] - words.starts[at] > width).astype(np.uint64)


def _in(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = (keys >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 > 0


class Tally:
    """Sums by key, and what the first row of a key has besides, of bounded size."""

    def __init__(self, sums: int, most: int):
        self.sums, self.most, self.parts, self.size = sums, most, [], 0

    def add(self, keys: np.ndarray, *columns: np.ndarray | pa.Array) -> bool:
        """Take rows; whether the tally is full and is to be drained."""
        self.parts.append([keys, *columns])
        self.size += len(keys)
        if self.size > 2 * self.most:
            self.parts = [self._joined()]
            self.size = len(self.parts[0][0])
        return self.size > self.most

    def _joined(self) -> list:
        keys, first, own = np.unique(np.concatenate([p[0] for p in self.parts]),
                                     return_index=True, return_inverse=True)
        out = [keys]
        for k in range(1, len(self.parts[0])):
            column = [p[k] for p in self.parts]
            if k <= self.sums:
                total = np.zeros(len(keys), np.int64)
                np.add.at(total, own, np.concatenate(column))
                out.append(total)
            elif isinstance(column[0], np.ndarray):
                out.append(np.concatenate(column)[first])
            else:
                out.append(pa.concat_arrays(column).take(pa.array(first)))
        return out

    def drain(self) -> list:
        """[keys, sums..., columns...], one row a key."""
        out = self._joined()
        self.parts, self.size = [], 0
        return out


def _level(widths: list[int], bitmap, most: int):
    """(key, docs) of the prefixes of the last width that go on from a surviving one."""
    def counted(tally: Tally) -> pa.RecordBatch:
        keys, docs = tally.drain()
        return pa.record_batch({"key": pa.array(keys.view(np.int64)), "docs": pa.array(docs)})

    def level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(1, most)
        for batch in batches:
            languages = batch.column("language").to_numpy().view(np.uint64)
            for words in word_slices(batch.column("text"), between=SEPARATES):
                language = languages[words.row:words.row + len(words)]
                at = np.arange(len(words.codes))
                if len(widths) > 1:
                    at = np.flatnonzero(words.ends - words.starts > widths[-2])
                    at = at[_in(bitmap.value, _keys(words, at, widths[-2], language))]
                keys, doc = _keys(words, at, widths[-1], language), words.texts()[at]
                order = np.lexsort((keys, doc))
                keys, doc = keys[order], doc[order]
                fresh = np.ones(len(keys), bool)
                fresh[1:] = (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])
                if fresh.any() and tally.add(*np.unique(keys[fresh], return_counts=True)):
                    yield counted(tally)
        if tally.size:
            yield counted(tally)
    return level


def _spelled(words: Words, at: np.ndarray) -> pa.Array:
    """The terms at `at`."""
    starts, lengths = words.starts[at], words.ends[at] - words.starts[at]
    ends = np.cumsum(lengths)
    place = np.arange(ends[-1] if len(at) else 0) - np.repeat(ends - lengths, lengths)
    data = _LOWER[words.data[np.repeat(starts, lengths) + place]]
    offsets = np.concatenate([[0], ends]).astype(np.int64)
    return pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))


def _counts(widths: list[int], bitmap, most: int):
    """(lang, source, term, docs, count) of the terms whose last level survived."""
    def counted(tally: Tally, groups: list) -> pa.RecordBatch:
        _, docs, count, group, term = tally.drain()
        names = [pa.array([g[k] for g in groups], pa.string()).take(pa.array(group))
                 for k in (0, 1)]
        return pa.record_batch({"lang": names[0], "source": names[1],
                                "term": term.cast(pa.string()),
                                "docs": pa.array(docs), "count": pa.array(count)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, groups = Tally(2, most), {}
        for batch in batches:
            languages = batch.column("language").to_numpy().view(np.uint64)
            named = [groups.setdefault(g, len(groups)) for g in zip(
                batch.column("lang").to_pylist(), batch.column("source").to_pylist())]
            own = np.array(named, np.int64)
            for words in word_slices(batch.column("text"), between=SEPARATES):
                rows = slice(words.row, words.row + len(words))
                language, lengths = languages[rows], words.ends - words.starts
                lived = np.zeros(len(words.codes), bool)
                for k, width in enumerate(widths):
                    at = np.flatnonzero((lengths <= width) & (lengths > ([0] + widths)[k]))
                    lived[at] = _in(bitmap.value, _keys(words, at, width, language))
                at = np.flatnonzero(lived)
                if not len(at):
                    continue
                doc, code = words.texts()[at], words.codes[at]
                order = np.lexsort((code, doc))
                at, doc, code = at[order], doc[order], code[order]
                fresh = np.ones(len(at), bool)
                fresh[1:] = (code[1:] != code[:-1]) | (doc[1:] != doc[:-1])
                first = np.flatnonzero(fresh)
                times = np.diff(first, append=len(at))
                group = own[rows][doc[first]]
                keys = mix(code[first] ^ (group.astype(np.uint64) * _ODD))
                keys, head, row = np.unique(keys, return_index=True, return_inverse=True)
                sums = [np.bincount(row, w, len(keys)).astype(np.int64)
                        for w in (None, times)]
                if tally.add(keys, *sums, group[head], _spelled(words, at[first][head])):
                    yield counted(tally, list(groups))
        if tally.size:
            yield counted(tally, list(groups))
    return count


def kept_terms(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """
    (lang, source, term, count, lang_count, head) of docs (text, lang, source): how often the
    documents of a source, and of the language, have a kept term. count is at least 1; head marks
    one row of each term of a language. Nulls are empty strings; rows are documents.
    """
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("text", "lang", "source")])
    rows = rows.withColumn("language", F.xxhash64("lang"))
    bitmap, widths, shared = np.zeros(2 ** FILTER_BITS // 8, np.uint8), [], None
    goes_on = True
    while goes_on:
        widths.append(widths[-1] * GROWTH if widths else FIRST_WIDTH)
        found = rows.select("text", "language").mapInArrow(_level(widths, shared, TALLY),
                                                           "key long, docs long")
        lived = found.groupBy("key").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        bit = F.shiftrightunsigned("key", 64 - FILTER_BITS)
        parts = lived.groupBy(F.shiftright(bit, 15).alias("part")).agg(
            F.bitmap_construct_agg(bit.bitwiseAND(F.lit(32767))).alias("bits"),
            F.sum(F.col("key").bitwiseAND(F.lit(1))).alias("open"))
        goes_on = False
        # At most 2 ** (FILTER_BITS - 15) rows of 4 KB.
        for part, bits, left in parts.toLocalIterator():
            bitmap[part * 4096:(part + 1) * 4096] |= np.frombuffer(bits, np.uint8)
            goes_on |= left > 0
        shared = spark.sparkContext.broadcast(bitmap)
    counted = rows.mapInArrow(_counts(widths, shared, TALLY),
                              "lang string, source string, term string, docs long, count long")
    # One exchange by term serves the sums of sources and of the language.
    summed = counted.repartition("lang", "term").groupBy("lang", "term", "source") \
        .agg(F.sum("docs").alias("docs"), F.sum("count").alias("count"))
    term = Window.partitionBy("lang", "term")
    return summed.select(
        "lang", "source", "term", "count", F.sum("docs").over(term).alias("docs"),
        F.sum("count").over(term).alias("lang_count"),
        (F.min("source").over(term) == F.col("source")).alias("head")) \
        .where(F.col("docs") >= least).drop("docs")


def _share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / (total + terms)), exact."""
    top = (count.cast("decimal(20,0)") + 1) * F.lit(SCALE)
    return F.call_function("div", top, (total + terms).cast("decimal(20,0)")) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


BLOCK = "lang string, source string, item string, value long"


def _pairs(cells: int):
    """The part of each two sources' sum that the terms of a block make."""
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                members, sources = (pa.StructArray.from_arrays(x.flatten(), names=[
                    x.type[i].name for i in range(x.type.num_fields)]) for x in (
                    batch.column(c)[k].values for c in ("members", "sources")))
                names, none = sources.field("source"), sources.field("none").to_numpy()
                row = pc.index_in(members.field("source"), names).to_numpy()
                term = pc.dictionary_encode(members.field("term")).indices.to_numpy()
                p = members.field("p").to_numpy()
                order = np.argsort(term, kind="stable")
                row, term, p = row[order], term[order], p[order]
                total = np.zeros((len(names), len(names)), np.int64)
                width = max(1, cells // len(names))
                for low in range(0, int(term[-1]) + 1, width):
                    a, b = np.searchsorted(term, [low, low + width])
                    shares = np.repeat(none[:, None], min(width, int(term[-1]) + 1 - low), 1)
                    shares[row[a:b], term[a:b] - low] = p[a:b]
                    for g in range(len(names)):
                        away = shares[g] - shares
                        total[g] += (away * away // shares).sum(1)
                lang = batch.column("lang")[k].as_py()
                g, h = np.nonzero(~np.eye(len(names), dtype=bool))
                yield pa.record_batch({
                    "lang": pa.array([lang] * len(g), pa.string()),
                    "source": names.take(pa.array(g)), "item": names.take(pa.array(h)), "value": pa.array(total[g, h])})
    return pairs


def audit(docs: DataFrame, least: int = LEAST, term_ranks: int = TERM_RANKS) -> DataFrame:
    """
    (lang, source, part, item, value, rank) of docs (text, lang, source, ...).

    Terms are lower-cased in A-Z; they are runs of ASCII letters and of characters beyond ASCII. A
    language's kept terms are those that at least `least` of its documents have; a source gives each the
    share p = 1 + floor(10^9 (count + 1) / (all counts + kept terms)), the language likewise. The
    distance of p from q is floor((p - q)^2 / q).

    Part "pair": each other source of the language as q, its distances added up over all kept
    terms; 0 if there are none. Part "term": the kept terms that the source has with a share
    above the language's, by their distance from it, the first `term_ranks`. Ranks go down by value,
    ties by the item's bytes.

    Every row is a document, also one that repeats a doc_id or a text. A null text, lang or source is
    an empty one; a source without terms is compared too; a language of one source has no pairs.
    Terms of any length are counted. Other columns are not looked at; an empty table gives an empty
    one.
    """
    counts = materialise(kept_terms(docs, least), "kept_terms")
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                           for c in ("lang", "source")]).distinct()
    sums = counts.groupBy("lang", "source").agg(F.sum("count").alias("total"),
                                                F.count(F.lit(1)).alias("rows"),
                                                F.count_if("head").alias("heads"))
    whole = Window.partitionBy("lang")
    # One row for each source of a language.
    sizes = materialise(
        groups.join(sums, ["lang", "source"], "left").na.fill(0, ["total", "rows", "heads"])
        .select("lang", "source", "total", F.sum("total").over(whole).alias("lang_total"),
                F.sum("heads").over(whole).alias("terms"),
                F.sum("rows").over(whole).alias("rows")), "sizes")
    shares = counts.join(sizes, ["lang", "source"]).select(
        "lang", "source", "term", "rows", _share(F.col("count"), F.col("total"), F.col("terms"))
        .alias("p"), _share(F.col("lang_count"), F.col("lang_total"), F.col("terms")).alias("q"))

    block = F.pmod(F.xxhash64("term"), F.ceil(F.col("rows") / BLOCK_COUNTS))
    blocks = shares.groupBy("lang", block.alias("block")).agg(
        F.collect_list(F.struct("source", "term", "p")).alias("members"))
    others = sizes.where("terms > 0").groupBy("lang").agg(F.collect_list(F.struct(
        "source", _share(F.lit(0), F.col("total"), F.col("terms")).alias("none"))).alias("sources"))
    parts = blocks.join(others, "lang").drop("block").mapInArrow(_pairs(BLOCK_CELLS), BLOCK)
    pairs = sizes.select("lang", "source") \
        .join(sizes.select("lang", F.col("source").alias("item")), "lang").where("source <> item") \
        .join(parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")),
              ["lang", "source", "item"], "left") \
        .select("lang", "source", F.lit("pair").alias("part"), "item",
                F.coalesce("value", F.lit(0)).alias("value"))
    terms = shares.where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
        _distance(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).union(
        terms.withColumn("rank", rank).where(F.col("rank") <= term_ranks))
