"""
Removing passages that repeat across documents: hashed lines, extended word by word.

Lines are cut where the words say so and not where a copy happens to break them: behind every word
whose hash is the least of some LINE words in a row (A-Z lower-cased, white space folded). A line has
at most LINE words, and any two texts that share 2 * LINE words share a whole line.

1. Texts of the same words are a class; the row with the smallest doc_id heads it, and all others of it
   repeat it as a whole. Only the words of a class are compared with other classes.
2. The digests of all lines are grouped over all texts; lines of one class alone are done with.
3. A repeated line is extended: the windows of MIN_WORDS words whose own lines are all repeated
   give 128-bit digests, which are grouped again. The class that ranks first keeps a window, all later ones
   repeat it; in one text the first one counts, and later ones that do not overlap it repeat it.
4. The words in repeated windows are removed, and their places in the original text returned. A word
   outside a run of MIN_WORDS words that an earlier place has always stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from rollcall.llm.ordering import running
from rollcall.llm.words import Words, mix, powers, stream, word_slices
from rollcall.session import materialise

MIN_WORDS = 25
LINE = 12                       # 2 * LINE <= MIN_WORDS, so that every window holds a whole line

_BASES = stream(31, 3) | np.uint64(1)
_CUT = stream(32, 1)


def _inside(words: Words, width: int) -> np.ndarray:
    """Of each run of `width` words, by its first word, whether it lies in one text."""
    text = words.texts()
    return text[:len(text) - width + 1] == text[width - 1:]


def _hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray, base: np.uint64) -> np.ndarray:
    """A hash of each run of words."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix(codes ^ base) * powers(len(codes), base), out=sums[1:])
    back = powers(len(codes) + 1, np.uint64(pow(int(base), -1, 2 ** 64)))
    return mix((sums[end] - sums[begin]) * back[begin] ^ mix((end - begin).astype(np.uint64)))


def _cuts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(by the first of LINE words in a row, which of them is the least; all of these, ascending)."""
    none = np.zeros(0, np.int64)
    if len(words.codes) < LINE:
        return none, none
    least = np.lib.stride_tricks.sliding_window_view(mix(words.codes ^ _CUT), LINE).argmin(1)
    least += np.arange(len(least))
    return least, np.unique(least[_inside(words, LINE)])


def _lines(words: Words, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(the text, a hash) of the line between each cut and the next one; -1 if it is in another text."""
    text = words.texts()[cuts]
    return np.where(text[:-1] == text[1:], text[:-1], -1), \
        _hashes(words.codes, cuts[:-1], cuts[1:], _BASES[2]).view(np.int64)


def _class(words: Words, k: int) -> np.ndarray:
    """A digest of all words of each text."""
    return _hashes(words.codes, words.first[:-1], words.first[1:], _BASES[k]).view(np.int64)


def _classes(text: Column) -> Column:
    """(d1, d2, n) of a text: a digest of all its words, and their number."""
    @F.arrow_udf("struct<d1: long, d2: long, n: long>")
    def classes(texts: pa.Array) -> pa.Array:
        parts = [[np.zeros(0, np.int64)] for _ in range(3)]
        for words in word_slices(texts):
            for part, values in zip(parts, (_class(words, 0), _class(words, 1), words.counts)):
                part.append(values)
        return pa.StructArray.from_arrays([pa.array(np.concatenate(p)) for p in parts],
                                          ["d1", "d2", "n"])
    return classes(text)


def _line_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(line, _d1) of each text, without repeats."""
    for batch in batches:
        for words in word_slices(batch.column("text")):
            owner, lines = _lines(words, _cuts(words)[1])
            order = np.lexsort((lines, owner))
            order = order[owner[order] >= 0]
            lines, owner = lines[order], owner[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (lines[1:] != lines[:-1]) | (owner[1:] != owner[:-1])
            yield pa.record_batch({"line": pa.array(lines[fresh]),
                                   "_d1": pa.array(_class(words, 0)[owner[fresh]])})


def _lists(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all values, where each row's begin, and one more)."""
    listed = lists.fill_null([]) if lists.null_count else lists
    return listed.flatten().to_numpy(zero_copy_only=False), \
        np.concatenate([[0], np.cumsum(listed.value_lengths().to_numpy())])


def _listed(words: Words, hashes: np.ndarray, first: np.ndarray, flat: np.ndarray,
            at: np.ndarray) -> np.ndarray:
    """Which hashes are in the list of their text's row; `first` has where each text's begin."""
    found = np.zeros(len(hashes), bool)
    for t in np.flatnonzero(np.diff(at[words.row:words.row + len(words) + 1])):
        a, b, row = first[t], first[t + 1], words.row + t
        found[a:b] = np.isin(hashes[a:b], flat[at[row]:at[row + 1]])
    return found


def _digests(words: Words, at: np.ndarray, k: int) -> np.ndarray:
    """Of the windows that begin at these words."""
    return _hashes(words.codes, at, at + MIN_WORDS, _BASES[k]).view(np.int64)


def _steps(size: int, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """How many of the ranges hold each of the places 0 to size - 1."""
    some = begin < end
    return np.cumsum(np.bincount(begin[some], minlength=size + 1)
                     - np.bincount(end[some], minlength=size + 1))[:size]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(w1, w2, rank) of the windows whose own lines are all in the row's list."""
    for batch in batches:
        batch = batch.filter(batch.column("_own"))
        flat, at = _lists(batch.column("_lines"))
        for words in word_slices(batch.column("text")):
            total = len(words.codes)
            if total < MIN_WORDS:
                continue
            least, cuts = _cuts(words)
            owner, lines = _lines(words, cuts)
            known = _listed(words, lines, np.searchsorted(cuts, words.first), flat, at)
            # Whoever shares a window has its lines from the first cut that no word before the
            # window has a part in to the last that none behind it has.
            own = np.flatnonzero(_inside(words, MIN_WORDS))
            low, high = (np.searchsorted(cuts, least[own + k]) for k in (0, MIN_WORDS - LINE))
            other = np.concatenate([[0], np.cumsum(~known)])
            own = own[other[high] == other[low]]
            ranks = batch.column("_rank").slice(words.row, len(words)).to_numpy()
            text = words.texts()[own]
            w1, w2 = _digests(words, own, 0), _digests(words, own, 1)
            order = np.lexsort((w2, w1, text))
            w1, w2, text = w1[order], w2[order], text[order]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (text[1:] != text[:-1]) | (w1[1:] != w1[:-1]) | (w2[1:] != w2[:-1])
            yield pa.record_batch({"w1": pa.array(w1[fresh]), "w2": pa.array(w2[fresh]),
                                   "rank": pa.array(ranks[text[fresh]])})


def _again(words: Words, digests: np.ndarray) -> np.ndarray:
    """Windows that their text has before, without a common word."""
    text = words.texts()[:len(digests)]
    order = np.lexsort((digests, text))
    d, t = digests[order], text[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (t[1:] != t[:-1]) | (d[1:] != d[:-1])
    first = order[np.flatnonzero(fresh)[np.cumsum(fresh) - 1]]
    out = np.zeros(len(order), bool)
    out[order] = order - first >= MIN_WORDS
    return out


def _covered(words: Words, flat: np.ndarray, at: np.ndarray, copies: np.ndarray) -> np.ndarray:
    """The words of repeated windows, and all words of copies."""
    total, text = len(words.codes), words.texts()
    whole = copies[words.row:words.row + len(words)][text]
    if total < MIN_WORDS:
        return whole
    start = np.arange(total - MIN_WORDS + 1)
    digests = _digests(words, start, 0)
    first = np.minimum(words.first, len(start))
    repeated = _again(words, digests) | _listed(words, digests, first, flat, at)
    start = start[repeated & _inside(words, MIN_WORDS)]
    return whole | (_steps(total, start, start + MIN_WORDS) > 0)


# What cannot be null needs no filter, so that all uses of an exchange are the same.
LONGS = "w1 long not null, w2 long not null, rank long not null"
SPANS = "struct<text: string, removed: array<struct<start: int, end: int>>>"


def _without(text: Column, repeats: Column, copy: Column) -> Column:
    """A text without its repeated passages, and their places in characters of the original."""
    @F.arrow_udf(SPANS)
    def without(texts: pa.Array, lists: pa.Array, copied: pa.Array) -> pa.Array:
        kept, spans = [], []
        flat, listed_at = _lists(lists)
        copies = copied.to_numpy(zero_copy_only=False).astype(bool)
        for words in word_slices(texts):
            covered = _covered(words, flat, listed_at, copies)
            data = words.data.tobytes()
            for t in range(len(words)):
                a, b = words.first[t], words.first[t + 1]
                low, high = int(words.offsets[t]), int(words.offsets[t + 1])
                edges = np.flatnonzero(np.diff(np.concatenate(
                    [[False], covered[a:b], [False]]).astype(np.int8)))
                cuts = [(int(words.starts[a + i]), int(words.starts[a + j]) if a + j < b else high)
                        for i, j in edges.reshape(-1, 2)]
                if not cuts:
                    kept.append(data[low:high].decode())
                    spans.append([])
                    continue
                heads = np.concatenate([[0], np.cumsum((words.data[low:high] & 0xC0) != 0x80)])
                spans.append([{"start": int(heads[i - low]), "end": int(heads[j - low])}
                              for i, j in cuts])
                parts, at = [], low
                for i, j in cuts:
                    parts.append(data[at:i])
                    at = j
                kept.append(b"".join([*parts, data[at:high]]).decode())
        place = pa.struct([("start", pa.int32()), ("end", pa.int32())])
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.string()), pa.array(spans, pa.list_(place))], ["text", "removed"])
    return without(text, repeats, copy)


def _shared(rows: DataFrame, keys: list[str], owner: str) -> DataFrame:
    """The keys that more than one owner has, with the least owner."""
    return rows.groupBy(*keys).agg(F.min(owner).alias("least"), F.max(owner).alias("most")) \
        .where("most > least").drop("most")


def without_repeats(docs: DataFrame) -> DataFrame:
    """
    docs (doc_id, text, ...) with all its columns, the text without repeated passages, and
    removed, an array of (start, end) in characters of the original text; a column so named is
    replaced. Every row stays, if with an empty text.

    Documents rank by doc_id, rows without one last; rows that share a doc_id, or have none, by a
    digest of their words. Rows of the same words and doc_id rank by a hash of all their columns; of
    rows that are equal in all columns one keeps its text. A null text stays null, with nothing
    removed; texts of fewer than MIN_WORDS words stay as they are. An empty table gives an empty one.
    """
    columns = [c for c in docs.columns if c != "removed"]
    long = F.col("_class.n") >= MIN_WORDS
    own = F.xxhash64("_id", "_hash")
    # Rows too short for a passage meet nothing: they are dealt by themselves.
    rows = docs.select(*columns, F.col("doc_id").cast("long").alias("_id"),
                       F.xxhash64(*columns).alias("_hash"), _classes(F.col("text")).alias("_class")) \
        .select(*columns, "_id", "_hash", long.alias("_long"),
                F.coalesce(F.when(long, F.col("_class.d1")), own).alias("_d1"),
                F.coalesce(F.when(long, F.col("_class.d2")), own).alias("_d2"))
    place = [F.col("_id").isNull().alias("_none"), F.coalesce("_id", F.lit(0)).alias("_least"),
             F.col("_hash").alias("_head")]
    heads = rows.where("_long").groupBy("_d1", "_d2", *place) \
        .agg(F.count(F.lit(1)).alias("_times")).groupBy("_d1", "_d2") \
        .agg(F.min(F.struct("_none", "_least", "_head", "_times")).alias("_first")) \
        .select("_d1", "_d2", "_first.*")
    # One narrow row for each class, with its place among all.
    heads = materialise(running(heads, ["_none", "_least", "_d1", "_d2"], F.lit(1), "_rank",
                                "ranks"), "heads")

    # One exchange serves both what counts a line's texts and what gives it back to them.
    lines = docs.select("text").mapInArrow(
        _line_rows, "line long not null, _d1 long not null").repartition("line")
    shared = _shared(lines, ["line"], "_d1").select("line")
    hits = lines.join(shared.hint("merge"), "line").groupBy("_d1") \
        .agg(F.collect_set("line").alias("_lines"))

    # All joins take all columns of the same rows by class, so one exchange serves them.
    is_head = (F.col("_id").isNull() == F.col("_none")) & (F.col("_hash") == F.col("_head")) \
        & (F.coalesce("_id", F.lit(0)) == F.col("_least"))
    # Whether a row heads its class is asked behind the join, which goes by class alone.
    windows = rows.join(heads.join(hits, "_d1").hint("merge"), ["_d1", "_d2"]) \
        .withColumn("_own", is_head).mapInArrow(_windows, LONGS).repartition("w1", "w2")
    repeats = windows.join(_shared(windows, ["w1", "w2"], "rank").hint("merge"), ["w1", "w2"]) \
        .where("rank > least").groupBy(F.col("rank").alias("_rank")) \
        .agg(F.collect_set("w1").alias("_repeats"))
    joined = rows.join(heads.join(repeats, "_rank", "left").hint("merge"), ["_d1", "_d2"], "left") \
        .withColumn("_copy", F.col("_long") & ~is_head)
    # Of head rows that are equal in all columns the first keeps its text.
    alike = ~F.col("_copy") & (F.col("_times") > 1)
    first = joined.where(alike).dropDuplicates(columns) \
        .withColumn("_copy", F.explode(F.transform(F.sequence(F.lit(1), F.col("_times").cast("int")),
                                                   lambda k: k > 1)))
    cleaned = joined.where(~F.coalesce(alike, F.lit(False))).unionByName(first).withColumn(
        "_clean", _without(F.col("text"), F.col("_repeats"), F.coalesce("_copy", F.lit(False))))
    return cleaned.select(
        *[F.when(F.col("text").isNotNull(), F.col("_clean.text")).alias("text")
          if c == "text" else F.col(c) for c in columns], F.col("_clean.removed").alias("removed"))
