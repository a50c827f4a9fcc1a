"""
Benchmark decontamination by Wu-Manber search for the windows of test items in whole texts.

The symbols are words. Test strings are the windows of an item: WIDTH consecutive words, or the
whole item if it has fewer. Windows of one length make a table (Wu and Manber, "A fast algorithm
for multi-pattern searching", 1994):

1. shift: for each hash of a block of two words, how far the search may move on when it stands at
   the end of that block. It is the distance from the block's last place in any window to the
   window's end, and more where no window holds the block, so most words are never looked at.
2. bucket: at shift 0, the windows that end in the block.
3. The candidates of a bucket are compared word by word, by hash first and then by their bytes.

Texts are cut into lanes that all move at once, each by its own shift. A document is read once,
where it lies; nothing is shuffled. Windows are dealt by hash to parts of about PART_WINDOWS, the
bound of what is broadcast. Beyond one part documents are stored and searched once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.words import Words, fold, word_slices
from rollcall.session import discard, fresh_path, materialise

WIDTH = 10
BLOCK = 2
PART_WINDOWS = 200_000
LANE = 64                       # words a lane moves over
AT_ONCE = 65_536                # candidates compared at once

# Words are runs of letters, digits and whatever is not ASCII.
SEPARATES = np.ones(256, bool)
SEPARATES[128:] = False
for _low, _high in ("09", "AZ", "az"):
    SEPARATES[ord(_low):ord(_high) + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

FOUND = "struct<n_words: long, spans: array<struct<first: int, last: int, start: int, end: int>>, " \
        "items: array<string>>"
_SPAN = pa.struct([(n, pa.int32()) for n in ("first", "last", "start", "end")])


def _lowered(words: Words) -> bytes:
    return _LOWER[words.data].tobytes()


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, item) of each item: its words one behind the other, a space between."""
    for batch in batches:
        for words in word_slices(batch.column("text"), between=SEPARATES):
            data = _lowered(words)
            spelled = [data[a:b] for a, b in zip(words.starts, words.ends)]
            for t in range(len(words)):
                a, b = words.first[t], words.first[t + 1]
                width = min(WIDTH, b - a)
                own = sorted({b" ".join(spelled[i:i + width]) for i in range(a, b - width + 1)}) \
                    if width else []
                item = batch.column("item")[words.row + t].as_py()
                yield pa.record_batch({"window": pa.array(own, pa.binary()),
                                       "item": pa.array([item] * len(own), pa.string())})


class Table:
    """Shift table and suffix buckets of distinct windows that all have `width` words."""

    def __init__(self, windows: list[bytes], width: int):
        self.width, self.block, self.lane = width, min(BLOCK, width), LANE
        (words,) = word_slices(pa.array([w.decode() for w in windows]), 2 ** 62, SEPARATES)
        codes = words.codes.reshape(-1, width)
        bits = max(12, (8 * codes.size).bit_length())
        self.mask = np.uint64(2 ** bits - 1)
        self.shift = np.full(2 ** bits, width - self.block + 1, np.uint8)
        for end in range(self.block, width + 1):
            np.minimum.at(self.shift, self._hash(words.codes, np.arange(len(codes)) * width
                                                 + end - 1), width - end)
        suffix = self._hash(words.codes, np.arange(len(codes)) * width + width - 1)
        order = np.argsort(suffix, kind="stable")
        self.number = order
        self.suffixes, self.codes = suffix[order], codes[order]
        self.windows = [windows[k] for k in order]

    def _hash(self, codes: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (fold(codes, end - self.block + 1, self.block) & self.mask).astype(np.int64)

    def _stops(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(last word, block hash) of every place with shift 0."""
        begin = words.first[:-1] + self.width - 1
        lanes = np.maximum(0, -(-(words.first[1:] - begin) // self.lane))
        text = np.repeat(np.arange(len(words)), lanes)
        nth = np.arange(len(text)) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        at = begin[text] + nth * self.lane
        end = np.minimum(at + self.lane, words.first[1:][text])
        stops, hashes = [], []
        while len(at):
            found = self._hash(words.codes, at)
            step = self.shift[found].astype(np.int64)
            stop = step == 0
            stops.append(at[stop])
            hashes.append(found[stop])
            at = at + np.maximum(step, 1)
            going = at < end
            at, end = at[going], end[going]
        none = [np.zeros(0, np.int64)]
        return np.concatenate(stops or none), np.concatenate(hashes or none)

    def search(self, words: Words, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(first word, number of the window) of every occurrence."""
        stops, hashes = self._stops(words)
        low = np.searchsorted(self.suffixes, hashes)
        size = np.searchsorted(self.suffixes, hashes, "right") - low
        first, total = stops - self.width + 1, np.concatenate([[0], np.cumsum(size)])
        at, own = [], []
        for begin in range(0, int(total[-1]), AT_ONCE):
            pair = np.arange(begin, min(begin + AT_ONCE, int(total[-1])))
            stop = np.searchsorted(total, pair, "right") - 1
            window, where = low[stop] + pair - total[stop], first[stop]
            for k in range(self.width):
                same = words.codes[where + k] == self.codes[window, k]
                window, where = window[same], where[same]
            equal = np.fromiter((self._equal(words, data, i, w) for i, w in zip(where, window)),
                                bool, len(where))
            at.append(where[equal])
            own.append(self.number[window[equal]])
        none = [np.zeros(0, np.int64)]
        return np.concatenate(at or none), np.concatenate(own or none)

    def _equal(self, words: Words, data: bytes, first: int, window: int) -> bool:
        own = slice(first, first + self.width)
        return self.windows[window] == b" ".join(
            [data[a:b] for a, b in zip(words.starts[own], words.ends[own])])


class Search:
    """The windows of some items, by length, and the items of each."""

    def __init__(self, pairs: list[tuple[bytes, str | None]]):
        self.items = sorted({i for _, i in pairs if i is not None})
        place = {i: k for k, i in enumerate(self.items)}
        of: dict[bytes, list[int]] = {}
        for window, item in pairs:
            of.setdefault(window, []).extend([] if item is None else [place[item]])
        self.tables = []
        for width in range(1, WIDTH + 1):
            own = [w for w in of if w.count(b" ") + 1 == width]
            if own:
                listed = [of[w] for w in own]
                sizes = np.array([len(x) for x in listed])
                self.tables.append((Table(own, width), np.concatenate(
                    [np.array(x, np.int64) for x in listed]), np.cumsum(sizes) - sizes, sizes))

    def occurrences(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(whether each word is hit, text and item of every text that holds a window of it)."""
        steps = np.zeros(len(words.codes) + 1, np.int64)
        text = words.texts()
        found = [np.zeros(0, np.int64)]
        data = _lowered(words) if len(words.codes) else b""
        for table, listed, begin, sizes in self.tables:
            at, window = table.search(words, data)
            np.add.at(steps, at, 1)
            np.add.at(steps, at + table.width, -1)
            key = np.unique(text[at] * len(table.windows) + window)
            where, window = np.divmod(key, len(table.windows))
            n = sizes[window]
            nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            found.append(np.repeat(where, n) * len(self.items)
                         + listed[np.repeat(begin[window], n) + nth])
        owner, item = np.divmod(np.unique(np.concatenate(found)), max(1, len(self.items)))
        return np.cumsum(steps)[:-1] > 0, owner, item


def _result(words: Words, search: Search, before: pa.Array | None) -> tuple[list, list]:
    """Spans and items of each text, with what earlier parts found."""
    hit, owner, item = search.occurrences(words)
    spans: list[list] = []
    items = [[] for _ in range(len(words))]
    for t, k in zip(owner.tolist(), item.tolist()):
        items[t].append(search.items[k])
    for t in range(len(words)):
        a, b = words.first[t], words.first[t + 1]
        if before is not None:
            known = before[words.row + t].as_py()
            items[t] = sorted({*items[t], *known["items"]})
            for x in known["spans"]:
                hit[a + x["first"]:a + x["last"] + 1] = True
        own = hit[a:b]
        if not own.any():
            spans.append([])
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], own, [False]]).astype(np.int8)))
        low, high = words.offsets[t], words.offsets[t + 1]
        heads = np.concatenate([[0], np.cumsum((words.data[low:high] & 0xC0) != 0x80)])
        spans.append([{"first": int(i), "last": int(j - 1),
                       "start": int(heads[words.starts[a + i] - low]),
                       "end": int(heads[words.ends[a + j - 1] - low])}
                      for i, j in edges.reshape(-1, 2)])
    return spans, items


def _finder(search):
    @F.arrow_udf(FOUND)
    def found(texts: pa.Array, before: pa.Array) -> pa.Array:
        counts, spans, items = [], [], []
        earlier = before if before.null_count < len(before) else None
        for words in word_slices(texts, between=SEPARATES):
            s, i = _result(words, search.value, earlier)
            counts += words.counts.tolist()
            spans += s
            items += i
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(spans, pa.list_(_SPAN)),
             pa.array(items, pa.list_(pa.string()))], ["n_words", "spans", "items"])
    return found


def occurrences(docs: DataFrame, benchmark: DataFrame, item: str = "item_id") -> DataFrame:
    """
    docs (text, ...) with all its columns, n_words, spans and items; columns so named are replaced.

    Words are lower-cased in A-Z; they are runs of ASCII letters and digits and of characters beyond ASCII. spans
    are the maximal runs of words that lie in occurrences of the benchmark's windows: first and
    last word, start and end in characters of the text. items lists, once each and sorted as
    strings, the items of which a window occurs.

    A null or empty text has no words and no spans. Items without words have no window. A row of
    benchmark without an item id marks spans, but is not listed; rows that repeat an id are one item
    with the windows of all its texts. Every row of docs stays, repeated ones each by themselves;
    an empty table gives an empty one, an empty benchmark no spans.
    """
    spark = docs.sparkSession
    pairs = materialise(benchmark.select("text", F.col(item).cast("string").alias("item"))
                        .mapInArrow(_windows, "window binary, item string").distinct(), "windows")
    parts = max(1, -(-pairs.count() // PART_WINDOWS))
    dealt = F.pmod(F.xxhash64("window", "item"), F.lit(parts))
    rest = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    rows, stored = docs.select(*rest, F.lit(None).cast(FOUND).alias("_found")), None
    for part in range(parts):
        own = [(bytes(r[0]), r[1]) for r in pairs.where(dealt == part).toLocalIterator()]
        find = _finder(spark.sparkContext.broadcast(Search(own)))
        rows = rows.withColumn("_found", find(F.col("text"), F.col("_found")))
        if part < parts - 1:
            path = fresh_path(spark, "searched")
            rows.write.parquet(path)
            rows = spark.read.schema(rows.schema).parquet(path)
            if stored:
                discard(spark, stored)
            stored = path
    return rows.select(*rest, "_found.*")


def decontaminated(docs: DataFrame, benchmark: DataFrame, item: str = "item_id") -> DataFrame:
    """The rows of docs, all columns, in which no window of the benchmark occurs."""
    return occurrences(docs, benchmark, item).where("size(spans) = 0").select(*docs.columns)
