"""
Hard negatives by search with length and coordinate pruning.

An anchor's positives are its best rows of the same label; a hard negative is a row of another
label whose score lies in a range below a positive's. Scores are inner products of whole numbers.

Rows are dealt to shards. A shard holds its rows by falling length, in buckets, and for a bucket the
sorted list of each coordinate of its unit vectors that a search asks for (Teflioudi, Gemulla and
Mykytiuk, "LEMP: fast retrieval of large entries in a matrix product", 2015). An anchor that looks for
scores of at least `least` goes through the buckets:

1. least / (its length * the bucket's greatest length) is a bound of the cosine. Above 1, this
   bucket and all shorter ones are left out.
2. The bound gives a feasible range of each of the anchor's focus coordinates, its largest ones: the
   angle to the axis differs from the anchor's by the bound's angle at most. Ranges that leave enough
   out are looked up in the sorted lists, and only rows in all of them are candidates.
3. Candidates are verified by their exact scores; `least` rises to the last score that still counts.

Tiles of anchors meet every shard in the cells of a grid; in a cell, what one shard finds raises the
score that the next ones look for. What a cell finds best is ranked over all of them by a window that
drops what is too far down before its shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.llm.topk import whole_products
from rollcall.llm.vectors import cells, numbered, row_numbers, tile_of, tiled, unpacked
from rollcall.session import materialise

ANCHOR_ROWS, SHARD_ROWS = 1000, 4000
BUCKET_ROWS = 500
FOCUS = 5
LEFT_OUT = 0.9                  # a range that holds more of a bucket than that is not looked up
SLACK = 1e-9                    # above all rounding of the double arithmetic in the bounds
MOST = 2 ** 63 - 1


class Probes:
    """The rows of a shard in length buckets."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, x: np.ndarray,
                 bucket: int = BUCKET_ROWS):
        length = np.linalg.norm(x, axis=1)
        order = np.argsort(-length, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        self.x, self.length = x[order], length[order]
        self.unit = self.x / np.where(self.length > 0, self.length, 1)[:, None]
        self.buckets = [(k, min(k + bucket, len(ids))) for k in range(0, len(ids), bucket)]
        self.largest = np.abs(x).max(initial=0)
        # The least and the greatest value of each coordinate of a bucket's unit vectors.
        self.ends = {a: np.stack([self.unit[a:b].min(0), self.unit[a:b].max(0)])
                     for a, b in self.buckets}
        self._lists: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def sorted_list(self, low: int, high: int, f: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows of a bucket by the value of coordinate f, the values)."""
        if (low, f) not in self._lists:
            values = self.unit[low:high, f]
            order = np.argsort(values, kind="stable")
            self._lists[low, f] = order + low, values[order]
        return self._lists[low, f]

    def candidates(self, low: int, high: int, anchor: Anchor, least: int | None) -> np.ndarray | None:
        """Rows of a bucket that may score `least`; None if neither they nor shorter ones can."""
        if least is None or least <= 0:
            return np.arange(low, high)
        longest = anchor.length * self.length[low]
        bound = least / longest - SLACK if longest else 2.0
        if bound > 1:
            return None
        spread = np.arccos(max(bound, -1.0))
        lower = np.cos(np.minimum(np.pi, anchor.angles + spread)) - SLACK
        upper = np.cos(np.maximum(0, anchor.angles - spread)) + SLACK
        ends = self.ends[low]
        asked = np.flatnonzero((lower > ends[0, anchor.focus]) | (upper < ends[1, anchor.focus]))
        inside, lists = np.zeros(high - low, np.int8), 0
        for k in asked.tolist():
            rows, values = self.sorted_list(low, high, int(anchor.focus[k]))
            begin, end = values.searchsorted(lower[k]), values.searchsorted(upper[k], "right")
            if end - begin <= LEFT_OUT * (high - low):
                inside[rows[begin:end] - low] += 1
                lists += 1
        return low + np.flatnonzero(inside == lists) if lists else np.arange(low, high)

    def scores(self, at: np.ndarray, anchor: Anchor) -> np.ndarray:
        if len(anchor.x) * self.largest * anchor.largest < 2 ** 53:
            # Rows that follow one another, as those of a whole bucket, are no copy.
            whole = len(at) and at[-1] - at[0] + 1 == len(at)
            return ((self.x[at[0]:at[-1] + 1] if whole else self.x[at]) @ anchor.x).astype(np.int64)
        return np.maximum(whole_products(self.x[at], anchor.x[None])[:, 0], -MOST)


class Anchor:
    """A vector that searches, with its focus coordinates and their angles to the axes."""

    def __init__(self, x: np.ndarray):
        self.x, self.length = x, float(np.linalg.norm(x))
        unit = x / (self.length or 1.0)
        self.focus = np.argsort(-np.abs(unit), kind="stable")[:FOCUS]
        self.angles = np.arccos(np.clip(unit[self.focus], -1, 1))
        self.largest = np.abs(x).max(initial=0)


def best(probes: Probes, anchor: Anchor, eligible: np.ndarray,
         ranges: list[tuple[int | None, int]], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """
    (rows of the shard, scores) for each range (lowest, highest score): the k highest scores in it,
    ties by id. A lowest score of None is none.
    """
    scores, at = np.zeros(0, np.int64), np.zeros(0, np.int64)
    falling = scores

    def least(low, high):
        place = falling.searchsorted(-high) + k - 1
        return int(scores[place]) if place < len(scores) and (low is None or scores[place] > low) \
            else low
    for begin, end in probes.buckets:
        floors = [least(*r) for r in ranges]
        floor = None if None in floors else min(floors)
        own = probes.candidates(begin, end, anchor, floor)
        if own is None:
            break
        fit = eligible[own]
        few = 2 * np.count_nonzero(fit) < len(own)
        own = own[fit] if few else own
        found = probes.scores(own, anchor)
        keep = found >= (-MOST if floor is None else floor)
        keep = keep if few else keep & fit
        if not keep.any():
            continue
        scores, at = np.concatenate([scores, found[keep]]), np.concatenate([at, own[keep]])
        order = np.lexsort((probes.rows[at], probes.ids[at], -scores))
        scores, at = scores[order], at[order]
        falling = -scores
    out = []
    for low, high in ranges:
        first = falling.searchsorted(-high)
        last = len(scores) if low is None else falling.searchsorted(-low, "right")
        own = slice(first, min(first + k, max(first, last)))
        out.append((at[own], scores[own]))
    return out


def _longs(columns: dict[str, list]) -> pa.Table:
    return pa.table({c: pa.array(np.concatenate(v or [np.zeros(0, np.int64)]), pa.int64())
                     for c, v in columns.items()})


def _probes(shards: pa.Table, bucket: int) -> list[Probes]:
    both = ((unpacked(shards, k), row_numbers(shards, k)) for k in range(shards.num_rows))
    return [Probes(ids, labels, rows, x, bucket) for (ids, labels, x), rows in both]


def _first(slot: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray,
           k: int) -> np.ndarray:
    """Places of each slot's k highest scores, highest first; ties by id, then by row."""
    order = np.lexsort((rows, ids, -scores, slot))
    ranked = slot[order]
    return order[np.arange(len(order)) - np.searchsorted(ranked, ranked) < k]


def _search(probes: list[Probes], anchors: list[tuple], n: int, k: int) -> tuple:
    """
    (slot, score, id, row) of the k best rows of all shards for each of n slots.

    An anchor is (its vector, eligible rows of a shard as a function, [(slot, lowest, highest score)]).
    What one shard finds raises the lowest score that the next ones look for.
    """
    floors: list[int | None] = [None] * n
    kept = tuple(np.zeros(0, np.int64) for _ in range(4))
    for shard in probes:
        found: tuple[list, ...] = ([kept[0]], [kept[1]], [kept[2]], [kept[3]])
        for anchor, eligible, slots in anchors:
            ranges = [(low if floors[slot] is None else floors[slot], high)
                      for slot, low, high in slots]
            for (slot, *_), (at, scores) in zip(slots, best(shard, anchor, eligible(shard), ranges, k)):
                if len(at):
                    for out, v in zip(found, (np.full(len(at), slot), scores, shard.ids[at],
                                              shard.rows[at])):
                        out.append(v)
        kept = tuple(np.concatenate(v) for v in found)
        first = _first(*kept, k)
        kept = tuple(v[first] for v in kept)
        ends = np.cumsum(np.bincount(kept[0], minlength=n))
        for slot in np.flatnonzero(np.diff(ends, prepend=0) == k):
            floors[slot] = int(kept[1][ends[slot] - 1])
    return kept


def _find_positives(k: int, bucket: int):
    def find(tiles: pa.Table, shards: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "positive", "positive_id", "positive_score")}
        probes = _probes(shards, bucket)
        for tile in range(tiles.num_rows):
            _, labels, x = unpacked(tiles, tile)
            rows = row_numbers(tiles, tile)
            anchors = [(Anchor(x[q]), lambda shard, q=q: (shard.labels == labels[q])
                        & (shard.rows != rows[q]), [(q, None, MOST)]) for q in range(len(x))]
            slot, scores, ids, found = _search(probes, anchors, len(x), k)
            for c, v in zip(out, (rows[slot], found, ids, scores)):
                out[c].append(v)
        return _longs(out)
    return find


def _find_negatives(low: int, high: int, k: int, bucket: int):
    def find(tiles: pa.Table, shards: pa.Table) -> pa.Table:
        out = {c: [] for c in ("anchor", "anchor_id", "positive", "positive_id",
                               "positive_score", "row", "negative_id", "negative_score")}
        probes = _probes(shards, bucket)
        for tile in range(tiles.num_rows):
            ids, labels, x = unpacked(tiles, tile)
            rows = row_numbers(tiles, tile)
            place = {int(row): q for q, row in enumerate(rows)}
            wanted: dict[int, list] = {}
            pairs = []
            for p in tiles.column("positives")[tile].as_py():
                # The list is that of all anchors of the tile's number, whatever their dimension.
                score, q = p["positive_score"], place.get(p["anchor"])
                span = (-(-low * score // 100), high * score // 100)
                if q is not None and span[0] <= span[1]:
                    wanted.setdefault(q, []).append((len(pairs), *span))
                    pairs.append((p["anchor"], ids[q], p["positive"], p["positive_id"], score))
            anchors = [(Anchor(x[q]), lambda shard, q=q: shard.labels != labels[q], slots)
                       for q, slots in wanted.items()]
            slot, scores, negative, found = _search(probes, anchors, len(pairs), k)
            own = np.array(pairs, np.int64).reshape(-1, 5)[slot]
            for c, v in zip(out, (*own.T, found, negative, scores)):
                out[c].append(v)
        return _longs(out)
    return find


def hard_negatives(vectors: DataFrame, anchor: Column, low: int = 30, high: int = 90,
                   positives: int = 5, negatives: int = 10) -> DataFrame:
    """
    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of vectors
    (vec_id, label, vector of whole numbers), whose anchors are the rows that satisfy `anchor`.

    An anchor's positives are the `positives` other rows of its label with the highest scores. For
    each, rank numbers the `negatives` highest scores among rows of another label with
    low * positive_score <= 100 * score <= high * positive_score. Ties go to the smaller vec_id, then
    to the row. A positive without such rows gives none.

    Rows without id, label or vector, or with an empty vector, take no part; vectors of different
    lengths do not meet. Rows are known by a stored number: rows that repeat a vec_id are rows of their own,
    each an anchor, positive or negative by itself. Scores beyond 64 bits count as the largest.
    Other columns are not looked at; an empty table gives an empty one.
    """
    whole = F.col("vector").cast("array<double>")
    rows = numbered(
        vectors.where("vec_id is not null and label is not null and size(vector) > 0")
        .select(F.col("vec_id").cast("long").alias("id"),
                F.col("label").cast("long").alias("weight"), whole.alias("vector"),
                F.coalesce(anchor, F.lit(False)).alias("anchor")))
    counts = rows.agg(F.count(F.lit(1)), F.count_if("anchor")).first()
    shards, tiles = max(1, -(-counts[0] // SHARD_ROWS)), max(1, -(-counts[1] // ANCHOR_ROWS))
    items = tiled(rows.drop("anchor"), shards)
    anchors = tiled(rows.where("anchor").drop("anchor"), tiles)

    found = cells(anchors, tiles, items, shards).applyInArrow(
        _find_positives(positives, BUCKET_ROWS),
        "anchor long, positive long, positive_id long, positive_score long")
    order = Window.partitionBy("anchor").orderBy(F.desc("positive_score"), "positive_id", "positive")
    chosen = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives) \
        .drop("rank")
    # A tile's list holds `positives` rows for each of its anchors at most.
    listed = chosen.groupBy(tile_of(F.col("anchor"), tiles).alias("tile")) \
        .agg(F.collect_list(F.struct("anchor", "positive", "positive_id", "positive_score"))
             .alias("positives"))
    asking = materialise(anchors.join(listed, "tile"), "anchors")
    mined = cells(asking, tiles, items, shards).applyInArrow(
        _find_negatives(low, high, negatives, BUCKET_ROWS),
        "anchor long, anchor_id long, positive long, positive_id long, "
        "positive_score long, row long, negative_id long, negative_score long")
    order = Window.partitionBy("anchor", "positive") \
        .orderBy(F.desc("negative_score"), "negative_id", "row")
    return mined.withColumn("rank", F.row_number().over(order)) \
        .where(F.col("rank") <= negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                "negative_score")
