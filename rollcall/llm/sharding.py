"""
Splitting documents into shards of near-equal bytes by histogram sort.

Documents are ordered by a hash of their text, then a stored row number, so equal texts stand
together. Every round counts, exactly and over all partitions at once, the bytes and rows below some candidate
boundaries, and replaces them by finer ones around each wanted cut (Solomonik and Kalé, "Highly
scalable parallel sorting", 2010). A cut between two different texts is taken once it is within
the tolerance; only where one group of equal texts reaches far across a cut does the cut go inside
the group, by row number. Then all rows move once, to parts of bounded size whose
boundaries and row counts are known.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from rollcall.session import materialise

PROBES = 16                     # candidates around a cut in one round
TOLERANCE = 0.002               # of a shard's bytes
GROUP_TOLERANCE = 0.05          # the same where it keeps a group of equal texts whole
PART_BYTES = 16 * 2 ** 20       # of a part of a shard, which one task sorts
MOST_PARTS = 20_000             # whose boundaries the driver holds; beyond, parts are larger
LOW, HIGH = -2 ** 63, 2 ** 63 - 1
HISTOGRAM = ("slot", "bytes", "rows", "f_least", "s_least", "f_most", "s_most")


def weight(text: Column) -> Column:
    """UTF-8 bytes of a text, none for a null, and 8 for the row itself."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def _histogram(bounds: np.ndarray):
    """Bytes, rows and the outermost keys of each interval between sorted bounds, in one scan."""
    order = np.array([tuple(b) for b in bounds], "i8,i8")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = len(order) + 1
        sums = np.zeros((2, slots), np.int64)
        least, most = np.full((2, slots), HIGH), np.full((2, slots), LOW)
        for batch in batches:
            keys = np.empty(batch.num_rows, order.dtype)
            keys["f0"], keys["f1"] = (batch.column(c).to_numpy() for c in ("first", "second"))
            slot = _below(order, keys)
            np.add.at(sums[0], slot, batch.column("weight").to_numpy())
            sums[1] += np.bincount(slot, minlength=slots)
            for k in (0, 1):
                np.minimum.at(least[k], slot, keys[f"f{k}"])
                np.maximum.at(most[k], slot, keys[f"f{k}"])
        some = np.flatnonzero(sums[1])
        columns = [some, *sums[:, some], *least[:, some], *most[:, some]]
        yield pa.record_batch({c: pa.array(x, pa.int64()) for c, x in zip(HISTOGRAM, columns)})
    return count


def _below(order: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How many bounds are at or below each key."""
    low = np.searchsorted(order["f0"], keys["f0"], "left")
    high = np.searchsorted(order["f0"], keys["f0"], "right")
    out = low.copy()
    for k in np.flatnonzero(high > low):
        out[k] += np.searchsorted(order["f1"][low[k]:high[k]], keys["f1"][k], "right")
    return out


def _counts(keys: DataFrame, bounds: list[tuple[int, int]]) -> tuple[list, np.ndarray, list]:
    """
    The bounds, sorted; (bytes, rows) strictly below each; for the interval that ends at each, and
    the one behind the last, the outermost keys (f_least, s_least, f_most, s_most) or None.
    """
    bounds = sorted(set(bounds))
    found = keys.mapInArrow(_histogram(np.array(bounds, np.int64)),
                            ", ".join(f"{c} long" for c in HISTOGRAM)) \
        .groupBy("slot").agg(F.sum("bytes"), F.sum("rows"), F.min("f_least"), F.min("s_least"),
                             F.max("f_most"), F.max("s_most")).collect()
    sums = np.zeros((len(bounds) + 1, 2), np.int64)
    outer: list[tuple | None] = [None] * (len(bounds) + 1)
    for slot, size, rows, *keys_of_slot in found:
        sums[slot] = size, rows
        outer[slot] = tuple(keys_of_slot)
    return bounds, np.cumsum(sums, 0)[:-1], outer


def splitters(keys: DataFrame, targets: list[int], tolerance: int, spare: int) -> list[tuple]:
    """
    A boundary ((first, second), bytes below, rows below) for each target of bytes, ascending.

    keys: (first, second, weight), longs. A boundary (f, LOW) stands between different firsts;
    it is taken as soon as it is within the tolerance of its target, or if the nearest is within
    `spare`; else the rows of one first are cut by their seconds. Every round is one scan of keys for all targets together and narrows each interval
    PROBES times, and to the outermost keys in it; the driver holds PROBES numbers a target.
    """
    size, rows = keys.agg(F.sum("weight"), F.count(F.lit(1))).first()
    low = {t: ((LOW, LOW), (0, 0)) for t in targets}
    high = {t: ((HIGH, HIGH), (size or 0, rows)) for t in targets}
    done: dict[int, tuple] = {}
    while True:
        wanted = []
        for t in set(targets) - set(done):
            near = min((low[t], high[t]), key=lambda x: abs(x[1][0] - t))
            probes = _probes(low[t][0], high[t][0])
            if abs(near[1][0] - t) <= tolerance and near[0][1] in (LOW, HIGH) \
                    or high[t][1][1] - low[t][1][1] <= 1 or not probes:
                done[t] = near
            wanted += probes if t not in done else []
        if not wanted:
            return [(done[t][0], *done[t][1]) for t in targets]
        bounds, below, outer = _counts(keys, wanted)
        for t in set(targets) - set(done):
            k = int(np.searchsorted(below[:, 0], t, "right"))
            if k and bounds[k - 1] > low[t][0]:
                low[t] = bounds[k - 1], tuple(below[k - 1].tolist())
            if k < len(bounds) and bounds[k] < high[t][0]:
                high[t] = bounds[k], tuple(below[k].tolist())
            if outer[k]:
                # No key lies outside the outermost ones of the interval.
                f0, s0, f1, s1 = outer[k]
                one = f0 == f1
                edges = ((f0, LOW), low[t][1]), ((min(f0, HIGH - 1) + 1, LOW), high[t][1])
                near = min(edges, key=lambda x: abs(x[1][0] - t))
                if one and abs(near[1][0] - t) <= spare and low[t][0][1] == LOW:
                    done[t] = near
                    continue
                low[t] = max(low[t][0], (f0, s0 if one else LOW)), low[t][1]
                high[t] = min(high[t][0], (f1, s1 + 1) if one and s1 < HIGH else
                              (min(f1, HIGH - 1) + 1, LOW)), high[t][1]


def _probes(low: tuple[int, int], high: tuple[int, int]) -> list[tuple[int, int]]:
    """Up to PROBES boundaries strictly between two: between firsts if there are any."""
    (f0, s0), (f1, s1) = low, high
    if f1 - f0 > 1:
        steps = {f0 + (f1 - f0) * k // (PROBES + 1) for k in range(1, PROBES + 1)}
        return [(f, LOW) for f in sorted(steps | {f0 + 1}) if f0 < f < f1]
    top = s1 if f1 == f0 else HIGH
    steps = {s0 + (top - s0) * k // (PROBES + 1) for k in range(1, PROBES + 1)}
    inside = [(f0, s) for s in sorted(steps) if s0 < s < top]
    return inside + ([(f1, LOW)] if low < (f1, LOW) < high else [])


def _placed(bounds: list[tuple[int, int]], base: list[int]) -> Column:
    """The part of a row, and the slot of the part's first row in its shard."""
    order, first = np.array(bounds, "i8,i8"), np.array(base, np.int64)

    @F.arrow_udf("part long, base long")
    def placed(f: pa.Array, s: pa.Array) -> pa.Array:
        keys = np.empty(len(f), order.dtype)
        keys["f0"], keys["f1"] = f.to_numpy(zero_copy_only=False), s.to_numpy(zero_copy_only=False)
        part = _below(order, keys)
        return pa.StructArray.from_arrays([pa.array(part, pa.int64()), pa.array(first[part])],
                                          ["part", "base"])
    return placed(F.col("_first"), F.col("_second"))


def shard(docs: DataFrame, shards: int, tolerance: float = TOLERANCE,
          group_tolerance: float = GROUP_TOLERANCE, part_bytes: int = PART_BYTES) -> DataFrame:
    """
    Add shard (0 to shards - 1) and slot (its place there, gapless from 0) to docs (doc_id,
    text, ...), replacing columns so named; size is what a row weighs, its bytes and 8.

    A boundary between shards is off by `tolerance` of a shard at most, or by the group of equal
    texts or the row that it falls into. Such a group stays whole if that leaves the boundary
    within `group_tolerance`; only a larger one is cut, between any two of its rows, those that are
    equal in doc_id or have none too. Null texts are one group, empty ones another. doc_id is not
    looked at. An empty table gives an empty one.
    """
    # Stored with their numbers, so that equal rows are told apart alike by every scan.
    keyed = materialise(
        docs.drop("shard", "slot", "size")
        .withColumn("_first", F.xxhash64(F.col("text").isNull(), "text"))
        .withColumn("_second", F.monotonically_increasing_id())
        .withColumn("size", weight(F.col("text"))), "numbered")
    keys = keyed.select(F.col("_first").alias("first"), F.col("_second").alias("second"),
                        F.col("size").alias("weight"))
    total = keys.agg(F.sum("weight")).first()[0] or 0
    finer = int(max(1, min(-(-total // (shards * part_bytes)), MOST_PARTS // shards)))
    cuts = shards * finer
    targets = sorted({total * k // cuts for k in range(1, cuts)})
    found = splitters(keys, targets, int(tolerance * total / shards),
                      int(group_tolerance * total / shards)) if total else []
    at = dict(zip(targets, found))
    cut_list = [((LOW, LOW), 0, 0)] + [at[total * k // cuts] for k in range(1, cuts)] \
        if total else [((LOW, LOW), 0, 0)] * cuts
    # Cuts that fall together leave empty parts; a row belongs to the last part that starts at
    # or below it.
    bounds = [c[0] for c in cut_list[1:]]
    starts = [c[2] for c in cut_list]
    base = [starts[k] - starts[k // finer * finer] for k in range(cuts)]
    order = Window.partitionBy("_at.part").orderBy("_first", "_second")
    return keyed.withColumn("_at", _placed(bounds, base)) \
        .withColumn("slot", F.row_number().over(order) - 1 + F.col("_at.base")) \
        .withColumn("shard", F.floor(F.col("_at.part") / finer).cast("int")) \
        .drop("_first", "_second", "_at")
