"""
Near-duplicate vectors by products of int8 tiles with proven error bounds.

Equal vectors are one class. Each class's unit vector x is stored as s * q + e with q of whole
numbers from -127 to 127, and |s q| and |e| are known. For two of them
|x . y - s_x s_y q_x . q_y| <= |s_x q_x| |e_y| + |e_x| |s_y q_y| + |e_x| |e_y|, so a pair whose
product of whole numbers is too small cannot reach the threshold. The others are computed anew in
double precision, and only that decides. Whole-number products are exact: they are taken in floats
over so few columns at a time that no sum leaves their range.

All classes are compared with all, in tiles: a unit of work is two tiles. It returns each class's
number of links and a spanning forest of them, so rows out grow with vectors and tiles, not with
pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.graph import components, tile_roots
from rollcall.llm.vectors import tiled, unpacked, usable
from rollcall.session import materialise

THRESHOLD = 0.95
TILE_ROWS = 3000
SLACK = 1e-9                    # above all rounding of the double arithmetic in the bounds
EXACT_COLUMNS = 1000            # 1000 * 127 * 127 < 2 ** 24
BLOCK = 512


def quantise(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(q int8, scale, length of the quantised vector, length of its error) of each row."""
    scale = np.abs(unit).max(1) / 127
    q = np.rint(unit / scale[:, None]).astype(np.int8)
    back = q * scale[:, None]
    return q, scale, np.linalg.norm(back, axis=1), np.linalg.norm(unit - back, axis=1)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    total = 0
    for k in range(0, a.shape[1], EXACT_COLUMNS):
        part = a[:, k:k + EXACT_COLUMNS].astype(np.float32) \
            @ b[:, k:k + EXACT_COLUMNS].astype(np.float32).T
        total = part if a.shape[1] <= EXACT_COLUMNS else total + part.astype(np.float64)
    return total


def similar_pairs(x: np.ndarray, y: np.ndarray, same: bool,
                  threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (i, j) of rows with cosine >= threshold; with `same`, x is y and i < j."""
    x = x / np.abs(x).max(1, keepdims=True)
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    y = y / np.abs(y).max(1, keepdims=True)
    y = y / np.linalg.norm(y, axis=1, keepdims=True)
    qx, sx, ax, ex = quantise(x)
    qy, sy, ay, ey = quantise(y)
    found_i, found_j = [], []
    for low in range(0, len(x), BLOCK):
        rows = slice(low, low + BLOCK)
        first = low if same else 0
        # The least product of whole numbers with which a row can still reach the threshold.
        error = ax[rows] * ey.max() + ex[rows] * (ay.max() + ey.max())
        least = (threshold - error - SLACK) / sx[rows]
        least = np.where(least > 0, least / sy.max(), least / sy.min())
        p = _products(qx[rows], qy[first:])
        i, j = np.nonzero(p >= (least * (1 - 1e-6)).astype(np.float32)[:, None] - 1)
        product = p[i, j].astype(np.float64)
        i, j = i + low, j + first
        if same:
            product, i, j = product[i < j], i[i < j], j[i < j]
        above = product * sx[i] * sy[j] + ax[i] * ey[j] + ex[i] * (ay[j] + ey[j]) \
            >= threshold - SLACK
        i, j = i[above], j[above]
        for k in range(0, len(i), 65536):
            a, b = i[k:k + 65536], j[k:k + 65536]
            close = np.einsum("nd,nd->n", x[a], y[b]) >= threshold
            found_i.append(a[close])
            found_j.append(b[close])
    none = np.zeros(0, np.int64)
    return np.concatenate(found_i or [none]), np.concatenate(found_j or [none])


def _unit(ids, weights, left, right) -> dict[str, np.ndarray]:
    """Links of every class and a forest, as rows (kind, a, b)."""
    roots = tile_roots(len(ids), left, right)
    links = np.bincount(left, weights[right], len(ids)) + \
        np.bincount(right, weights[left], len(ids))
    some, below = np.flatnonzero(links), np.flatnonzero(roots != np.arange(len(ids)))
    return {"kind": np.repeat([0, 1], [len(some), len(below)]),
            "a": np.concatenate([ids[some], ids[below]]),
            "b": np.concatenate([links[some].astype(np.int64), ids[roots[below]]])}


def _compare(threshold: float):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, weights, x = unpacked(batch, row)
                same = batch.column("tile")[row].as_py() == batch.column("other")[row].as_py()
                if same:
                    left, right = similar_pairs(x, x, True, threshold)
                else:
                    ids2, weights2, y = unpacked(batch, row, "other_")
                    left, right = similar_pairs(x, y, False, threshold)
                    right = right + len(ids)
                    ids, weights = np.concatenate([ids, ids2]), np.concatenate([weights, weights2])
                found = _unit(ids, weights, left, right)
                yield pa.record_batch({k: pa.array(v, pa.int64()) for k, v in found.items()})
    return compare


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """
    (vec_id, n_links, component_id, kept) for every row of vectors (vec_id, embedding, ...).

    Two rows are linked if the cosine of their vectors in double precision is at least
    `threshold`, which must be above 0. n_links counts the other rows linked directly, equal
    vectors too; component_id is the smallest vec_id that links reach. Vectors that are null,
    empty, zero or hold a null or non-finite component link with nothing, nor do vectors of
    different lengths. Rows that repeat a vec_id count each, and each has its own links. A row without vec_id links with
    nothing, has a null component_id and is kept. Other columns are not looked at; an empty table
    gives an empty one.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vector"))
    takes_part = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0) \
        & F.col("vec_id").isNotNull()
    rows = rows.withColumn("vector", F.when(takes_part, F.col("vector")))
    # Classes get numbers of their own, as rows may repeat a vec_id with another vector.
    classes = materialise(rows.where("vector is not null").groupBy("vector").agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("weight"))
        .withColumn("id", F.monotonically_increasing_id()), "classes")
    tiles = max(1, -(-classes.count() // TILE_ROWS))
    packed = materialise(tiled(classes.select("id", "vector", "weight"), tiles), "tiles")
    other = packed.select(F.col("tile").alias("other"), "dim",
                          *[F.col(c).alias(f"other_{c}") for c in ("ids", "weights", "matrix")])
    # Every two tiles meet once, in whichever order makes a tile's units about half of all.
    ahead = F.sequence(F.lit(0), F.lit(tiles // 2))
    meets = F.filter(F.transform(ahead, lambda d: F.struct(
        F.pmod(F.col("tile") + d, F.lit(tiles)).alias("other"), d.alias("d"))),
        lambda m: (m["d"] * 2 != tiles) | (F.col("tile") * 2 < tiles) | (m["d"] == 0))
    units = packed.select("*", F.inline(meets)).drop("d").join(other, ["other", "dim"])
    found = materialise(units.mapInArrow(_compare(threshold), "kind long, a long, b long"),
                        "vector_links")
    roots = components(found.where("kind = 1").select("a", "b"))
    members = roots.join(classes.select(F.col("id").alias("vertex"), "least"), "vertex")
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    placed = members.join(least, "root").select(F.col("vertex").alias("id"), "component_id")
    links = found.where("kind = 0").groupBy("a").agg(F.sum("b").alias("links"))
    known = classes.join(links.withColumnRenamed("a", "id"), "id", "left") \
        .join(placed, "id", "left") \
        .select("vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component_id", "least").alias("component_id"))
    return rows.join(known, "vector", "left") \
        .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"),
                F.coalesce("component_id", "vec_id").alias("component_id")) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
