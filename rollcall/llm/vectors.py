"""Packing vectors into tiles: one row holds the ids and the matrix of some thousand vectors."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from rollcall.session import materialise

TILE = "tile long, dim int, n int, ids binary, weights binary, matrix binary"
ROWS = ", rows binary"
# A cell holds so many tiles and shards at most, but few shards as long as there are few cells.
CELL_TILES, CELL_SHARDS, FEW_CELLS = 16, 8, 64


def usable(vector: Column) -> Column:
    """Not null or empty and of finite components only."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x)
                     & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(whole & (F.size(vector) > 0), F.lit(False))


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        members, tiles, dims = (batch.column(c) for c in ("members", "tile", "dim"))
        flat, at = members.flatten(), 0
        fields = {flat.type[k].name: flat.field(k) for k in range(flat.type.num_fields)}
        vectors = fields["vector"]
        numbered = ["rows"] if "row" in fields else []
        values = vectors.flatten().to_numpy(zero_copy_only=False)
        for k, n in enumerate(members.value_lengths().to_pylist()):
            dim = dims[k].as_py()
            ids = fields["id"].slice(at, n).to_numpy()
            order = np.argsort(ids, kind="stable")
            begin = int(vectors.value_lengths().slice(0, at).to_numpy().sum())
            matrix = values[begin:begin + n * dim].reshape(n, dim).astype(np.float64)[order]
            rows.append((tiles[k].as_py(), dim, n, ids[order].tobytes(),
                         fields["weight"].slice(at, n).to_numpy()[order].tobytes(),
                         matrix.tobytes(), *[fields["row"].slice(at, n).to_numpy()[order]
                                             .tobytes() for _ in numbered]))
            at += n
        kinds = (pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * (3 + len(numbered)))
        names = ("tile", "dim", "n", "ids", "weights", "matrix", *numbered)
        yield pa.record_batch({name: pa.array([r[k] for r in rows], kind)
                               for k, (name, kind) in enumerate(zip(names, kinds))})


def numbered(rows: DataFrame) -> DataFrame:
    """The rows, stored, with a number of their own in the column row."""
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "numbered")


def tile_of(key: Column, tiles: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(3)), F.lit(tiles))


def tiled(vectors: DataFrame, tiles: int) -> DataFrame:
    """
    (tile, dim, n, ids, weights, matrix) of vectors (id, weight, vector): dealt by a hash of the id
    into `tiles` tiles, one row each and one more for every other dimension. Ids ascend in a
    tile; the matrix holds doubles, row by row. Vectors that have a column row too, a number of
    their own, are dealt by it, and tiles have rows besides.
    """
    row = [c for c in vectors.columns if c == "row"]
    members = F.collect_list(F.struct("id", "weight", F.col("vector").cast("array<double>")
                                      .alias("vector"), *row)).alias("members")
    return vectors.withColumn("tile", tile_of(F.col("row" if row else "id"), tiles)) \
        .withColumn("dim", F.size("vector")).groupBy("tile", "dim").agg(members) \
        .mapInArrow(_pack, TILE + ROWS * len(row))


def cell_shards(n_shards: int) -> int:
    """How many shards a cell holds at most."""
    return min(CELL_SHARDS, -(-n_shards // FEW_CELLS))


def cells(tiles: DataFrame, n_tiles: int, shards: DataFrame, n_shards: int) -> PandasCogroupedOps:
    """
    The cells of a grid in which every tile meets every shard of its dimension, for applyInArrow.

    Tiles and shards are numbered by their column tile. A cell (i, j, dim) has a bounded number of
    both, so a shard moves once for all tiles of a cell, and a tile once for all its shards. Both sides
    are shuffled: copies of tiles are many, and must not be taken for a table small enough to broadcast.
    """
    wide = cell_shards(n_shards)

    def copies(rows, own, width, other, n):
        return rows.withColumn(own, F.floor(F.col("tile") / width).cast("long")).withColumn(
            other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    left = copies(tiles, "i", CELL_TILES, "j", -(-n_shards // wide))
    right = copies(shards, "j", wide, "i", -(-n_tiles // CELL_TILES))
    return left.groupBy("i", "j", "dim").cogroup(right.groupBy("i", "j", "dim"))


def unpacked(batch: pa.RecordBatch | pa.Table, row: int, prefix: str = "") -> tuple:
    """(ids, weights, matrix) of one packed tile."""
    def part(name, kind):
        return np.frombuffer(batch.column(prefix + name)[row].as_buffer(), kind)
    return part("ids", np.int64), part("weights", np.int64), \
        part("matrix", np.float64).reshape(-1, batch.column("dim")[row].as_py())


def row_numbers(batch: pa.RecordBatch | pa.Table, row: int) -> np.ndarray:
    """The rows' own numbers of one packed tile."""
    return np.frombuffer(batch.column("rows")[row].as_buffer(), np.int64)
