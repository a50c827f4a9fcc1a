"""
Exact top-k search by tiled matrix products.

Queries and items are packed into tiles. Every tile of queries meets every shard of items in one
matrix product, of which each query's best k stay; tiles and shards meet in the cells of a grid, and
the lists of cells are merged in a tree, a bounded number at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from rollcall.llm.vectors import cell_shards, cells, numbered, row_numbers, tiled, unpacked

QUERY_ROWS, SHARD_ROWS = 1000, 4000
FAN_IN = 16
BEST = "array<struct<score: long, vec_id: long>>"


def whole_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole-number rows, exact; beyond 64 bits the nearest 64-bit number."""
    bound = a.shape[1] * np.abs(a).max(initial=0) * np.abs(b).max(initial=0)
    if bound < 2 ** 53:
        return (a @ b.T).astype(np.int64)
    exact = np.array([[int(x) for x in r] for r in a], object).reshape(a.shape) \
        @ np.array([[int(x) for x in r] for r in b], object).reshape(b.shape).T
    return np.clip(exact, -2 ** 63, 2 ** 63 - 1).astype(np.int64)


def _candidates(scores: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(query, item) places of each query's k best scores; of equal ones the first items."""
    there = ~own
    if scores.shape[1] > k:
        masked = np.where(there, scores, np.iinfo(np.int64).min)
        kth = np.partition(masked, -k, axis=1)[:, -k, None]
        equal = there & (scores == kth)
        there = there & (scores > kth) | equal & (np.cumsum(equal, axis=1, dtype=np.int32) <= k)
    return np.nonzero(there)


def _best(query: np.ndarray, scores: np.ndarray, items: np.ndarray, k: int) -> np.ndarray:
    """Places of each query's k best, best first, ties by item; queries ascend."""
    order = np.lexsort((items, ~scores, query))     # ~ turns the order as - does, without overflow
    ranked = query[order]
    first = np.searchsorted(ranked, ranked)
    return order[np.arange(len(order)) - first < k]


def _search(k: int, by_row: bool):
    def search(key: tuple, tiles: pa.Table, shards: pa.Table) -> pa.Table:
        found = {c: [] for c in ("query", "query_id", "n", "score", "vec_id")}
        for tile in range(tiles.num_rows if shards.num_rows else 0):
            ids, _, x = unpacked(tiles, tile)
            rows = row_numbers(tiles, tile)
            query, score, item = (np.zeros(0, np.int64) for _ in range(3))
            for shard in range(shards.num_rows):
                items, _, y = unpacked(shards, shard)
                scores = whole_products(x, y)
                own = rows[:, None] == row_numbers(shards, shard)[None, :] if by_row else \
                    ids[:, None] == items[None, :]
                # Items ascend by id, so the first of a tie have the smaller ids.
                q, place = _candidates(scores, own, k)
                query, score, item = (np.concatenate(both) for both in (
                    (query, q), (score, scores[q, place]), (item, items[place])))
                kept = _best(query, score, item, k)
                query, score, item = query[kept], score[kept], item[kept]
            for c, v in (("query", rows), ("query_id", ids), ("score", score), ("vec_id", item),
                         ("n", np.bincount(query, minlength=len(ids)))):
                found[c].append(v)
        query, query_id, n, score, item = (np.concatenate([np.zeros(0, np.int64), *v])
                                           for v in found.values())
        ends = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(
            [score, item], ["score", "vec_id"]))
        return pa.table({"query": query, "query_id": query_id, "best": lists,
                         "cell": np.full(len(query), key[1].as_py(), np.int64)})
    return search


def _merged(lists: DataFrame, keys: list, k: int) -> DataFrame:
    """The best k of the lists of a group, which are at most FAN_IN."""
    first = F.array_sort(F.flatten(F.collect_list("best")), lambda a, b: F.when(
        (a["score"] > b["score"]) | ((a["score"] == b["score"]) & (a["vec_id"] < b["vec_id"])), -1)
        .when((a["score"] == b["score"]) & (a["vec_id"] == b["vec_id"]), 0).otherwise(1))
    return lists.groupBy(*keys).agg(F.slice(first, 1, k).cast(BEST).alias("best"))


def top_k(queries: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """
    (query_id, rank, vec_id, score) of queries and items, both (id, vector of whole numbers).

    Each query row's k highest inner products, fewer if there are fewer items; ties go to the
    smaller id, equal ids count each. Where both have a column row, a number of the row in a common
    table, a query does not meet its own row; else it does not meet items of its id. Queries that
    repeat an id have lists of their own. Vectors of different lengths do not meet. A null id or
    vector takes no part. No queries or no items give no rows.
    """
    by_row = "row" in queries.columns and "row" in items.columns

    def prepared(rows):
        kept = rows.where("id is not null and vector is not null") \
            .select(F.col("id").cast("long").alias("id"), F.lit(1).cast("long").alias("weight"),
                    "vector", *["row"] * by_row)
        return kept if by_row else numbered(kept)
    queries, items = prepared(queries), prepared(items)
    shards = max(1, -(-items.count() // SHARD_ROWS))
    query_tiles = max(1, -(-queries.count() // QUERY_ROWS))
    best = cells(tiled(queries, query_tiles), query_tiles, tiled(items, shards), shards) \
        .applyInArrow(_search(k, by_row), f"query long, query_id long, best {BEST}, cell long")
    query = ["query", "query_id"]
    lists = -(-shards // cell_shards(shards))
    while lists > FAN_IN:
        best = _merged(best, [*query, F.floor(F.col("cell") / FAN_IN).alias("cell")], k)
        lists = -(-lists // FAN_IN)
    return _merged(best, query, k) \
        .select("query_id", F.posexplode("best").alias("rank", "found")) \
        .select("query_id", (F.col("rank") + 1).alias("rank"), "found.vec_id", "found.score")
