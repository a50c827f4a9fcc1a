import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import quantised, topk, vectors as vectors_module
from rollcall.llm.vectors import numbered, usable

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string, vector string, id string"


def vectors(n=90, dim=12):
    r = random.Random(5)
    centres = [[r.gauss(0, 1) for _ in range(dim)] for _ in range(6)]
    rows = []
    for k in range(n):
        c = centres[k % 6]
        rows.append((k * 5, [float(np.float32(x + r.gauss(0, 0.12))) for x in c]))
    rows += [(1001, rows[3][1]), (1002, rows[3][1]), (1003, [2 * x for x in rows[3][1]]),
             (1004, [-x for x in rows[3][1]]), (1005, [0.0] * dim), (1006, None), (1007, []),
             (1008, [float("nan")] + [1.0] * (dim - 1)), (1009, [math.inf] + [1.0] * (dim - 1)),
             (1010, [None] + [1.0] * (dim - 1)), (1011, [1.0, 2.0]), (1012, [2.0, 4.0]),
             (1013, [1e-30] * dim), (1014, [1e30] * dim), (None, rows[3][1]), (10, rows[2][1]),
             (15, rows[4][1]), (1016, [-0.0] * dim)]
    return [(i, v, 1, None, None, None) for i, v in rows]


def valid(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def brute_links(rows, threshold=0.95):
    unit = []
    for i, v, *_ in rows:
        ok = i is not None and valid(v) and any(v)
        x = np.array(v, float) / np.abs(np.array(v, float)).max() if ok else None
        unit.append(x / np.linalg.norm(x) if ok else None)
    links = [[j for j, y in enumerate(unit) if j != k and x is not None and y is not None
              and len(x) == len(y) and x @ y >= threshold] for k, x in enumerate(unit)]
    low = list(range(len(rows)))

    def find(a):
        while low[a] != a:
            a = low[a]
        return a
    for k, others in enumerate(links):
        for j in others:
            a, b = sorted((find(k), find(j)), key=lambda n: (rows[n][0] is None, rows[n][0]))
            low[b] = a
    return [(r[0], len(links[k]), None if r[0] is None else rows[find(k)][0])
            for k, r in enumerate(rows)]


@pytest.mark.parametrize("tile_rows", [3000, 7])
def test_links_and_components(spark, hard, monkeypatch, tile_rows):
    hard([])
    monkeypatch.setattr(quantised, "TILE_ROWS", tile_rows)
    rows = vectors() + [(10, vectors()[2][1], 1, None, None, None),
                        (20, vectors()[5][1], 1, None, None, None)]
    got = quantised.near_duplicates(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(repr, (tuple(r)[:3] for r in got))) == sorted(map(repr, brute_links(rows)))
    assert all(r["kept"] == (r["vec_id"] is None or r["vec_id"] == r["component_id"]) for r in got)


def test_no_vectors(spark, hard):
    hard([])
    assert quantised.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    got = quantised.near_duplicates(spark.createDataFrame([(3, None, 1, None, None, None)], SCHEMA))
    assert [tuple(r) for r in got.collect()] == [(3, 0, 3, True)]


def test_quantisation_bounds_hold():
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 20)) * 10.0 ** r.integers(-3, 3, (300, 20))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, a, e = quantised.quantise(x)
    p = quantised._products(q, q) * s[:, None] * s[None, :]
    bound = a[:, None] * e[None, :] + e[:, None] * a[None, :] + e[:, None] * e[None, :]
    assert (np.abs(x @ x.T - p) <= bound + 1e-12).all()


@pytest.mark.parametrize("dim, spread", [(64, 0.02), (64, 0.05), (1500, 0.03), (2, 0.3)])
def test_pairs_equal_all_cosines(dim, spread):
    r = np.random.default_rng(1)
    x = r.normal(size=(8, dim))[r.integers(0, 8, 700)] + r.normal(size=(700, dim)) * spread * 8
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = {(i, j) for i, j in zip(*np.nonzero(np.triu(u @ u.T >= 0.95, 1)))}
    sure = {(i, j) for i, j in zip(*np.nonzero(np.triu(np.abs(u @ u.T - 0.95) > 1e-9, 1)))}
    i, j = quantised.similar_pairs(x, x, True)
    assert (set(zip(i, j)) ^ want) & sure == set()
    i, j = quantised.similar_pairs(x[:300], x[300:], False)
    assert (set(zip(i, j + 300)) ^ {(a, b) for a, b in want if a < 300 <= b}) & sure == set()


def brute_top(rows, k):
    whole = [(i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows
             if i is not None and valid(v)]
    out = []
    for row, (q, a) in enumerate(whole):
        if q % 50:
            continue
        scores = sorted(((-sum(x * y for x, y in zip(a, b)), i) for n, (i, b) in enumerate(whole)
                         if n != row and len(b) == len(a)))
        out += [(q, rank + 1, i, max(min(-s, 2 ** 63 - 1), -2 ** 63))
                for rank, (s, i) in enumerate(scores[:k])]
    return out


@pytest.mark.parametrize("shard_rows", [4000, 3])
def test_top_k(spark, hard, monkeypatch, shard_rows):
    hard([])
    monkeypatch.setattr(topk, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(topk, "QUERY_ROWS", 4)
    monkeypatch.setattr(topk, "FAN_IN", 3)
    rows = [r for r in vectors() if r[0] != 1014] + [(50, [1.0] * 12, 1, None, None, None),
                                                     (100, vectors()[20][1], 1, None, None, None)] + \
        [(2000, [1.0] * 12, 1, None, None, None), (2001, [1.0] * 12, 1, None, None, None),
         (2002, [1.0] * 12, 1, None, None, None), (3050, [1.0, 1.0], 1, None, None, None)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("double"))
    items = numbered(frame.where(usable(F.col("embedding"))).select(
        F.col("vec_id").alias("id"), whole.alias("vector")))
    got = topk.top_k(items.where("id % 50 = 0"), items, 5).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_top(rows, 5))
    # Without row numbers items of the query's id are left out.
    apart = topk.top_k(items.where("id % 50 = 0").drop("row"), items, 1).collect()
    assert len(apart) == items.where("id % 50 = 0 and size(vector) in (2, 12)").count()
    assert all(r["query_id"] != r["vec_id"] for r in apart)
    assert topk.top_k(items.limit(0), items, 5).collect() == []
    assert topk.top_k(items, items.limit(0), 5).collect() == []


@pytest.mark.parametrize("few, shards, tiles", [(64, 8, 16), (1, 2, 2)])
def test_top_k_broadcasts_no_copies_of_tiles(spark, hard, monkeypatch, few, shards, tiles):
    hard([])
    for module, name, value in ((topk, "SHARD_ROWS", 20), (topk, "QUERY_ROWS", 5),
                                (vectors_module, "FEW_CELLS", few),
                                (vectors_module, "CELL_SHARDS", shards),
                                (vectors_module, "CELL_TILES", tiles)):
        monkeypatch.setattr(module, name, value)
    r = random.Random(4)
    rows = [(k, [float(r.randrange(-9, 9)) for _ in range(3)]) for k in range(400)]
    items = spark.createDataFrame(rows, "id long, vector array<double>")
    got = topk.top_k(items.where("id % 20 = 0"), items, 3)
    want = []
    for q, a in rows[::20]:
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in rows if i != q)[:3]
        want += [(q, n + 1, i, int(-s)) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(x) for x in got.collect()) == want
    # Copies of tiles are as many as shards: as a broadcast table they would all go through the driver.
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_candidates_of_ties_and_least_scores():
    least = np.iinfo(np.int64).min
    scores = np.array([[5, 5, 5, 5], [least, least, 1, least], [0, 7, 7, 9]])
    own = np.array([[True, False, False, False], [False] * 4, [False, False, False, True]])
    query, item = topk._candidates(scores, own, 2)
    kept = topk._best(query, scores[query, item], item, 2)
    assert list(zip(query[kept].tolist(), item[kept].tolist())) == \
        [(0, 1), (0, 2), (1, 2), (1, 0), (2, 1), (2, 2)]


def test_products_beyond_doubles_are_exact():
    a = np.array([[2.0 ** 40 + 1, 3.0]])
    b = np.array([[2.0 ** 20 + 1, 5.0], [2.0 ** 60, 1.0]])
    assert topk.whole_products(a, b).tolist() == [[(2 ** 40 + 1) * (2 ** 20 + 1) + 15, 2 ** 63 - 1]]
