import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rollcall.llm import lemp, vectors

SCHEMA = "vec_id long, label int, vector array<double>, row string, id string, weight string"


def rows():
    r = random.Random(3)
    centres = [[r.gauss(0, 60) for _ in range(8)] for _ in range(4)]
    out = []
    for k in range(160):
        scale = r.choice([0.2, 1, 1, 3])
        out.append((5 * k, k % 4 if k % 11 else r.randrange(4), [
            float(math.floor(scale * (x + r.gauss(0, 40)))) for x in centres[k % 4]]))
    out += [(k * 100, 1, [float(r.randrange(-50, 50)) for _ in range(8)]) for k in range(3)]
    out += [out[20], out[20], (7000, 2, [0.0] * 8), (7001, 2, [0.0] * 8), (7002, 3, [0.0] * 8),
            (7100, None, [1.0] * 8), (None, 1, [1.0] * 8), (7200, 1, None), (7300, 1, []),
            (7400, 1, [1.0, 2.0]), (7401, 1, [3.0, 5.0]), (7402, 2, [1.0, 2.0]), (7403, 2, [2.0, 1.0]),
            (7500, 9, [5.0] * 8), (-100, 0, out[0][2]), (-5, 3, out[0][2]), (8000, 1, [1.0] * 8)]
    return [(*x, None, None, None) for x in out]


def brute(given, low=30, high=90, positives=5, negatives=10):
    own = [(i, v, label) for i, label, v, *_ in given
           if i is not None and label is not None and v]
    out = []
    for a, (anchor, x, label) in enumerate(own):
        if anchor % 100:
            continue
        scores = [(int(sum(p * q for p, q in zip(x, y))), i, other, n)
                  for n, (i, y, other) in enumerate(own) if n != a and len(y) == len(x)]
        best = sorted((-s, i, n) for s, i, other, n in scores if other == label)[:positives]
        for s, positive, _ in best:
            fit = sorted((-t, i, n) for t, i, other, n in scores
                         if other != label and low * -s <= 100 * t <= high * -s)[:negatives]
            out += [(anchor, positive, k + 1, i, -s, -t) for k, (t, i, _) in enumerate(fit)]
    return sorted(out)


@pytest.mark.parametrize("shard, bucket, tile", [(4000, 500, 1000), (9, 2, 3), (60, 7, 1000)])
def test_equal_to_brute_force(spark, hard, monkeypatch, shard, bucket, tile):
    hard([])
    for name, value in (("SHARD_ROWS", shard), ("BUCKET_ROWS", bucket), ("ANCHOR_ROWS", tile)):
        monkeypatch.setattr(lemp, name, value)
    frame = spark.createDataFrame(rows(), SCHEMA).repartition(3)
    got = lemp.hard_negatives(frame, F.col("vec_id") % 100 == 0)
    want = brute(rows())
    assert sorted(tuple(r) for r in got.collect()) == want
    assert len(want) > 100 and len({w[0] for w in want}) > 6


@pytest.mark.parametrize("few, shards, tiles", [(64, 8, 16), (1, 2, 2)])
def test_no_copies_of_tiles_are_broadcast(spark, hard, monkeypatch, few, shards, tiles):
    hard([])
    for module, name, value in ((lemp, "SHARD_ROWS", 20), (lemp, "ANCHOR_ROWS", 3),
                                (vectors, "FEW_CELLS", few), (vectors, "CELL_SHARDS", shards),
                                (vectors, "CELL_TILES", tiles)):
        monkeypatch.setattr(module, name, value)
    got = lemp.hard_negatives(spark.createDataFrame(rows(), SCHEMA), F.col("vec_id") % 100 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows())
    # Copies of tiles are as many as shards: as a broadcast table they would all go through the driver.
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_empty_and_one_sided_tables(spark, hard):
    hard([])
    frame = spark.createDataFrame(rows(), SCHEMA)
    assert lemp.hard_negatives(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    assert lemp.hard_negatives(frame, F.lit(False)).collect() == []
    assert lemp.hard_negatives(frame.where("label = 1"), F.lit(True)).collect() == []


def test_pruning_leaves_rows_out_and_loses_none():
    r = np.random.default_rng(2)
    x = np.floor(r.normal(size=(3000, 6)) * np.exp(r.normal(size=(3000, 1))) * 50)
    n = np.arange(3000)
    probes = lemp.Probes(n, n % 3, n, x)
    looked = []
    plain = probes.scores
    probes.scores = lambda at, anchor: (looked.append(len(at)), plain(at, anchor))[1]
    for q in range(40):
        scores = (x @ x[q]).astype(int)[probes.rows]
        eligible = probes.labels != q % 3
        high = int(np.sort(scores)[-30])
        ((at, found),) = lemp.best(probes, lemp.Anchor(x[q]), eligible, [(1, high)], 4)
        order = np.lexsort((probes.ids, -scores))
        fit = [k for k in order if eligible[k] and 1 <= scores[k] <= high][:4]
        assert at.tolist() == fit and found.tolist() == scores[fit].tolist()
    assert sum(looked) < 40 * 3000 / 4
