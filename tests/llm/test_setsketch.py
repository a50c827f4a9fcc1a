import collections
import re

import numpy as np
import pytest

from hard import documents
from rollcall.llm import setsketch
from rollcall.llm.graph import components, tile_roots

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + 5]) for i in range(len(words) - 4))


def brute(rows):
    """(doc_id, size, component) of each row; rows without id are linked with nothing."""
    sets = [shingles(text) for _, text in rows]
    low = {d: d for d, _ in rows if d is not None}

    def find(d):
        while low[d] != d:
            d = low[d]
        return d
    heads = {}
    for s, (d, _) in sorted(zip(sets, rows), key=lambda x: (x[1][0] is None, x[1][0])):
        if s and d is not None:
            heads.setdefault(s, d)
    items = list(heads.items())
    for k, (s, a) in enumerate(items):
        for t, b in items[:k]:
            if 100 * len(s & t) >= 75 * len(s | t):
                a2, b2 = sorted((find(a), find(b)))
                low[b2] = a2
    out = []
    for s, (d, _) in zip(sets, rows):
        out.append((d, len(s), None if d is None else find(heads[s]) if s else d))
    return out


def key(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_components_equal_brute_force(hard):
    rows = [(r[0], r[1]) for r in documents()]
    got = setsketch.near_duplicates(hard()).collect()
    assert key([tuple(r)[:3] for r in got]) == key(brute(rows))
    assert all(r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"]) for r in got)


def test_large_group_over_several_tiles(spark, hard, monkeypatch):
    monkeypatch.setattr(setsketch, "BUCKET_MEMBERS", 5)
    monkeypatch.setattr(setsketch, "BLOCK_MEMBERS", 4)
    r = np.random.default_rng(3)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(60):
        own = list(base)
        for i in r.choice(80, 1 + k % 4, replace=False):
            own[i] = f"x{k}_{i}"
        rows.append((k, " ".join(own), "en", "s", 0))
    got = setsketch.near_duplicates(hard(rows)).collect()
    assert key([tuple(x)[:3] for x in got]) == key(brute([x[:2] for x in rows]))


def test_empty_table_and_kept_rows(hard):
    assert setsketch.near_duplicates(hard([])).collect() == []
    assert setsketch.deduplicated(hard([])).collect() == []
    kept = setsketch.deduplicated(hard())
    assert set(kept.columns) == set(hard().columns)
    ids = [r["doc_id"] for r in kept.collect()]
    # Of rows that share an id each different set of shingles is judged, and kept once.
    rows = [(r[0], r[1]) for r in documents()]
    want = {(d, shingles(t)) for (d, t), (_, _, c) in zip(rows, brute(rows))
            if d is not None and d == c}
    assert collections.Counter(d for d in ids if d is not None) == \
        collections.Counter(d for d, _ in want)
    assert ids.count(None) == 3


def test_rows_that_repeat_very_often(hard):
    """Copies with one id are one set: tiles and texts hold it once."""
    base = [f"w{k}" for k in range(60)]
    near, far = " ".join(["x", *base]), " ".join(f"v{k}" for k in range(60))
    rows = [(1, " ".join(base), "en", "s", 0)] * 400 + [(2, near, "en", "s", 0)] * 300 + \
        [(3, far, "en", "s", 0)] * 2
    got = setsketch.near_duplicates(hard(rows)).collect()
    assert collections.Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got) == {
        (1, 1, True): 400, (2, 1, False): 300, (3, 3, True): 2}
    assert sorted(r["doc_id"] for r in setsketch.deduplicated(hard(rows)).collect()) == [1, 3]


def test_registers_merge_and_estimate():
    r = np.random.default_rng(1)
    pool = r.integers(0, 2 ** 64, 4000, dtype=np.uint64)
    a, b = pool[:3000], pool[1000:]
    both = setsketch.registers(np.concatenate([a, b, pool]), np.array([3000, 3000, 4000]))
    assert (setsketch.merged(both[0], both[1]) == both[2]).all()
    assert setsketch.likeliest(both[0], both[1], 3000, 3000) == pytest.approx(0.5, abs=0.2)
    assert setsketch.likeliest(both[0], both[0], 3000, 3000) > 0.97


def test_components_of_chains_stars_and_loops(spark, hard):
    hard([])
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, i) for i in range(101, 180)] + \
        [(7, 7), (None, 3), (300, 200), (200, 300)]
    got = {r["vertex"]: r["root"]
           for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 180)},
                   200: 200, 300: 200}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_tile_roots():
    assert tile_roots(6, np.array([4, 3, 1]), np.array([3, 1, 5])).tolist() == [0, 1, 2, 1, 1, 1]


def test_rows_of_one_id_are_kept_by_their_text(hard):
    a, b, c = ("".join(f"{name}{k} " for k in range(40)) for name in "abc")
    rows = [(3, a, "en", "s", 0), (7, a, "en", "s", 0), (7, b, "en", "s", 0), (7, b + " ", "en", "s", 0),
            (8, c, "en", "s", 0), (8, b, "en", "s", 0), (8, c, "en", "s", 0)]
    got = sorted((r["doc_id"], r["text"].strip()) for r in setsketch.deduplicated(hard(rows)).collect())
    assert got == [(3, a.strip()), (7, b.strip()), (8, c.strip())]
