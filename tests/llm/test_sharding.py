import collections

import pytest

from hard import documents, words
from rollcall.llm import sharding


def weight(text):
    return len((text or "").encode()) + 8


def check(df, rows, shards):
    got = df.collect()
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in got))) == \
        sorted(map(repr, ((r[0], r[1]) for r in rows)))
    slots, sizes, homes = collections.defaultdict(list), [0] * shards, collections.defaultdict(set)
    for r in got:
        assert r["size"] == weight(r["text"]) and 0 <= r["shard"] < shards
        slots[r["shard"]].append(r["slot"])
        sizes[r["shard"]] += r["size"]
        homes[r["text"]].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return sizes, homes


def test_hard_rows(hard):
    df = sharding.shard(hard(), 4)
    assert set(df.columns) == set(hard().columns) | {"shard", "slot"}
    sizes, homes = check(df, documents(), 4)
    mean = sum(sizes) / 4
    longest = max(weight(r[1]) for r in documents())
    assert max(sizes) <= mean + longest
    assert all(len(s) == 1 for t, s in homes.items() if weight(t) < 0.02 * mean)


def test_sizes_are_near_equal_and_groups_whole(hard):
    rows = [(k, words(k // 2, 20 + k % 60), "en", "s", 0) for k in range(3000)]
    sizes, homes = check(sharding.shard(hard(rows), 8, part_bytes=20000), rows, 8)
    mean = sum(sizes) / 8
    assert all(abs(s - mean) <= 0.02 * mean for s in sizes)
    assert all(len(s) == 1 for s in homes.values())


def test_rows_equal_in_text_and_id_are_cut_too(hard):
    rows = [(7, words(0, 30), "en", "s", 0)] * 300 + [(None, words(1, 30), "en", "s", 0)] * 200 + \
        [(k, words(k, 30), "en", "s", 0) for k in range(500)]
    sizes, _ = check(sharding.shard(hard(rows), 24), rows, 24)
    mean = sum(sizes) / 24
    assert all(abs(s - mean) <= 0.1 * mean for s in sizes)


def test_a_hot_text_is_cut(hard):
    rows = [(k, words(0, 40) if k % 3 else words(k, 40), "en", "s", 0) for k in range(1200)]
    sizes, homes = check(sharding.shard(hard(rows), 6), rows, 6)
    mean = sum(sizes) / 6
    assert all(abs(s - mean) <= 0.03 * mean for s in sizes)
    assert sum(len(s) > 1 for s in homes.values()) == 1


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)],
                                  [(1, "same", "a", "b", 1)] * 5])
def test_few_rows(hard, rows):
    check(sharding.shard(hard(rows), 24), rows, 24)


def test_splitters_are_exact(spark, hard):
    hard([])
    keys = [(f, s, 1 + (f * 7 + s) % 5) for f in (-9, 0, 3, 2 ** 63 - 1, -2 ** 63) for s in range(40)]
    frame = spark.createDataFrame(keys, "first long, second long, weight long")
    total = sum(k[2] for k in keys)
    targets = [total * k // 9 for k in range(1, 9)]
    found = sharding.splitters(frame, targets, 0, 0)
    for t, (bound, below, rows) in zip(targets, found):
        assert below == sum(k[2] for k in keys if k[:2] < bound)
        assert rows == sum(k[:2] < bound for k in keys)
        assert abs(below - t) <= 5
