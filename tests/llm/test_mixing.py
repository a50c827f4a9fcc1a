import collections
import re

import numpy as np
import pytest

from hard import documents
from rollcall.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def size(text):
    return len(WORD.findall(text or ""))


def water(sizes, weights=(5.0, 2.0, 1.0)):
    """Targets by sharing again and again what is above three times a source's size."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(order)}
    fixed = {}
    while True:
        rest = sum(sizes.values()) - sum(fixed.values())
        free = [s for s in order if s not in fixed]
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = [s for s in free if share[s] > 3 * sizes[s]]
        if not above:
            return {**fixed, **share}
        fixed.update({s: 3.0 * sizes[s] for s in above})


def test_targets_and_taken(hard):
    rows = documents()
    sizes = collections.Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    want = water(sizes)
    mix = mixing.Mix(hard(), block_words=16, shard_words=2000)
    taken = mix.taken().collect()
    assert sorted(map(repr, ((r["doc_id"], r["size"]) for r in taken))) == \
        sorted(map(repr, ((r[0], size(r[1])) for r in rows)))
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in taken)
    by = {r["source"]: r["target"] for r in mix.placed.collect()}
    assert set(by) == set(want) and all(by[s] == pytest.approx(want[s]) for s in by)
    words = collections.Counter()
    for r in mix.segments.collect():
        words[r["source"]] += (r["high"] - r["low"]) * r["times"]
    for s, target in want.items():
        assert abs(words[s] - target) <= 17
    assert sum(r["taken"] for r in taken) == sum(words.values())


def test_reruns_agree(hard):
    def once(df):
        return sorted(map(repr, (tuple(r) for r in mixing.Mix(df).taken().collect())))
    assert once(hard()) == once(hard().repartition(7))


def test_slots_use_blocks_evenly(hard):
    slots = mixing.Mix(hard(), block_words=16, shard_words=2000).slots.collect()
    by = collections.defaultdict(list)
    for r in slots:
        by[r["number"]].append((r["slot"], r["block"]))
    for found in by.values():
        assert sorted(s for s, _ in found) == list(range(len(found)))
        times = collections.Counter(b for _, b in found)
        assert max(times.values()) <= 3
        blocks = max(times) + 1
        if len(found) >= blocks:
            assert min(times.values()) == len(found) // blocks and len(times) == blocks
    assert len({r["shard"] for r in slots}) > 3


def test_permutations():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, 77).tolist()) == list(range(n))
    assert (mixing.permuted(np.arange(1000), 1000, 1) != mixing.permuted(np.arange(1000), 1000, 2)) \
        .mean() > 0.9


def test_mixed_documents_hold_what_is_taken(hard):
    want = sum(r["taken"] for r in mixing.Mix(hard()).taken().collect())
    mixed = mixing.mixed(hard())
    assert mixed.columns == hard().columns
    rows = mixed.collect()
    assert sum(size(r["text"]) for r in rows) == want
    whole = collections.defaultdict(list)
    for d, text, *_ in documents():
        whole[d].append(text)
    counts = collections.Counter(r["doc_id"] for r in rows)
    assert all(n <= 3 * len(whole[d]) for d, n in counts.items())
    for r in rows:
        assert any(set(WORD.findall(r["text"])) <= set(WORD.findall(t or ""))
                   for t in whole[r["doc_id"]])


def test_empty_tables(hard):
    mix = mixing.Mix(hard([]))
    assert mix.taken().collect() == [] and mix.slots.collect() == []
    assert mixing.mixed(hard([])).collect() == []
    only = hard([(1, None, None, None, None), (2, "", "en", "s", 0)])
    assert sorted(r["taken"] for r in mixing.Mix(only).taken().collect()) == [0, 0]
    assert mixing.mixed(only).collect() == []
