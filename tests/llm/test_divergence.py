import collections
import re

import pytest

from hard import documents
from rollcall.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def rows():
    long = "y" * 5000
    return documents() + [
        (300, "Prefix prefixes prefixing, PREFIX2", "en", "s0", 0), (301, "prefix prefixes", "en", "s1", 0),
        (302, "prefixes prefixed é漢", "en", "s2", 0), (303, "", "empty", "a", 0),
        (304, None, "empty", "b", 0), (305, "one two", "lonely", "a", 0),
        *[(310 + k, f"{long} {long}z{k} ééé {'é' * 50} shared", "de", f"s{k % 2}", 0) for k in range(4)],
        *[(320 + k, "twice twice\0twice", None, None, 0) for k in range(3)],
        (330, "rare rare", "de", "s0", 0), (330, "rare rare", "de", "s0", 0)]


def brute(given, least=3, ranks=200):
    counts, seen, groups = collections.Counter(), collections.defaultdict(set), set()
    for n, (_, text, lang, source, *_) in enumerate(given):
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        for t in TERM.findall((text or "").translate(LOWER)):
            counts[lang, source, t] += 1
            seen[lang, t].add(n)
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for x, t in seen if x == lang and len(seen[x, t]) >= least]
        sources = sorted(s for x, s in groups if x == lang)

        def shares(of):
            n = [sum(counts[lang, s, t] for s in of) for t in kept]
            total = sum(n) + len(kept)
            return n, [1 + 10 ** 9 * (c + 1) // total for c in n]
        _, q = shares(sources)
        own = {s: shares([s]) for s in sources}
        for s in sources:
            n, p = own[s]
            pairs = [(-sum((a - b) ** 2 // b for a, b in zip(p, own[o][1])), o.encode())
                     for o in sources if o != s]
            terms = [(-((a - b) ** 2 // b), t.encode()) for c, a, b, t in zip(n, p, q, kept)
                     if c and a > b]
            for part, found in (("pair", pairs), ("term", sorted(terms)[:ranks])):
                out += [(lang, s, part, item.decode(), -v, k + 1)
                        for k, (v, item) in enumerate(sorted(found))]
    return sorted(out)


@pytest.mark.parametrize("first, growth, tally, block, cells", [
    (6, 4, 500_000, 100_000, 2_000_000), (1, 2, 50, 40, 30), (3, 3, 500, 7, 1)])
def test_equal_to_brute_force(spark, hard, monkeypatch, first, growth, tally, block, cells):
    for name, value in (("FIRST_WIDTH", first), ("GROWTH", growth), ("TALLY", tally),
                        ("BLOCK_COUNTS", block), ("BLOCK_CELLS", cells)):
        monkeypatch.setattr(divergence, name, value)
    got = divergence.audit(hard(rows()), term_ranks=30)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows(), ranks=30)


def test_prefix_clashes_change_nothing(spark, hard, monkeypatch):
    monkeypatch.setattr(divergence, "FILTER_BITS", 15)
    monkeypatch.setattr(divergence, "_in", lambda bitmap, keys: keys == keys)
    assert sorted(tuple(r) for r in divergence.audit(hard(rows())).collect()) == brute(rows())


def test_levels_discard_rare_prefixes(spark, hard):
    kept = divergence.kept_terms(hard(rows())).select("lang", "term").distinct().collect()
    terms = {tuple(r) for r in kept}
    assert ("en", "prefixes") in terms and ("en", "prefix") not in terms
    assert ("de", "y" * 5000) in terms and ("de", "shared") in terms and ("de", "rare") not in terms


def test_empty_table(hard):
    assert divergence.audit(hard([])).collect() == []
