import random
import re

import pyarrow as pa
import pytest

from hard import documents, words
from rollcall.llm import wumanber
from rollcall.llm.words import word_slices

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})
ITEMS = "item_id long, text string, spans string"


def split(text):
    return list(WORD.finditer((text or "").translate(LOWER)))


def brute(texts, items):
    windows = {}
    for item, text in items:
        w = [m.group() for m in split(text)]
        for i in range(len(w) - min(10, len(w)) + 1 if w else 0):
            windows.setdefault(tuple(w[i:i + 10]), set()).update([] if item is None else [str(item)])
    out = []
    for text in texts:
        found, w = split(text), [m.group() for m in split(text)]
        hit, listed = set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i:i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    listed |= own
        spans = []
        for k in sorted(hit):
            if spans and spans[-1][1] == k - 1:
                spans[-1] = (spans[-1][0], k, spans[-1][2], found[k].end())
            else:
                spans.append((k, k, found[k].start(), found[k].end()))
        out.append((len(w), spans, sorted(listed)))
    return out


def items():
    pieces = [r[1] for r in documents() if r[1] and len(r[1]) < 9000]
    return [(k, " ".join(t.upper().split()[3:3 + n]) + "!") for k, (t, n) in enumerate(
        zip(pieces, [30, 10, 9, 11, 1, 2, 40, 3, 5, 8, 7, 6, 4, 200]))] + [
        (90, None), (91, ""), (92, "?! "), (93, "one"), (93, words(102, 40)), (None, words(103, 40)),
        (94, "漢字 É é"), (95, "again again again"), (96, "again " * 12), (97, "x" * 30000),
        (98, "a b"), (99, words(100, 30)), (99, words(100, 30)), (100, words(100, 30) + " tail")]


@pytest.mark.parametrize("part, lane", [(200_000, 64), (40, 3)])
def test_equal_to_brute_force(spark, hard, monkeypatch, part, lane):
    monkeypatch.setattr(wumanber, "PART_WINDOWS", part)
    monkeypatch.setattr(wumanber, "LANE", lane)
    rows = documents() + [(200, "Say ONE, two.\0one-x", "en", "s", 0),
                          (201, ("again " * 30).strip() + " end", "en", "s", 0)]
    bench = spark.createDataFrame(items(), "item_id long, text string") \
        .selectExpr("*", "1 AS spans", "2 AS window", "3 AS item")
    got = wumanber.occurrences(hard(rows), bench)
    mine = sorted(repr((r["doc_id"], r["n_words"], [tuple(s) for s in r["spans"]], r["items"]))
                  for r in got.collect())
    want = brute([r[1] for r in rows], items())
    assert mine == sorted(repr((r[0], *w)) for r, w in zip(rows, want))
    assert sum(bool(w[1]) for w in want) > 15
    assert set(got.columns) == {*hard([]).columns, "n_words", "spans", "items"}
    kept = wumanber.decontaminated(hard(rows), bench)
    assert kept.columns == hard([]).columns
    assert kept.count() == sum(not w[1] for w in want)


def test_empty_tables(spark, hard):
    bench = spark.createDataFrame(items(), "item_id long, text string")
    assert wumanber.occurrences(hard([]), bench).collect() == []
    clean = wumanber.occurrences(hard(), bench.limit(0))
    assert clean.where("size(spans) > 0 or size(items) > 0").count() == 0
    assert clean.count() == len(documents())


def test_most_words_are_skipped():
    r = random.Random(1)
    text = " ".join(f"w{r.randrange(5000)}" for _ in range(5000))
    table = wumanber.Table([" ".join(f"v{r.randrange(5000)}" for _ in range(10)).encode()
                            for _ in range(20)], 10)
    looked = []
    first = table._hash
    table._hash = lambda codes, end: (looked.append(len(end)), first(codes, end))[1]
    (own,) = word_slices(pa.array([text]), between=wumanber.SEPARATES)
    assert len(table.search(own, text.encode())[0]) == 0
    assert sum(looked) < 5000 / 5
