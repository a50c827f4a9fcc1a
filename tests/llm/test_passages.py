import re

import pyarrow as pa

from hard import documents, words
from rollcall.llm import passages
from rollcall.llm.words import word_slices

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})
UPPER = {b: a for a, b in LOWER.items()}


def brute(rows):
    """Windows of MIN_WORDS words by rank of their texts: what an earlier place has goes."""
    found = [list(WORD.finditer(t or "")) for _, t in rows]
    own = [[m.group().translate(LOWER) for m in f] for f in found]
    digests = [tuple(x) for x in passages_digests([" ".join(w) for w in own])]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0,
                                                    digests[k]))
    seen, out, n = {}, [], passages.MIN_WORDS
    for place, k in enumerate(order):
        d, t = rows[k]
        gone = set()
        for i in range(len(own[k]) - n + 1):
            at = seen.setdefault(tuple(own[k][i:i + n]), (place, i))
            if at[0] < place or i - at[1] >= n:
                gone.update(range(i, i + n))
        cuts, i = [], 0
        while i < len(own[k]):
            j = i
            while j in gone:
                j += 1
            if j > i:
                cuts.append((found[k][i].start(), found[k][j].start() if j < len(own[k]) else len(t)))
            i = max(j, i + 1)
        kept, at = "", 0
        for a, b in cuts:
            kept, at = kept + t[at:a], b
        out.append((d, None if t is None else kept + t[at:], cuts))
    return out


def passages_digests(texts):
    parts = []
    for words in word_slices(pa.array(texts)):
        parts += zip(*[passages._hashes(words.codes, words.first[:-1], words.first[1:],
                                        passages._BASES[k]).view("int64").tolist() for k in (0, 1)])
    return parts


def result(df):
    return sorted(repr((r["doc_id"], r["text"], [(x["start"], x["end"]) for x in r["removed"]]))
                  for r in df.collect())


def test_equal_to_brute_force(hard):
    got = passages.without_repeats(hard())
    assert result(got) == sorted(map(repr, brute([(r[0], r[1]) for r in documents()])))
    assert set(got.columns) == set(hard().columns)


def test_rows_without_or_with_a_repeated_id_are_compared(hard):
    passage, other = own_words("p", 60), own_words("o", 60)
    rows = [(None, passage, "en", "s", 0)] * 3 + [
        (None, own_words("a", 9) + passage, "en", "s", 0), (4, other, "en", "s", 0),
        (4, other, "en", "s", 0), (4, other, "en", "t", 0), (4, own_words("b", 9) + other, "en", "s", 0),
        (5, other.upper(), "en", "s", 0), (6, "a b", "en", "s", 0), (6, "a b", "en", "s", 0)]
    got = passages.without_repeats(hard(rows))
    assert result(got) == sorted(map(repr, brute([(r[0], r[1]) for r in rows])))
    texts = [r["text"].split() for r in got.collect()]
    assert sum(t.count("p7") for t in texts) == sum(t.count("o7") for t in texts) == 1


def test_passages_go_and_clean_text_stays(hard):
    passage = words(500, 58, 9000)
    rows = [(1, "Own start one two.\n" + passage + ".\nOwn end here.", "en", "s", 0),
            (2, "Other é start. " + passage.translate(UPPER).replace(" ", "  ") + ".\nTail of it.", "en", "s", 0),
            (3, words(501, 80), "en", "s", 0), (4, "Own end here. And more.", "en", "s", 0)]
    got = {r["doc_id"]: r for r in passages.without_repeats(hard(rows)).collect()}
    assert got[2]["text"] == "Other é start. Tail of it."
    span = got[2]["removed"][0]
    assert rows[1][1][span["start"]:span["end"]].split()[0] == passage.translate(UPPER).split()[0]
    assert all(got[k]["text"] == rows[k - 1][1] for k in (1, 3, 4))


def test_empty_table(hard):
    assert passages.without_repeats(hard([])).collect() == []


def own_words(name, n, line=None):
    """n words that no other text has; a line holds `line` of them."""
    return "".join(f"{name}{k}" + ("\n" if line and k % line == line - 1 else " ")
                   for k in range(n))


def cleaned(hard, *texts):
    rows = [(k + 1, t, "en", "s", 0) for k, t in enumerate(texts)]
    return [r["text"] for r in sorted(passages.without_repeats(hard(rows)).collect(),
                                      key=lambda r: r["doc_id"])]


def test_passage_inside_a_sentence_goes(hard):
    plain = own_words("p", 52)
    parts = own_words("q", 20) + "end. " + own_words("r", 12) + "stop. " + own_words("s", 20)
    texts = [own_words(f"a{k}x", 30) + p + own_words(f"b{k}x", 30)
             for k, p in enumerate((plain, parts, plain, parts))]
    assert cleaned(hard, *texts) == texts[:2] + [own_words(f"a{k}x", 30) + own_words(f"b{k}x", 30)
                                                 for k in (2, 3)]


def word_brute(texts):
    """The words left of each text."""
    seen, out = {}, []
    for d, text in enumerate(texts):
        w = [x.translate(LOWER) for x in WORD.findall(text)]
        gone = set()
        for i in range(len(w) - passages.MIN_WORDS + 1):
            at = seen.setdefault(tuple(w[i:i + passages.MIN_WORDS]), (d, i))
            if at[0] < d or i - at[1] >= passages.MIN_WORDS:
                gone.update(range(i, i + passages.MIN_WORDS))
        out.append([x for i, x in enumerate(w) if i not in gone])
    return out


def test_words_left_equal_brute_force(hard):
    by_id = {r[0]: r[1] for r in documents() if r[0] is not None and r[0] != 71 and r[1]}
    texts = [by_id[d] for d in sorted(by_id)]
    # Copies of pieces of every length at any place.
    texts += [own_words(f"c{k}x", 5) + " ".join(texts[-1 - k].split()[k:k + 24 + k % 3])
              + " " + own_words(f"d{k}x", 5) for k in range(12)]
    got = [[x.translate(LOWER) for x in WORD.findall(t)] for t in cleaned(hard, *texts)]
    assert got == word_brute(texts)


def test_text_that_repeats_nowhere_stays(hard):
    head, foot = "The same heading of pages.\n", "The same footer of pages.\n"
    texts = [head + own_words(f"n{k}x", 300, 2) + foot for k in range(3)]
    shared = own_words("h", 30) + "\n"
    texts += [shared + "漢字" * 400 + f"{k}\n" + own_words("i", 30) + "\n" for k in range(2)]
    got = cleaned(hard, *texts)
    assert got[:4] == texts[:4]
    assert got[4] == "漢字" * 400 + "1\n"


def test_passage_of_short_lines_goes(hard):
    lists = own_words("v", 60, 1), own_words("w", 60, 3)
    texts = [own_words(f"a{k}x", 30) + "\n" + p + own_words(f"b{k}x", 30)
             for k, p in enumerate((*lists, *lists))]
    assert cleaned(hard, *texts) == texts[:2] + [
        own_words(f"a{k}x", 30) + "\n" + own_words(f"b{k}x", 30) for k in (2, 3)]
    # Lines that other texts have one by one are no passage.
    lines = own_words("u", 60, 1).splitlines()
    alone = [own_words(f"c{k}x", 9) + "\n" + w + "\n" + own_words(f"d{k}x", 9)
             for k, w in enumerate(lines)]
    assert cleaned(hard, *alone, "\n".join(lines)) == [*alone, "\n".join(lines)]
