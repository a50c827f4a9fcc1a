"""Rows that every operator has to stand: nulls, empty and very long texts, ties, repeated rows."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    out = []
    for k in range(n):
        w = "".join(r.choice("abcdeé") for _ in range(2)) + str(r.randrange(vocabulary))
        out.append(w + ("." if k % 9 == 8 else "") + ("\n" if k % 40 == 39 else ""))
    return " ".join(out)


def documents():
    base = words(1, 120)
    passage = "\n" + words(77, 60, 9000) + ".\n"
    rows = [(k, words(100 + k, 30 + 7 * k), "en", f"s{k % 3}", 0) for k in range(24)]
    rows += [
        (30, base, "en", "s0", 1), (31, base, "en", "s1", 1), (32, base.upper(), "de", "s1", 2),
        (33, base.replace("\n", "\t"), None, None, None), (34, base + " x y", "en", "s0", 3),
        (35, " ".join(base.split()[:96]), "en", "s0", 3),
        (40, None, None, None, None), (41, "", "en", "s0", 0), (42, " \n\t ", "en", "", 4),
        (43, "one", "en", "s4", 3), (44, "One", "en", "s4", 3), (45, "a b c", "en", "s4", 5),
        (46, "a b c d", "en", "s5", 7), (47, "漢字 é ü ß   \x1c emoji 😀", "ja", "zz", 9),
        (50, words(5, 9000, 50), "en", "s0", 9), (51, words(5, 9000, 50) + " end", "en", "s2", 9),
        (52, "x" * 30000, "en", "s1", 30000), (53, "again " * 4000, "en", "s1", 30000),
        (60, words(6, 50) + passage + words(7, 50), "en", "s0", 9),
        (61, words(8, 50) + passage + words(9, 50), "en", "s0", 9),
        (62, words(10, 50) + passage, "en", "s2", 9),
        (70, words(11, 40), "en", "s0", 9), (70, words(11, 40), "en", "s0", 9),
        (71, words(12, 40), "en", "s0", 9), (71, words(13, 40), "en", "s1", 9),
        (None, words(14, 40), "en", "s0", 9), (None, base, "en", "s0", 9), (None, None, None, None, 1),
        (-5, words(15, 40), "en", "\U0001f600", 9), (2 ** 62, words(15, 40), "en", "￮", 9),
    ]
    return rows


def frame(spark, rows=None):
    """The rows with columns besides, named like ones that operators make."""
    df = spark.createDataFrame(documents() if rows is None else rows, SCHEMA).repartition(3)
    for name in ("rank", "size", "block", "key", "rep", "root", "score", "tile", "d1", "mark",
                 "start", "length", "vertex", "removed", "units", "host", "path"):
        df = df.selectExpr("*", f"cast(null as string) AS {name}")
    return df
