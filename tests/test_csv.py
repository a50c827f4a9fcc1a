"""CSV files cut into records by quote parity against the reader that takes a file as a whole."""

import csv
import random

import pytest

from rollcall.session import fresh_path
from rollcall.sources import csvfiles

COLUMNS = ["agent_id", "a b", "uri"]


def files():
    r = random.Random(2)
    pieces = ["plain", 'say ""no""', "two\nlines", "\n\n", "comma, here", "é漢", '"', "", " x ", '""\n"']
    rows = [[str(k), "".join(r.choice(pieces) for _ in range(r.randrange(4))),
             "".join(r.choice(pieces) for _ in range(r.randrange(6)))] for k in range(400)]
    rows += [["big", "line\n" * 3000, '"quoted"\n' * 500], ["last", "x", "end"]]
    return [rows[:250], rows[250:], [], [["one", "a\nb", ""]]]


@pytest.mark.parametrize("block, newline", [("128m", "\n"), ("1000b", "\n"), ("7k", "\r\n")])
def test_cut_table_equals_whole_table(spark, tmp_path, block, newline):
    for k, rows in enumerate(files()):
        with open(tmp_path / f"{k}.csv", "w", newline="") as f:
            out = csv.writer(f, lineterminator=newline)
            out.writerows([COLUMNS, *rows])
            if k == 1:
                f.write(newline)
    whole = csvfiles.read_table(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        cut = csvfiles.read_cut_table(spark, str(tmp_path))
        assert cut.columns == whole.columns == COLUMNS
        got = sorted(tuple(x or "" for x in r) for r in cut.collect())
        tasks = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)
    assert got == sorted(tuple(r) for rows in files() for r in rows)
    if newline == "\n":
        assert got == sorted(tuple(x or "" for x in r) for r in whole.collect())
    assert (tasks > 20) == (block == "1000b")


def test_round_trip(spark):
    rows = spark.createDataFrame([(str(k), f'q"{k}\n\n,', None) for k in range(50)],
                                 "agent_id string, uri string, owner string")
    path = fresh_path(spark, "cut")
    csvfiles.write_table(rows, path, rows.columns)
    assert sorted(map(tuple, csvfiles.read_cut_table(spark, path).select("agent_id", "uri")
                      .collect())) == sorted((str(k), f'q"{k}\n\n,') for k in range(50))


def test_round_trip_keeps_blanks_and_controls(spark):
    r = random.Random(7)
    pieces = ['"', '"', "\0", "\n", "\r", "\r\n", ",", " ", "\t", "a", "\\", "é", "\x01", "﻿", " "]
    texts = [" lead", "trail ", "nl last\n", "\r\ncr first", "end\0", '"q"\0', 'a"\0b', "a\n\0", " ", "\0"]
    texts += ["".join(r.choice(pieces) for _ in range(r.randrange(9))) for _ in range(800)]
    given = [(str(k), x, texts[-1 - k]) for k, x in enumerate(texts)]
    path = fresh_path(spark, "ends")
    csvfiles.write_table(spark.createDataFrame(given, "agent_id string, uri string, owner string"),
                         path, ["agent_id", "uri", "owner"])
    for read in (csvfiles.read_table, csvfiles.read_cut_table):
        got = [tuple(x or "" for x in row) for row in read(spark, path).collect()]
        assert sorted(got) == sorted(given)


def test_queries_give_texts_as_they_are(spark, tmp_path):
    from rollcall.plans import queries_study

    texts = [" lead", "trail ", "two\nlines\n", '"q"\0', "\ttab", "plain"]
    spark.createDataFrame([(3 * k + 1, x) for k, x in enumerate(texts)] + [(3, " none")],
                          "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    want = sorted([(str(3 * k + 1), x, "agent_uri_at_registration") for k, x in enumerate(texts)]
                  + [("3", "", "")])
    for name in ("csv_round_trip", "csv_cut_round_trip"):
        assert sorted(map(tuple, getattr(queries_study, name)(spark, str(tmp_path)).collect())) == want


def test_cut_table_reads_on_after_noncharacters(spark):
    r = random.Random(8)
    pieces = ["\uffff", "\ufdd0", "\ufdd00", "\ufdd01", "0", "1", '"', "\n", ",", "a"]
    given = [(str(k), "".join(r.choice(pieces) for _ in range(r.randrange(1, 7))), f"end{k}")
             for k in range(500)]
    path = fresh_path(spark, "noncharacters")
    csvfiles.write_table(spark.createDataFrame(given, "agent_id string, uri string, owner string"),
                         path, ["agent_id", "uri", "owner"])
    assert set(map(tuple, csvfiles.read_cut_table(spark, path).collect())) == set(given)
