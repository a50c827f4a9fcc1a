"""Checks made of documents: their keys, and that no text moves or is read again for a figure."""

import hashlib

from rollcall.plans import bindings as b, queries_study
from test_plans import SF, plan

TEXTS = ["", "one line", "first\nlast", "\nlast", "first\n", "\n", "a\n\nb\r\nc", "é ü\n日本\n終",
         None]


def test_keys_are_the_first_and_the_last_line(spark, tmp_path):
    # No id below 17 is one that the derivation gives a fixed owner or domain.
    rows = [(i, text, "en", "s", 700) for i, text in enumerate(TEXTS, 1)]
    spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, "
                          "n_chars bigint").write.parquet(f"{tmp_path}/documents.parquet")
    for checks in (b.document_checks(spark, str(tmp_path)), b.check_table(spark, str(tmp_path))):
        got = {r.id: (r.owner, r.uri_root_domain)
               for r in checks.select("id", "owner", "uri_root_domain").collect()}
        md5 = lambda line: hashlib.md5(line.encode()).hexdigest()
        assert got == {k: (None, None) if text is None else
                       ("O" + md5(text.split("\n")[0]), md5(text.split("\n")[-1]) + ".test")
                       for k, text, *_ in rows}


def test_no_text_is_moved(spark):
    assert "Exchange" not in plan(b.document_checks(spark, SF))


def test_figures_are_read_from_stored_checks(spark):
    agents, checks, _ = queries_study._publishable(spark, SF)
    files = agents.inputFiles() + checks.inputFiles()
    assert files and not [f for f in files if "documents.parquet" in f]
