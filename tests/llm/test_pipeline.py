"""The pipeline's stages against the operators' brute-force versions, over the smallest table."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from rollcall.llm import classifier, mixing
from test_mixing import size, water
from test_packing import brute_pieces, check_places
from test_passages import brute as without_passages
from test_setsketch import brute as components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def kept(spark):
    """The documents that each stage gets, and the last one's result."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        out[name] = docs = spark.createDataFrame(
            stage(spark, docs, SF).collect(), _schema(stage, docs))
    return out


def _schema(stage, docs):
    return docs.schema if stage is not corpus_pipeline.packed_sequences else \
        corpus_pipeline.packing.PIECES.replace(", used long", "")


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_quality_keeps_what_scores_high(spark, kept):
    model = corpus_pipeline.quality_model(spark, SF, kept["documents"])
    scores = {r["doc_id"]: r["s"] for r in kept["documents"].select(
        "doc_id", classifier.score(F.col("text"), model).alias("s")).collect()}
    assert {d for d, _ in texts(kept["quality"])} == {
        d for d, s in scores.items() if s >= classifier.THRESHOLD}


def test_near_duplicates_keep_one_of_each_group(kept):
    want = {d for d, _, c in components(texts(kept["quality"])) if d == c}
    assert sorted(d for d, _ in texts(kept["near_duplicates"])) == sorted(want)


def test_passages_are_removed(kept):
    want = [(d, t) for d, t, _ in without_passages(texts(kept["near_duplicates"]))]
    assert sorted(texts(kept["repeated_passages"])) == sorted(want)
    assert all(r["n_chars"] == len(r["text"]) for r in kept["repeated_passages"].collect())


def test_mix_is_near_its_targets(kept):
    before, after = {}, {}
    for counts, df in ((before, kept["repeated_passages"]), (after, kept["source_mix"])):
        for r in df.collect():
            counts[r["source"]] = counts.get(r["source"], 0) + size(r["text"])
    want = water(before)
    assert all(abs(after.get(s, 0) - want[s]) <= mixing.BLOCK_WORDS for s in want)


def test_sequences(kept):
    rows = kept["packed_sequences"].collect()
    pieces = brute_pieces(texts(kept["source_mix"]), 4096)
    assert sorted((r["doc_id"], r["piece"], r["length"]) for r in rows) == \
        sorted((d, p, n) for d, p, _, n, _ in pieces)
    assert check_places(rows, 4096) <= -(-sum(r["length"] for r in rows) // 4096) + 2


def test_run_is_the_stages_in_order(spark, kept):
    got = corpus_pipeline.run(spark, SF)
    def plain(df):
        return sorted((r["doc_id"], r["piece"], bytes(r["ids"])) for r in df.collect())
    assert plain(got) == plain(kept["packed_sequences"])
    assert contract.queries()["pipeline"] is corpus_pipeline.run


def test_empty_documents(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
