"""
From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents. run() applies them one after the other and writes what lies
between them to the shared folder.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import classifier, mixing, packing, passages, setsketch
from rollcall.llm.queries_text import quality_model
from rollcall.session import materialise, tune

# The workers of all stages share an executor's memory, so the last one remembers fewer words.
WORDS_KEPT = 50_000
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, n_chars counted anew."""
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = quality_model(tune(spark), sf_dir, docs)
    return docs.where(classifier.score(F.col("text"), model) >= classifier.THRESHOLD)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    tune(spark)
    return setsketch.deduplicated(docs).select(COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has."""
    tune(spark)
    return _documents(passages.without_repeats(docs))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of each source as often as its weight asks for, up to three rows a document."""
    tune(spark)
    return _documents(mixing.mixed(docs))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4096 tokens and their places in sequences."""
    tune(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"),
                                  words_kept=WORDS_KEPT)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("repeated_passages", repeated_passages), ("source_mix", source_mix),
          ("packed_sequences", packed_sequences)]

# A fitted classifier, near duplicates and a tokenizer cannot be put in SQL; tests compare each
# stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
