"""Queries over documents and pages."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from rollcall.llm import classifier, mixing, packing, passages, setsketch, sharding
from rollcall.llm.queries import query, table


@query("op3_minhash_dedup")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, sf_dir, "documents"))


LEARNING = "pmod(crc32(cast(doc_id as string)), 4) <> 2"


def quality_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> classifier.Model:
    """A model of labels.quality, from labels outside the fold that is held out."""
    labels = table(spark, sf_dir, "labels").where(LEARNING) \
        .select("doc_id", (F.col("quality") == 1).alias("good"))
    return classifier.train(docs, labels)


@query("op1_quality_classifier")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    score = classifier.score(F.col("text"), quality_model(spark, sf_dir, docs))
    return docs \
        .select("doc_id", F.coalesce(~F.expr(LEARNING), F.lit(False)).alias("held_out"),
                score.alias("score")) \
        .withColumn("predicted", (F.col("score") >= classifier.THRESHOLD).cast("int"))


@query("op7_best_fit_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"),
                                    public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length",
                         F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset")


@query("op10_histogram_sharding")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.shard(table(spark, sf_dir, "documents").select("doc_id", "text"), 24)
    return sharded.select("doc_id", "size", F.crc32("text").alias("text_crc32"),
                          F.lit("bytes").alias("law"), "shard", "slot",
                          F.lit(None).cast("int").alias("grown_shard"))


@query("op4_source_mixing")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(table(spark, sf_dir, "documents")).taken()


@query("op8_passage_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = passages.without_repeats(
        table(spark, sf_dir, "documents").select("doc_id", "text"))
    return clean.select("doc_id", "text", F.to_json("removed").alias("removed"),
                        F.length("text").alias("kept_chars"),
                        F.crc32("text").alias("text_crc32"))
