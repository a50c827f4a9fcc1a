"""The published JSON documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

# --- fixed values: names of the published documents -------------------------------------

DOCUMENTS = ("summary.json", "meta.json", "registrations.json", "funnel.json",
             "survival.json", "projects.json", "index.json")


def write_documents(documents: DataFrame, path: str) -> None:
    """
    Write (name, json), one directory per document.

    There are seven documents of a few kilobytes each, so one task writes them all.
    """
    documents.select(F.col("json").alias("value"), F.col("name")).coalesce(1) \
        .write.partitionBy("name").mode("overwrite").text(path)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(name, json) as written."""
    return spark.read.text(path, wholetext=True).select(
        F.col("name"), F.rtrim(F.col("value"), F.lit("\n")).alias("json"))


def read_saved(spark: SparkSession, path: str) -> DataFrame:
    """A saved document with its nested fields as columns."""
    return spark.read.json(path, multiLine=True)
