"""The queries of the operators, one each, over the whole table that it is meant for."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rollcall.plans.catalog import query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
