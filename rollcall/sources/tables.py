"""Parquet tables with the write rules of the registry's store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rollcall.operators.dedupe import new_rows
def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def read(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    return spark.read.schema(schema).parquet(path) if exists(spark, path) else None


def versions(spark: SparkSession, path: str) -> list[int]:
    """The numbers of the complete folders version=N below a path, ascending."""
    if not exists(spark, path):
        return []
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in
             target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)]
    found = [int(n.removeprefix("version=")) for n in names if n.startswith("version=")]
    return sorted(n for n in found if exists(spark, f"{path}/version={n}/_SUCCESS"))


def append_new(incoming: DataFrame, path: str, schema: str, keys: Sequence[str],
               partition: str, restrict: Column | None = None) -> DataFrame:
    """
    Append the rows whose key is not stored yet and return them.

    `restrict` narrows the stored side of the check, e.g. to the block range of the batch, so
    that row groups outside it are skipped. Rows are spread over the writing tasks by key and
    not by partition value: one directory with a third of all rows is written by many tasks.
    """
    spark = incoming.sparkSession
    stored = read(spark, path, schema)
    if stored is not None and restrict is not None:
        stored = stored.where(restrict)
    fresh = new_rows(incoming, stored, keys)
    fresh.write.partitionBy(partition).mode("append").parquet(path)
    return fresh


def overwrite_partitions(rows: DataFrame, path: str, partition: str) -> None:
    """Replace exactly the partitions that occur in `rows`."""
    rows.write.partitionBy(partition).mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """Document texts kept for later study, one directory per run."""
    overwrite_partitions(documents, path, "run_id")


def append_checks(checks: DataFrame, path: str, schema: str) -> DataFrame:
    """The first row of a run and agent stays; a run reads only its own directory."""
    return append_new(checks, path, schema, ("run_id", "agent_id"), "run_id")
