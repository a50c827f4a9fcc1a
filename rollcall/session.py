"""Session settings and the shared folder that long lineages are cut into."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings every job relies on. All of them can be set on a running session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a skewed partition is worth an extra exchange after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python workers get rows of long texts a few megabytes at a time.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8m",
    # Generated methods above this size are never compiled by the JVM: such a stage is faster as
    # several smaller ones.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Documents are read the way a JSON reader does: the last of two equal keys wins.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


# Where this package lies, for Python workers that start elsewhere. Clusters install it.
_HOME = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def tune(spark: SparkSession) -> SparkSession:
    """Apply the SQL settings to a session somebody else created."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if _HOME not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([*paths, _HOME])
    return spark


def local_session(name: str = "rollcall", cores: int | str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        # Plans here have thousands of expressions; recording where each was written is slow.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


# The fallback of each local application; the setting itself cannot be changed at run time.
_LOCAL_FOLDERS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """
    The folder for intermediate tables: the one the cluster names in spark.checkpoint.dir.

    Only a local session may fall back to a machine-local folder. On a cluster an executor
    cannot read another machine's disk, so a missing setting is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can read")
    application = spark.sparkContext.applicationId
    if application not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[application] = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return _LOCAL_FOLDERS[application]


# Intermediate tables of each application that have not been removed yet.
_WRITTEN: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new path for an intermediate table; `clean` removes what lies there."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Remove a table that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def clean(spark: SparkSession) -> int:
    """
    Remove all intermediate tables of this application; how many there were.

    To be called when a job is over and its results are written: frames that were made before
    can no longer be read.
    """
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        discard(spark, path)
    return len(paths)


def materialise(df: DataFrame, label: str) -> DataFrame:
    """
    Write a table to the shared folder and read it back.

    This cuts the lineage, survives the loss of executors, and gives the optimizer file
    sizes to choose joins by.
    """
    spark = df.sparkSession
    path = fresh_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
