"""
The queries: each engine operator run over the benchmark tables, with the SQL that must give
the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rollcall.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query and, where SQL can express it, its counterpart."""
    def register(run: Query) -> Query:
        def tuned(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(tune(spark), sf_dir)
        tuned.__name__ = name
        QUERIES[name] = tuned
        if sql is not None:
            ORACLE[name] = sql
        return run
    return register


def round_sql(value: str, digits: int = 2) -> str:
    scale = f"{10 ** digits}.0"
    return f"(floor(({value}) * {scale} + 0.5) / {scale})"


def percent_sql(k: str, n: str) -> str:
    share = f"100.0 * (CAST({k} AS DOUBLE) / CAST({n} AS DOUBLE))"
    return f"CASE WHEN {n} > 0 THEN {round_sql(share)} END"


def wilson_sql(k: str, n: str) -> str:
    """Select list n, k, pct, ci_low, ci_high."""
    size, z = f"CAST({n} AS DOUBLE)", "CAST(1.96 AS DOUBLE)"
    p = f"(CAST({k} AS DOUBLE) / {size})"
    centre = f"({p} + {z} * {z} / (2.0 * {size}))"
    spread = f"({z} * sqrt({p} * (1.0 - {p}) / {size} + {z} * {z} / (4.0 * {size} * {size})))"
    scale = f"(1.0 + {z} * {z} / {size})"
    low = round_sql(f"100.0 * greatest(0.0, ({centre} - {spread}) / {scale})")
    high = round_sql(f"100.0 * least(1.0, ({centre} + {spread}) / {scale})")
    return f"""CAST({n} AS BIGINT) AS n, CAST(CASE WHEN {n} > 0 THEN {k} ELSE 0 END AS BIGINT) AS k,
        {percent_sql(k, n)} AS pct, CASE WHEN {n} > 0 THEN {low} END AS ci_low,
        CASE WHEN {n} > 0 THEN {high} END AS ci_high"""


def load() -> None:
    """Import every module that registers queries."""
    from rollcall.plans import queries_analyse, queries_files, queries_ingest, \
        queries_measure, queries_study

    del queries_analyse, queries_files, queries_ingest, queries_measure, queries_study
