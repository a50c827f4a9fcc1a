"""Run a query in Spark and its SQL in DuckDB and compare the rows without regard to order."""

from __future__ import annotations

import datetime
import decimal
import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if value is None:
        return "\0null"
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value) if value != int(value) else repr(float(value))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        tuple(plain(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql) -> str | None:
    """None if equal, else what differs."""
    mine = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    relation = con.sql(sql)
    theirs = rows_of(relation.columns, relation.fetchall())
    if mine[0] != theirs[0]:
        return f"columns {mine[0]} against {theirs[0]}"
    if len(mine[1]) != len(theirs[1]):
        return f"{len(mine[1])} rows against {len(theirs[1])}: " \
               f"{mine[1][:2]} / {theirs[1][:2]}"
    for a, b in zip(mine[1], theirs[1]):
        if a != b:
            return f"{dict(zip(mine[0], a))}\n    against\n    {dict(zip(mine[0], b))}"
    if not mine[1]:
        return "no rows at all"
    return None
