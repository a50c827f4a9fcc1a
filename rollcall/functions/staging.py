"""Computing columns once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def stage(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """
    Add columns that are evaluated exactly once, here.

    With plain projections the optimizer copies a column's expression into every filter that
    is pushed below it; a chain of steps that each use the one before several times then
    grows beyond what can be compiled. A generator of one row stays where it is: filters on
    its columns are not pushed through, filters and pruning of all other columns are.

    The values are computed in a projection below the generator. A generator that holds a function
    over arrays would be interpreted as a whole, a projection is compiled but for that function.
    """
    values = F.struct(*[value.alias(name) for name, value in columns.items()])
    return df.withColumn("_staged", values).select(*[F.col(f"`{c}`") for c in df.columns],
                                                   F.inline(F.array("_staged")))
