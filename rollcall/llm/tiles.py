"""Dealing the members of a group of any size to bounded tiles in which every pair meets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def meet(rows: DataFrame, member: str, blocks: Column) -> DataFrame:
    """
    Add the columns i and j: the tiles of a group that a row goes to.

    A group is cut into `blocks` by a hash of the member. Two blocks make a tile, so that any two
    members share one; a group of one block is a tile by itself. Rows grow with the number of
    blocks, never with the number of pairs.
    """
    rows = rows.withColumn("_n", blocks.cast("int")) \
        .withColumn("_own", F.pmod(F.xxhash64(F.col(member), F.lit(7)), F.col("_n")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("_n") - 1), lambda x: x != F.col("_own"))
    pair = F.transform(others, lambda x: F.struct(F.least(x, F.col("_own")).alias("i"),
                                                  F.greatest(x, F.col("_own")).alias("j")))
    single = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    return rows.select("*", F.inline(F.when(F.col("_n") <= 1, single).otherwise(pair))) \
        .drop("_n", "_own")
