"""
Connected components of a graph given as edges, by alternating star rounds.

Large star: every vertex tells its higher neighbours the lowest vertex it knows. Small star: it
tells its lower ones, and keeps to the lowest itself. In the end every vertex hangs on the lowest
of its component (Kiveris and others, "Connected components in MapReduce and beyond", 2014). The
rounds grow with the square of the logarithm of the size at most. A hub is aggregated before the
shuffle, and the join that tells its neighbours is split by the adaptive planner. Each round reads
what the one before wrote to the shared folder, so a lost executor costs a part of one round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

from rollcall.session import discard, fresh_path, materialise


def component_labels(edges: DataFrame) -> DataFrame:
    """
    (vertex, label) for every vertex of the edges (a, b), of any type with an order; the label is
    the lowest vertex of the component. Loops and nulls are left out.
    """
    base = fresh_path(edges.sparkSession, "edges")
    current, mark = _stored(edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{base}/0")
    done, turn = None, 0
    # A round that leaves all edges as they are is the last; every other brings one lower.
    while mark[0] and mark != done:
        done, turn = mark, turn + 1
        current, mark = _stored(_round(current), f"{base}/{turn}")
        discard(edges.sparkSession, f"{base}/{turn - 1}")
    lowest = current.select("b").distinct().select(F.col("b").alias("a"), "b")
    return current.union(lowest).toDF("vertex", "label")


def extended_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """
    The labels (vertex, label) of a graph, put right for more edges (a, b): what `component_labels`
    gives for all edges together. Old edges are not needed.

    A component is one vertex here, its label, so an edge inside it falls away and only the edges
    between components and new vertices go through the rounds. Work grows with the new edges, but for
    one look at all labels.
    """
    new = edges.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    between = materialise(
        new.join(labels.toDF("a", "_low"), "a", "left").join(labels.toDF("b", "_high"), "b", "left")
        .select("a", "b", F.coalesce("_low", "a").alias("_low"),
                F.coalesce("_high", "b").alias("_high")), "contracted")
    moved = component_labels(between.select(F.col("_low").alias("a"), F.col("_high").alias("b"))) \
        .toDF("label", "_moved")
    # New vertices are named by the new edges; a known one comes with the label it has.
    ends = between.select(F.inline(F.array(
        F.struct(F.col("a").alias("vertex"), F.col("_low").alias("label")),
        F.struct(F.col("b").alias("vertex"), F.col("_high").alias("label"))))).distinct()
    fresh = ends.join(labels.select("vertex"), "vertex", "left_anti")
    return labels.select("vertex", "label").unionByName(fresh).join(moved, "label", "left") \
        .select("vertex", F.coalesce("_moved", "label").alias("label"))


def _round(edges: DataFrame) -> DataFrame:
    both = edges.select(F.inline(F.array(F.struct("a", "b"),
                                         F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    known = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
    large = both.where("b > a").join(known, "a") \
        .select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
    known = large.groupBy("a").agg(F.min("b").alias("low"))
    moved = large.join(known, "a").where("b <> low") \
        .select(F.col("b").alias("a"), F.col("low").alias("b"))
    return moved.union(known).distinct()


def _stored(edges: DataFrame, path: str) -> tuple[DataFrame, tuple[int, int]]:
    """Write edges; their number and a sum of hashes tell one set of edges from another."""
    seen = Observation()
    edges.observe(seen, F.count(F.lit(1)).alias("edges"), F.sum(
        F.xxhash64("a", "b") % 1_000_000_007).alias("sum")).write.parquet(path)
    return edges.sparkSession.read.schema(edges.schema).parquet(path), \
        (seen.get["edges"], seen.get["sum"])
