"""Connected components: of a tile's links in memory, of a table of edges by star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from rollcall.operators.components import component_labels


def tile_roots(size: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """
    The smallest index reachable from each of `size` vertices by the links left[i] - right[i].

    Every round hooks the larger root of a link below the smaller one and shortens all paths,
    so the rounds grow with the logarithm of the size.
    """
    roots = np.arange(size)
    while len(left):
        a, b = roots[left], roots[right]
        open_ = a != b
        if not open_.any():
            break
        left, right = left[open_], right[open_]
        a, b = a[open_], b[open_]
        np.minimum.at(roots, np.maximum(a, b), np.minimum(a, b))
        while True:
            shorter = roots[roots]
            if (shorter == roots).all():
                break
            roots = shorter
    return roots


def components(edges: DataFrame) -> DataFrame:
    """
    (vertex, root) for every vertex of the edges (a, b), longs; root is the smallest vertex that
    can be reached. Nulls and loops are left out; no edges give no rows.
    """
    return component_labels(edges.select("a", "b")).withColumnRenamed("label", "root")
