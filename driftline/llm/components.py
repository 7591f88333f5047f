"""Connected components of a link table, and the same inside one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from driftline.shared import staged


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the label trees of ``a[i]`` and ``b[i]`` in place; a label is its tree's smallest index."""
    while True:
        la, lb = labels[a], labels[b]
        apart = la != lb
        if not apart.any():
            return
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(la, lb)[apart], np.minimum(la, lb)[apart])
        while not np.array_equal(shorter := labels[labels], labels):
            labels[:] = shorter


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Keeps of each batch of links a forest with the same components."""
    for rows in batches:
        nodes, at = np.unique(rows[["a", "b"]].to_numpy(), return_inverse=True)
        at = at.reshape(-1, 2)
        labels = np.arange(len(nodes))
        merge_labels(labels, at[:, 0], at[:, 1])
        child = np.flatnonzero(labels != np.arange(len(nodes)))
        yield pd.DataFrame({"a": nodes[child], "b": nodes[labels[child]]})


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)``, two long columns; root is the smallest node reached.

    Links are folded batch by batch, then hung alternately on the smallest neighbour among
    all and among the smaller ones until nothing moves. Each round is written to the shared folder.
    The links are written first: folded where a Python function makes them, each task would
    hold two Python workers.
    """
    found = staged(links.where("a != b"), "found")
    edges = staged(
        found.mapInPandas(_forest, "a long, b long")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "links",
    )
    state = _signature(edges)
    while state[0]:
        edges = staged(_small_star(_large_star(edges)), "stars")
        before, state = state, _signature(edges)
        if before == state:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    hung = both.where("b > a").join(least, "a")
    return hung.select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("a").agg(F.min("b").alias("m"))
    moved = edges.join(least, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionAll(least.select("a", F.col("m").alias("b"))).distinct()
