"""Embedding near-duplicates by an epsilon grid order join.

Unit vectors are projected on their leading principal directions and sorted by the grid
cells of side epsilon that they fall in. The sorted sequence is cut into blocks; runs of
blocks are paired from the top down, and a pair of runs whose boxes lie further apart than
epsilon is dropped with all below it. Only the blocks that remain are compared, in double
precision, as matrix products.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm import block_tree
from driftline.llm.common import extend
from driftline.llm.components import connected_components, merge_labels
from driftline.shared import keyed_join, staged

MIN_COSINE = 0.93
BLOCK = 1024
DIRECTIONS = 4
# Room for rounding in the projected boxes; the cosine itself decides.
_SLACK = 1e-6


def _matrix(packed: pd.Series | list, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.float64).reshape(-1, width)


def _marked(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, v, links): every row, and whether its vector can link at all."""
    doubles = F.transform(vector_col, lambda x: x.cast("double"))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), doubles.alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    links = F.col("label").isNotNull() & finite & F.exists("v", lambda x: x != 0)
    return rows.withColumn("links", F.coalesce(links, F.lit(False)))


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, label, width, packed) of the vectors that can link, as packed doubles."""
    rows = _marked(vectors, id_col, vector_col, label_col).where("links").drop("links")

    def make():
        def pack(vectors: pa.Array) -> list[pa.Array]:
            ends = vectors.offsets.to_numpy()
            # Adding zero turns -0.0 into 0.0, so equal vectors have equal bytes.
            parts = vectors.values.to_numpy(zero_copy_only=False) + 0.0
            packed = [parts[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            return [pa.array(packed, pa.binary()), pa.array(np.diff(ends), pa.int32())]

        return pack

    return extend(rows, "v", make, "packed binary, width int", ("v",))


def principal_directions(distinct: DataFrame, count: int = DIRECTIONS) -> dict[int, np.ndarray]:
    """For each vector width, the leading directions of all unit vectors of that width.

    Tasks send sums of outer products, width by width squared, and no vectors.
    """

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for rows in batches:
            for width, some in rows.groupby("width"):
                unit = _units(_matrix(list(some["packed"]), width))
                total[width] = total.get(width, 0) + unit.T @ unit
        for width, outer in total.items():
            at, other = np.indices(outer.shape)
            yield pd.DataFrame({"width": width, "i": at.ravel(), "j": other.ravel(), "x": outer.ravel()})

    cells = distinct.select("packed", "width").mapInPandas(sums, "width int, i int, j int, x double")
    found: dict[int, np.ndarray] = {}
    for r in cells.groupBy("width", "i", "j").agg(F.sum("x").alias("x")).collect():
        outer = found.setdefault(r["width"], np.zeros((r["width"], r["width"])))
        outer[r["i"], r["j"]] = r["x"]
    return {w: np.linalg.eigh((m + m.T) / 2)[1][:, ::-1][:, :count] for w, m in found.items()}


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaling by the largest component first keeps the squares of huge values finite.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def near_duplicates(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    min_cosine: float = MIN_COSINE,
) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``, named after ``id_col``.

    Two rows link when their labels are equal and not null, their vectors have one width
    and their cosine is at least ``min_cosine``. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. n_links counts other rows, equal
    vectors included; component_id is the smallest id reachable; a row is kept when it has
    that id. Equal vectors of one label are compared once and counted by their number.
    Rows with a null id take part in links and reach the others' ids. Repeated rows stay
    and count as rows of their own; other columns are not read.
    """
    rows = staged(usable(vectors, id_col, vector_col, label_col), "vectors")
    distinct = rows.groupBy("label", "packed").agg(
        F.min("id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("width").alias("width")
    )
    # The key of a class of equal vectors: its place in the written table.
    distinct = distinct.withColumn("class", F.monotonically_increasing_id())
    distinct = staged(distinct, "distinct")
    found = staged(_links(distinct, min_cosine), "pairs-found")
    counts = found.where("a = b").groupBy(F.col("a").alias("class")).agg(F.sum("n").alias("n"))
    roots = connected_components(found.where("a != b").select("a", "b"))
    classes = (
        distinct.join(roots.withColumnRenamed("node", "class"), "class", "left")
        .join(counts, "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
        .withColumn("n_links", F.coalesce("n", F.lit(0)) + F.col("copies") - 1)
    )
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    owners = staged(
        classes.join(least, "root").select("label", "packed", "n_links", "component_id"), "owners"
    )
    linked = keyed_join(rows, owners, ["label", "packed"], "inner").select(
        "id", "n_links", "component_id"
    )
    kind = dict(vectors.dtypes)[id_col]
    alone = _marked(vectors, id_col, vector_col, label_col).where("NOT links").select(
        F.col("id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return linked.unionByName(alone).select(
        F.col("id").cast(kind).alias(id_col),
        F.col("n_links").cast("long").alias("n_links"),
        F.col("component_id").cast(kind).alias("component_id"),
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"),
    )


def _links(distinct: DataFrame, min_cosine: float) -> DataFrame:
    """(a, b, n): a row a = b counts the rows of other classes that a links with; other rows keep components whole."""
    directions = principal_directions(distinct)
    epsilon = math.sqrt(max(0.0, 2 - 2 * min_cosine)) + _SLACK
    places = [f"p{i}" for i in range(DIRECTIONS)]
    cells = [f"c{i}" for i in range(DIRECTIONS)]

    def project(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for width, some in rows.groupby("width"):
                spot = _units(_matrix(list(some["packed"]), width)) @ directions[width]
                spot = np.pad(spot, ((0, 0), (0, DIRECTIONS - spot.shape[1])))
                some = some.copy()
                for i in range(DIRECTIONS):
                    some[places[i]] = spot[:, i]
                    some[cells[i]] = np.floor(spot[:, i] / epsilon).astype(np.int32)
                yield some

    shape = "class long, label string, width int, copies long, packed binary"
    extra = [f"{p} double" for p in places] + [f"{c} int" for c in cells]
    names = ["class", "label", "width", "copies", "packed", *places, *cells]
    placed = distinct.select("class", "label", "width", "copies", "packed").mapInPandas(
        lambda batches: (rows[names] for rows in project(batches)), ", ".join([shape, *extra])
    )

    def pack(rows: pd.DataFrame) -> dict:
        spots = rows[places]
        return {
            "label": rows["label"].iloc[0],
            "width": int(rows["width"].iloc[0]),
            "classes": rows["class"].to_numpy(np.int64).tobytes(),
            "copies": rows["copies"].to_numpy(np.int64).tobytes(),
            "vectors": b"".join(rows["packed"]),
            **{f"lo{i}": float(spots[p].min()) for i, p in enumerate(places)},
            **{f"hi{i}": float(spots[p].max()) for i, p in enumerate(places)},
        }

    sides = [f"{side}{i} double" for side in ("lo", "hi") for i in range(DIRECTIONS)]
    parts = max(1, distinct.count() // (4 * BLOCK))
    blocks = block_tree.cut_blocks(
        placed,
        ["label", "width", *cells, "class"],
        parts,
        BLOCK,
        pack,
        ", ".join(["label string, width int, classes binary, copies binary, vectors binary", *sides]),
        within=lambda rows: rows["label"] + "\0" + rows["width"].astype(str),
    )
    blocks = blocks.select(
        "*",
        *[F.col("label").alias(f"label_{s}") for s in ("lo", "hi")],
        *[F.col("width").alias(f"width_{s}") for s in ("lo", "hi")],
    )
    bounds = {f"{c}_lo": F.min for c in ("label", "width")} | {f"{c}_hi": F.max for c in ("label", "width")}
    bounds |= {f"lo{i}": F.min for i in range(DIRECTIONS)} | {f"hi{i}": F.max for i in range(DIRECTIONS)}

    def may_join(a: str, b: str) -> Column:
        meet = F.lit(True)
        for c in ("label", "width"):
            meet = meet & (F.col(f"{a}{c}_lo") <= F.col(f"{b}{c}_hi")) & (F.col(f"{b}{c}_lo") <= F.col(f"{a}{c}_hi"))
        apart = F.lit(0.0)
        for i in range(DIRECTIONS):
            gap = F.greatest(
                F.lit(0.0), F.col(f"{a}lo{i}") - F.col(f"{b}hi{i}"), F.col(f"{b}lo{i}") - F.col(f"{a}hi{i}")
            )
            apart = apart + gap * gap
        return meet & (apart <= epsilon * epsilon)

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for r in rows.itertuples(index=False):
                yield _block_links(r, min_cosine)

    columns = ["width", "classes", "copies", "vectors"]
    pairs = block_tree.close_blocks(blocks, bounds, may_join)
    return block_tree.paired_blocks(blocks, pairs, columns).mapInPandas(compare, "a long, b long, n long")


def _block_links(pair, min_cosine: float) -> pd.DataFrame:
    """Link counts of the classes of one pair of blocks, and a forest over their links."""
    own = pair.i == pair.j
    a_class, b_class = (np.frombuffer(x, np.int64) for x in (pair.a_classes, pair.b_classes))
    a_copies, b_copies = (np.frombuffer(x, np.int64) for x in (pair.a_copies, pair.b_copies))
    left, right = (_units(_matrix([x], pair.a_width)) for x in (pair.a_vectors, pair.b_vectors))
    linked = left @ right.T >= min_cosine
    if own:
        np.fill_diagonal(linked, False)
    counted = [(a_class, linked @ b_copies)]
    if not own:
        counted.append((b_class, linked.T @ a_copies))
    classes = a_class if own else np.concatenate([a_class, b_class])
    labels = np.arange(len(classes))
    i, j = np.nonzero(linked)
    merge_labels(labels, i, j + (0 if own else len(a_class)))
    child = np.flatnonzero(labels != np.arange(len(classes)))
    out = [pd.DataFrame({"a": c, "b": c, "n": n})[n > 0] for c, n in counted]
    out.append(pd.DataFrame({"a": classes[child], "b": classes[labels[child]], "n": 0}))
    return pd.concat(out).astype("int64")
