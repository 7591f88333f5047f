"""Pairs of blocks of a sorted sequence that may hold joining rows.

Blocks are numbered in sequence order. Upper nodes stand for runs of blocks and carry what
holds for all of them, so a pair of runs that cannot join drops out with everything below it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from driftline.shared import staged

_CHUNK_BITS = 24
_FANOUT_BITS = 5


def cut_blocks(
    rows: DataFrame,
    order: list[str],
    parts: int,
    size: int,
    pack: Callable[[pd.DataFrame], dict],
    schema: str,
    within: Callable[[pd.DataFrame], pd.Series] | None = None,
) -> DataFrame:
    """One row per run of at most ``size`` rows in sort order; ``block`` numbers follow that order.

    ``pack`` makes the columns of ``schema`` from the rows of a block. With ``within``, a
    block also ends where that value changes. The result is written and read back.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task, number, waiting = TaskContext.get().partitionId(), 0, None

        def out(block: pd.DataFrame) -> pd.DataFrame:
            nonlocal number
            number += 1
            packed = {k: [v] for k, v in pack(block).items()}
            return pd.DataFrame({"block": [(task << _CHUNK_BITS) + number - 1], **packed})

        for batch in batches:
            waiting = batch if waiting is None else pd.concat([waiting, batch], ignore_index=True)
            while len(waiting):
                same = len(waiting)
                if within:
                    marks = within(waiting)
                    changes = (marks != marks.shift()).to_numpy().nonzero()[0]
                    same = changes[1] if len(changes) > 1 else same
                if same < size and same == len(waiting):
                    break
                take = min(same, size)
                yield out(waiting.iloc[:take])
                waiting = waiting.iloc[take:].reset_index(drop=True)
        if waiting is not None and len(waiting):
            yield out(waiting)

    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    blocks = staged(ranged.mapInPandas(cut, f"block long, {schema}"), "blocks")
    # Numbers close up, so that a run of the upper levels is full of blocks.
    task, number = F.shiftright("block", _CHUNK_BITS), F.col("block") % (1 << _CHUNK_BITS)
    most = (blocks.agg(F.max(number)).first()[0] or 0) + 1
    return blocks.withColumn("block", task * most + number)


def close_blocks(
    blocks: DataFrame,
    bounds: dict[str, Callable[[Column], Column]],
    may_join: Callable[[str, str], Column],
) -> DataFrame:
    """(i, j), i <= j, of the blocks that ``may_join``, found from the top of the tree downwards.

    ``bounds`` names the columns of a node and the aggregate that makes them for the node
    above. ``may_join(a, b)`` is the test of two nodes by their column prefixes.
    """
    levels = [blocks.select(F.col("block").alias("node"), *bounds)]
    width = (blocks.agg(F.max("block")).first()[0] or 0) + 1
    while width > 1:
        upper = levels[-1].groupBy(F.shiftright("node", _FANOUT_BITS).alias("node"))
        levels.append(upper.agg(*[how(F.col(c)).alias(c) for c, how in bounds.items()]))
        width = (width + (1 << _FANOUT_BITS) - 1) >> _FANOUT_BITS
    pairs = levels[-1].select(F.col("node").alias("i"), F.col("node").alias("j"))
    for nodes in reversed(levels[:-1]):
        sides = [
            nodes.select(
                F.col("node").alias(f"{side}_node"),
                F.shiftright("node", _FANOUT_BITS).alias(up),
                *[F.col(c).alias(f"{side}_{c}") for c in bounds],
            )
            for side, up in (("a", "i"), ("b", "j"))
        ]
        pairs = pairs.join(sides[0], "i").join(sides[1], "j").where("a_node <= b_node")
        pairs = pairs.where(may_join("a_", "b_")).select(
            F.col("a_node").alias("i"), F.col("b_node").alias("j")
        )
    return pairs


def paired_blocks(blocks: DataFrame, pairs: DataFrame, columns: list[str]) -> DataFrame:
    """The blocks of each pair side by side, their columns prefixed ``a_`` and ``b_``."""
    pairs = staged(pairs, "pairs")
    left = blocks.select(F.col("block").alias("i"), *[F.col(c).alias(f"a_{c}") for c in columns])
    right = blocks.select(F.col("block").alias("j"), *[F.col(c).alias(f"b_{c}") for c in columns])
    return pairs.join(left, "i").join(right, "j")
