"""Merkle manifest of a dataset: one tree for each group, one over their roots, a proof for every row.

A slot pivot does every level: conditional aggregates spread the children of a parent into
as many columns as the fanout, in one row. Those columns concatenated hash to the parent;
left out its own, they are a child's siblings. Levels are built upwards, each an eighth of
the one below, and the proofs come down again by joins with one row per key on both sides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.llm.common import ranked
from driftline.shared import staged

FANOUT = 8
_PATH = "array<struct<left:binary,right:binary>>"


def digest(*texts: Column) -> Column:
    """Lower-case hex SHA-256 of texts one after another; those that are null add nothing."""
    return F.sha2(F.concat_ws("", *texts), 256)


def framed(column: Column) -> Column:
    """A value that no neighbour can run into: UTF-8 byte count, colon, value; ``-`` for null."""
    text = column.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(columns: list[Column]) -> Column:
    """The leaf digest of a row, of its values in the given order."""
    return F.sha2(F.concat(*[framed(c) for c in columns]), 256)


def _hex(column: Column) -> Column:
    return F.lower(F.hex(column))


def _joined(parts: list[Column]) -> Column:
    return F.concat(F.lit(bytearray()), *[F.coalesce(p, F.lit(bytearray())) for p in parts])


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The pivot of every level, from the lowest, and the top node (tree, digest) of each tree.

    ``nodes`` has (tree, n, idx, node): n nodes of a tree, each a struct whose first field is
    the digest. A tree that is down to one node passes through further levels unchanged.
    """
    slots = [f"s{i}" for i in range(fanout)]
    slot = F.pmod("idx", F.lit(fanout))
    height, most = 0, nodes.agg(F.max("n")).first()[0] or 0
    while fanout**height < most:
        height += 1
    pivots = []
    for level in range(max(height, 1)):
        spread = [F.max(F.when(slot == i, F.col("node"))).alias(s) for i, s in enumerate(slots)]
        parent = F.floor(F.col("idx") / fanout).cast("long").alias("idx")
        pivots.append(staged(nodes.groupBy("tree", "n", parent).agg(*spread), f"pivot-{level}"))
        whole = F.unhex(digest(*[_hex(F.col(f"{s}.digest")) for s in slots]))
        own = F.when(F.col("n") > 1, whole).otherwise(F.col("s0.digest"))
        nodes = pivots[-1].select(
            "tree", F.ceil(F.col("n") / fanout).alias("n"), "idx", F.struct(own.alias("digest")).alias("node")
        )
    return pivots, nodes.select("tree", "node.digest")


def _descend(pivots: list[DataFrame], tops: DataFrame, fanout: int) -> DataFrame:
    """(tree, idx, node, path) of every lowest node; ``tops`` has (tree, path) of the trees' tops.

    A path lists (left, right) for each level upwards: the digests, end to end, of the
    siblings before and after.
    """
    slots = [f"s{i}" for i in range(fanout)]
    above = tops.select("tree", F.lit(0).cast("long").alias("idx"), "path")
    for level in reversed(range(len(pivots))):
        digests = [F.col(f"{s}.digest") for s in slots]
        children = F.array(
            *[
                F.struct(
                    F.col(s).alias("node"),
                    F.lit(i).cast("long").alias("slot"),
                    F.struct(_joined(digests[:i]).alias("left"), _joined(digests[i + 1 :]).alias("right")).alias("step"),
                )
                for i, s in enumerate(slots)
            ]
        )
        rows = pivots[level].join(above, ["tree", "idx"]).select("tree", "n", "idx", "path", F.explode(children).alias("c"))
        path = F.when(F.col("n") > 1, F.concat(F.array("c.step"), F.col("path"))).otherwise(F.col("path"))
        above = rows.where("c.node IS NOT NULL").select(
            "tree", (F.col("idx") * fanout + F.col("c.slot")).alias("idx"), F.col("c.node").alias("node"), path.alias("path")
        )
        if level:
            above = staged(above, f"paths-{level}")
    return above


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf (hex) leads to over a path's siblings."""
    return F.aggregate(path, leaf, lambda own, step: digest(_hex(step["left"]), own, _hex(step["right"])))


def siblings_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level upwards, left to right."""
    return digest(F.array_join(F.transform(path, lambda step: _hex(F.concat(step["left"], step["right"]))), ""))


def manifest(
    rows: DataFrame, columns: list[str], group: str, order: str, keep: dict[str, Column] | None = None, fanout: int = FANOUT
) -> DataFrame:
    """One row for each row of ``rows``: (``order``, ``keep``..., leaf, subroot, root, path).

    A leaf is the digest of ``columns``. The leaves of one value of ``group`` ascend by
    ``order`` and form a tree; its nodes are runs of ``fanout`` hashed until one remains, the
    subroot. Subroots, ordered by group, form the tree of the root. Null groups and null
    order values come first, rows of equal order by their leaf, and repeated rows stay, each
    with a place and proof of its own. An empty table gives no rows. ``keep`` holds small
    columns to carry along, such as the leaf of another version of the row. Columns of
    other names are not read, so none can clash.

    Only digests, group and ``keep`` are shuffled, never the rows: once to rank them, once
    for the lowest pivot. A hot group is ranked and pivoted in as many tasks as it needs.
    """
    keep = keep or {}
    carried = {"order": F.col(order), **keep}
    leaves = rows.select(
        F.col(group).isNotNull().alias("named"),
        F.coalesce(F.col(group).cast("string"), F.lit("")).alias("name"),
        F.col(order).alias("by"),
        F.unhex(leaf_of([F.col(c) for c in columns])).alias("digest"),
        F.struct(*[c.alias(k) for k, c in carried.items()]).alias("kept"),
    )
    leaves = ranked(leaves, ["named", "name"], ["by", "digest"], "leaves")
    groups = leaves.groupBy("named", "name").agg(F.count("*").alias("n"))
    groups = staged(ranked(groups, [], ["named", "name"], "groups").withColumnRenamed("idx", "tree"), "trees")
    # One row for each group on this side, so that a hot group is split, not gathered.
    placed = leaves.join(groups, ["named", "name"])
    low, subroots = _climb(
        placed.select("tree", "n", "idx", F.struct("digest", "kept").alias("node")), fanout
    )
    subroots = staged(subroots, "subroots")
    count = groups.count()
    high, root = _climb(
        subroots.select(
            F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("n"), F.col("tree").alias("idx"),
            F.struct("digest").alias("node"),
        ),
        fanout,
    )
    root = root.select("tree", F.col("digest").alias("root"), F.array().cast(_PATH).alias("path"))
    root = staged(root, "root")
    tops = _descend(high, root, fanout).join(F.broadcast(root.select("tree", "root")), "tree")
    tops = staged(tops.select(F.col("idx").alias("tree"), F.col("node.digest").alias("subroot"), "root", "path"), "tops")
    found = _descend(low, tops.select("tree", "path"), fanout).join(tops.drop("path"), "tree")
    return found.select(
        F.col("node.kept.order").alias(order), *[F.col(f"node.kept.{k}").alias(k) for k in keep],
        _hex(F.col("node.digest")).alias("leaf"), _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), "path",
    )

