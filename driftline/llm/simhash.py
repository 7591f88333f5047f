"""SimHash near-duplicates, found with a hierarchical index over Gray-ordered fingerprints.

Distinct fingerprints are sorted by Gray rank, where neighbours differ in few bits, and
cut into blocks. A node of the index keeps the bits that all fingerprints below it share;
a pair of nodes whose shared bits already differ too often is dropped with all below it.
Blocks are paired by Spark over the upper levels; inside a pair of blocks the lower levels
hold only the bits that their parents lack, and differences add up on the way down.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from driftline.llm import block_tree
from driftline.llm.common import extend, packed
from driftline.llm.components import connected_components, merge_labels
from driftline.shared import keyed_join, staged

SHINGLE_WORDS = 3
MAX_DIFFERENCES = 2
BLOCK = 4096
_SEED = 42
_STEP = 1 << 17
# Rows under a node of the two lower levels inside a block.
_UPPER, _LOWER = 512, 64


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a text's word shingles, as a signed number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    count = max(len(words) - shingle_words + 1, min(len(words), 1))
    if not count:
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, _STEP):
        hashes = np.fromiter(
            (
                xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle_words]), _SEED)
                for i in range(at, min(count, at + _STEP))
            ),
            dtype=">u8",
        )
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > count).view(">i8")[0])


def with_fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(doc_id, text_hash, fp) for every row of ``docs(doc_id, text)``."""

    def make():
        return lambda texts: [pa.array([fingerprint(t, shingle_words) for t in texts.to_pylist()], pa.int64())]

    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return extend(named, "text", make, "fp long", drop=("text",))


def gray_rank(fp: Column) -> Column:
    """Place of a fingerprint in the Gray sequence, as a long that sorts that way."""
    for shift in (1, 2, 4, 8, 16, 32):
        fp = fp.bitwiseXOR(F.shiftrightunsigned(fp, shift))
    return fp.bitwiseXOR(F.lit(-(1 << 63)))


def near_duplicates(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_differences: int = MAX_DIFFERENCES
) -> DataFrame:
    """(doc_id, text_hash, fp, root, component_id) for every row of ``docs(doc_id, text)``.

    Two rows link when their fingerprints differ in at most ``max_differences`` bits;
    component_id is the smallest doc_id reachable, root the smallest fingerprint. A null
    text counts as empty, and texts without words have fingerprint zero. Rows with a null
    doc_id take part; they give a component its id only as null, when it has no other.
    Repeated rows stay; an empty table gives no rows; other columns are not read.
    """
    marked = staged(with_fingerprints(docs, shingle_words), "fingerprints")
    groups = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "groups")
    roots = connected_components(fingerprint_links(groups.select("fp"), max_differences))
    rooted = groups.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    owners = staged(rooted.select("fp", "root").join(least, "root"), "owners")
    return keyed_join(marked, owners, ["fp"], "inner").select(
        "doc_id", "text_hash", "fp", "root", "component_id"
    )


def fingerprint_links(distinct: DataFrame, max_differences: int) -> DataFrame:
    """Links (a, b) between distinct fingerprints ``fp`` that keep every component whole."""

    def pack(rows: pd.DataFrame) -> dict:
        fps = rows["fp"].to_numpy(dtype=np.int64)
        return {
            "fps": fps.tobytes(),
            "ones": int(np.bitwise_and.reduce(fps)),
            "zeros": int(np.bitwise_and.reduce(~fps)),
        }

    def may_join(a: str, b: str) -> Column:
        apart = F.col(f"{a}ones").bitwiseAND(F.col(f"{b}zeros"))
        other = F.col(f"{a}zeros").bitwiseAND(F.col(f"{b}ones"))
        return F.bit_count(apart.bitwiseOR(other)) <= max_differences

    def link(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for i, j, a, b in zip(rows["i"], rows["j"], rows["a_fps"], rows["b_fps"], strict=True):
                yield _block_links(
                    np.frombuffer(a, np.int64), None if i == j else np.frombuffer(b, np.int64), max_differences
                )

    ranked = distinct.select("fp", gray_rank(F.col("fp")).alias("rank"))
    parts = max(1, distinct.count() // (4 * BLOCK))
    blocks = block_tree.cut_blocks(
        ranked, ["rank"], parts, BLOCK, pack, "fps binary, ones long, zeros long"
    )
    pairs = block_tree.close_blocks(
        blocks, {"ones": F.bit_and, "zeros": F.bit_and}, may_join
    )
    return block_tree.paired_blocks(blocks, pairs, ["fps"]).mapInPandas(link, "a long, b long")


def _block_links(left: np.ndarray, right: np.ndarray | None, most: int) -> pd.DataFrame:
    """A forest over the fingerprints of two blocks (or of one) with the components of their links."""
    fps = left if right is None else np.concatenate([left, right])
    offset = 0 if right is None else len(left)
    labels = np.arange(len(fps))
    a_low, a_up = _levels(left)
    b_low, b_up = (a_low, a_up) if right is None else _levels(right)
    i, j = (x.ravel() for x in np.indices((len(a_up[0]), len(b_up[0]))))
    seen = a_up[1][i] & b_up[1][j]
    apart = _ones((a_up[0][i] ^ b_up[0][j]) & seen)
    near = apart <= most
    i, j, seen, apart = i[near], j[near], seen[near], apart[near]
    ratio = _UPPER // _LOWER
    steps = np.arange(ratio)
    i = np.repeat(i * ratio, ratio * ratio) + np.tile(np.repeat(steps, ratio), len(i))
    j = np.repeat(j * ratio, ratio * ratio) + np.tile(np.tile(steps, ratio), len(j))
    seen, apart = np.repeat(seen, ratio * ratio), np.repeat(apart, ratio * ratio)
    real = (i < len(a_low[0])) & (j < len(b_low[0]))
    i, j, seen, apart = i[real], j[real], seen[real], apart[real]
    # Only the bits that the parents did not share are compared; their differences are kept.
    fresh = a_low[1][i] & b_low[1][j] & ~seen
    apart = apart + _ones((a_low[0][i] ^ b_low[0][j]) & fresh)
    i, j = i[apart <= most], j[apart <= most]
    inside = np.arange(_LOWER)
    for at in range(0, len(i), 128):
        rows = i[at : at + 128, None] * _LOWER + inside
        cols = j[at : at + 128, None] * _LOWER + inside
        x = left[np.minimum(rows, len(left) - 1)]
        y = (left if right is None else right)[np.minimum(cols, len(fps) - offset - 1)]
        linked = _ones(x[:, :, None] ^ y[:, None, :]) <= most
        linked &= (rows < len(left))[:, :, None] & (cols < len(fps) - offset)[:, None, :]
        pair, r, c = np.nonzero(linked)
        merge_labels(labels, rows[pair, r], cols[pair, c] + offset)
    child = np.flatnonzero(labels != np.arange(len(fps)))
    return pd.DataFrame({"a": fps[child], "b": fps[labels[child]]})


def _ones(bits: np.ndarray) -> np.ndarray:
    """How many of the 64 bits are set; numpy counts those of the absolute value in signed numbers."""
    return np.bitwise_count(bits.view(np.uint64))


def _levels(fps: np.ndarray) -> tuple:
    """(bits, mask of shared bits) of the nodes over every _LOWER and every _UPPER fingerprints."""
    out = []
    for size in (_LOWER, _UPPER):
        starts = np.arange(0, len(fps), size)
        ones = np.bitwise_and.reduceat(fps, starts)
        zeros = np.bitwise_and.reduceat(~fps, starts)
        out.append((ones, ones | zeros))
    return tuple(out)


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """The documents without near-duplicates: of each component the smallest doc_id stays.

    Among rows with that doc_id the one with the smallest text hash stays, once. A
    component with no doc_id but null keeps one such row.
    """
    return keep_least(docs, staged(near_duplicates(docs, **options), "components"))


def keep_least(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """``keep_one`` of components that are known: ``marked`` has (doc_id, text_hash, root) of every row."""
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash"))
    chosen = marked.groupBy("root").agg(F.min(order).alias("least")).select(
        F.col("least.id").alias("_id"), F.col("least.hash").alias("_hash")
    )
    rows = packed(docs, text_hash=F.xxhash64("text"))
    same = rows["row.doc_id"].eqNullSafe(chosen["_id"]) & (rows["text_hash"] == chosen["_hash"])
    copies = Window.partitionBy("row.doc_id", "text_hash").orderBy("text_hash")
    return (
        rows.join(chosen, same, "left_semi")
        .withColumn("copy", F.row_number().over(copies))
        .where("copy = 1")
        .select("row.*")
    )
