"""Small helpers that the operators share."""

from __future__ import annotations

import math
import string
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from driftline.shared import keyed_join, staged

# Bits of Spark's increasing id that number the rows inside a partition.
_ROW_BITS = 33

#: A word: ASCII letters and digits, and every character beyond ASCII.
WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and leaves every other character as it is."""
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def extend(
    df: DataFrame,
    use: str,
    make: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    added: str,
    drop: tuple[str, ...] = (),
    rows: int = 10_000,
) -> DataFrame:
    """``df`` without ``drop``, and with the columns ``added`` that are made from column ``use``.

    ``make`` runs once in a task and returns the function for its batches of at most
    ``rows`` rows. All other columns pass through as they are, whatever their types and
    nulls. Columns of ``df`` that have the name of an added one give way to it.
    """
    fields = StructType.fromDDL(added).fields
    names = {f.name for f in fields}
    kept = [c for c in df.columns if c not in names and (c not in drop or c == use)]
    out = [c for c in kept if c not in drop]
    source = df.select(*kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                columns = [part.column(c) for c in out] + work(part.column(use))
                yield pa.RecordBatch.from_arrays(columns, names=[*out, *(f.name for f in fields)])

    return source.mapInArrow(run, StructType([*(source.schema[c] for c in out), *fields]))


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """The rows whole, in one column ``row``, beside ``extra``: no name of theirs can clash."""
    return docs.select(
        F.struct(*docs.columns).alias("row"), *[column.alias(name) for name, column in extra.items()]
    )


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def parts_for(spark: SparkSession, rows: int, per_part: int) -> int:
    """Partitions for so many rows: grows with them, and never under the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows / per_part))


def bucket_of(key: Column, salt: int, parts: int) -> Column:
    """A reproducible remainder of a column's 64-bit hash."""
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(parts))


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether crc32 of an id's text falls on the fold that no fit may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == fold, F.lit(False))


def ranked(rows: DataFrame, group: list[str], order: list[str], label: str, per_part: int = 1_000_000) -> DataFrame:
    """``rows`` with ``idx``: the place of a row, from 0, among those of its group in the given order.

    Group columns hold no nulls; nulls of an order column come first. Rows that tie in all
    columns of the order come in that of ``tie``, a number that every row gets once and
    keeps, so that a recomputed task places rows as before. A range shuffle deals one group
    to as many tasks as it needs; only one row for each task and group is ordered across them.
    """
    raw = staged(rows.withColumn("tie", F.monotonically_increasing_id()), f"{label}-raw")
    by = [*group, *order, "tie"]
    parts = parts_for(rows.sparkSession, raw.count(), per_part)
    sorted_rows = raw.repartitionByRange(parts, *by).sortWithinPartitions(*by)
    number = F.monotonically_increasing_id()
    placed = staged(
        sorted_rows.select(
            "*", F.shiftright(number, _ROW_BITS).alias("part"), number.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("at")
        ),
        label,
    )
    pieces = placed.groupBy("part", *group).agg(F.count("*").alias("size"), F.min("at").alias("first"))
    upto = F.sum("size").over(Window.partitionBy(*group).orderBy("part"))
    shift = pieces.select("part", *group, (upto - F.col("size") - F.col("first")).alias("shift"))
    found = keyed_join(placed, staged(shift, f"{label}-starts"), ["part", *group], "inner")
    return found.withColumn("idx", F.col("at") + F.col("shift")).drop("tie", "part", "at", "shift")
