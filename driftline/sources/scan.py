"""Reading tables, audit logs and decoded change events.

Every scan narrows to the columns it needs and leaves row filters as plain
comparisons on stored columns, so both reach the parquet or JDBC source.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftline.contracts import Contract


@dataclass(frozen=True)
class Source:
    """Where a table lives: a file format under ``path`` or a JDBC ``url``."""

    format: str = "parquet"
    path: str | None = None
    url: str | None = None
    options: Mapping[str, str] = field(default_factory=dict)
    partition_column: str | None = None
    lower_bound: str | None = None
    upper_bound: str | None = None
    num_partitions: int = 1
    fetch_size: int = 1000


def read_table(spark: SparkSession, source: Source, table: str) -> DataFrame:
    """One table of a source; JDBC reads are split over ``partition_column``."""
    reader = spark.read.options(**source.options)
    if source.format != "jdbc":
        return reader.format(source.format).load(f"{source.path}/{table}".rstrip("/"))
    reader = reader.format("jdbc").options(
        url=source.url, dbtable=table, fetchsize=str(source.fetch_size)
    )
    if source.partition_column:
        reader = reader.options(
            partitionColumn=source.partition_column,
            lowerBound=source.lower_bound,
            upperBound=source.upper_bound,
            numPartitions=str(source.num_partitions),
        )
    return reader.load()


def _bounded(spark: SparkSession, source: Source, table: str, key: str) -> Source:
    """The source with read bounds from the smallest and largest value of a key, one row asked for."""
    asked = f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}) AS bounds"
    low, high = read_table(spark, source, asked).first()
    if low is None or low == high:
        return source
    parts = max(source.num_partitions, spark.sparkContext.defaultParallelism)
    return replace(source, partition_column=key, lower_bound=str(low), upper_bound=str(high), num_partitions=parts)


def snapshot_scan(spark: SparkSession, source: Source, table: str, contract: Contract) -> DataFrame:
    """The whole table, narrowed to the contract's columns.

    A JDBC table without given bounds is split over the first whole-number key.
    """
    whole = [f.name for f in contract.fields if f.name in contract.keys and f.type in ("int", "bigint")]
    if source.format == "jdbc" and not source.partition_column and whole:
        source = _bounded(spark, source, table, whole[0])
    return read_table(spark, source, table).select(*contract.columns)


def audit_log_scan(
    spark: SparkSession,
    source: Source,
    audit_table: str,
    contract: Contract,
    op: str = "op",
    audit_id: str = "audit_id",
    commit_timestamp: str = "commit_timestamp",
    recorded_at: str = "recorded_at",
) -> DataFrame:
    """Change rows of an audit table: bookkeeping columns plus the contract's."""
    return read_table(spark, source, audit_table).select(
        F.col(audit_id).alias("audit_id"),
        F.col(op).alias("op"),
        F.col(commit_timestamp).alias("commit_timestamp"),
        F.col(recorded_at).alias("recorded_at"),
        *contract.columns,
    )


def change_event_scan(
    feed: DataFrame,
    contract: Contract,
    start_lsn: int | Column | None = None,
    table: str | None = None,
    table_column: str = "source_table",
    lsn: str = "lsn",
    keep: tuple[str, ...] = ("xid", "seq", "op"),
) -> DataFrame:
    """Decoded change events after ``start_lsn``, for one table of the feed.

    Works on batch and streaming frames alike. A missing start reads everything.
    """
    events = feed
    if table is not None:
        events = events.filter(F.col(table_column) == table)
    if start_lsn is not None:
        start = start_lsn if isinstance(start_lsn, Column) else F.lit(start_lsn)
        events = events.filter(F.col(lsn) > start)
    return events.select(lsn, *keep, *contract.columns)
