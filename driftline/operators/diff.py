"""Snapshot hash-diff: compare a full snapshot with the curated state and merge it.

Only keys and fingerprints are compared, so wide columns are never shuffled for
the comparison. A curated table that stores its fingerprints is read for those two
columns alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.functions.hashing import row_hash
from driftline.shared import keyed_join, staged

ROW_HASH = "_row_hash"
RUN_ID = "_run_id"
CHANGE = "_change"
META = (ROW_HASH, RUN_ID, CHANGE)

INSERT, UPDATE, DELETE, UNCHANGED, PROTECTED = "insert", "update", "delete", "unchanged", "protected"


def fingerprints(df: DataFrame, keys: list[str], columns: list[str], method: str = "xxh128") -> DataFrame:
    """Keys and row fingerprint, from the stored column where there is one."""
    if ROW_HASH in df.columns:
        return df.select(*keys, ROW_HASH)
    return df.select(*keys, row_hash(df, columns, method).alias(ROW_HASH))


def hash_diff(
    snapshot: DataFrame,
    curated: DataFrame,
    keys: list[str],
    columns: list[str] | None = None,
    rejected: DataFrame | None = None,
    method: str = "xxh128",
) -> DataFrame:
    """Action of every key: ``insert``, ``update``, ``delete`` or ``unchanged``.

    Keys are unique on both sides; validation rejects duplicates first. Keys of
    ``rejected`` rows are missing from the snapshot only because they broke the
    contract, so they come out as ``protected`` instead of ``delete``. Leave it out
    to have them deleted.
    """
    # With nothing but keys, every key on both sides is unchanged.
    columns = columns or [c for c in snapshot.columns if c not in keys and c not in META] or keys
    new = fingerprints(snapshot, keys, columns, method).withColumnRenamed(ROW_HASH, "_new")
    old = fingerprints(curated, keys, columns, method).withColumnRenamed(ROW_HASH, "_old")
    new = new.withColumn("_in_new", F.lit(True))
    old = old.withColumn("_in_old", F.lit(True))
    joined = new.join(old, keys, "full_outer")
    if rejected is None:
        joined = joined.withColumn("_rejected", F.lit(False))
    else:
        joined = keyed_join(joined, _rejected_keys(rejected, keys), keys, "left")
    return joined.select(*keys, _action().alias("action"))


def _rejected_keys(rejected: DataFrame, keys: list[str]) -> DataFrame:
    held = rejected.select(*keys).dropna("any").distinct()
    return staged(held.withColumn("_rejected", F.lit(True)), "rejected-keys")


def _action() -> Column:
    return (
        F.when(F.col("_in_old").isNull(), INSERT)
        .when(F.col("_in_new").isNull() & F.coalesce("_rejected", F.lit(False)), PROTECTED)
        .when(F.col("_in_new").isNull(), DELETE)
        .when(F.col("_new").eqNullSafe(F.col("_old")), UNCHANGED)
        .otherwise(UPDATE)
    )


def change_counts(classified: DataFrame, action: str = "action") -> DataFrame:
    """The five counts of a comparison in one pass."""
    kind = F.col(action)
    return classified.agg(
        F.count_if(kind.isin(INSERT, UPDATE, UNCHANGED)).alias("read_count"),
        F.count_if(kind == INSERT).alias("insert_count"),
        F.count_if(kind == UPDATE).alias("update_count"),
        F.count_if(kind == DELETE).alias("delete_count"),
        F.count_if(kind == UNCHANGED).alias("unchanged_count"),
    )


def merge_snapshot(
    snapshot: DataFrame,
    curated: DataFrame | None,
    keys: list[str],
    run_id: str,
    rejected: DataFrame | None = None,
    method: str = "xxh128",
) -> DataFrame:
    """Curated state after a full snapshot.

    The state is the snapshot itself plus, per row, its fingerprint, what this run
    did to it and the last run that changed it. The curated side of the join is
    narrow: keys, fingerprints and run ids. Vanished keys go, except those seen in
    ``rejected``, which keep their curated row.
    """
    columns = [c for c in snapshot.columns if c not in META]
    values = [c for c in columns if c not in keys] or keys
    new = snapshot.select(*columns, row_hash(snapshot, values, method).alias(ROW_HASH))
    if curated is None:
        return new.withColumns({RUN_ID: F.lit(run_id), CHANGE: F.lit(INSERT)})
    old_run, old_hash = _stored(curated, values, method)
    old = curated.select(*keys, old_hash.alias("_old"), old_run.alias("_old_run"), F.lit(True).alias("_known"))
    same = F.col("_known") & F.col(ROW_HASH).eqNullSafe(F.col("_old"))
    change = F.when(F.col("_known").isNull(), INSERT).when(same, UNCHANGED).otherwise(UPDATE)
    merged = new.join(old, keys, "left").select(
        *columns,
        ROW_HASH,
        F.when(F.coalesce(same, F.lit(False)), F.col("_old_run")).otherwise(F.lit(run_id)).alias(RUN_ID),
        change.alias(CHANGE),
    )
    if rejected is None:
        return merged
    return merged.unionByName(protected_rows(snapshot, curated, keys, rejected, method))


def protected_rows(
    snapshot: DataFrame, curated: DataFrame, keys: list[str], rejected: DataFrame, method: str = "xxh128"
) -> DataFrame:
    """Curated rows whose key was rejected and is not in the snapshot either.

    Both large sides are only filtered by the rejected keys, without a shuffle while
    those are few. ``curated`` may be just the buckets the rejected keys fall into.
    """
    columns = [c for c in snapshot.columns if c not in META]
    old_run, old_hash = _stored(curated, [c for c in columns if c not in keys] or keys, method)
    held_keys = _rejected_keys(rejected, keys)
    held = curated.select(
        *columns, old_hash.alias(ROW_HASH), old_run.alias(RUN_ID), F.lit(PROTECTED).alias(CHANGE)
    )
    present = keyed_join(snapshot.select(*keys), held_keys, keys, "left_semi")
    return keyed_join(held, held_keys, keys, "left_semi").join(present, keys, "left_anti")


def _stored(curated: DataFrame, values: list[str], method: str) -> tuple[Column, Column]:
    """Run id and fingerprint of curated rows, stored or computed."""
    run = F.col(RUN_ID) if RUN_ID in curated.columns else F.lit(None).cast("string")
    stored = ROW_HASH in curated.columns
    return run, F.col(ROW_HASH) if stored else row_hash(curated, values, method)


def merge_counts(merged: DataFrame, curated_rows: Column | int) -> DataFrame:
    """Counts of a merged state: deletes are the curated rows that did not come back."""
    before = F.lit(curated_rows) if isinstance(curated_rows, int) else curated_rows
    kind = F.col(CHANGE)
    return merged.agg(
        F.count_if(kind != PROTECTED).alias("read_count"),
        F.count_if(kind == INSERT).alias("insert_count"),
        F.count_if(kind == UPDATE).alias("update_count"),
        (before - F.count_if(kind != INSERT)).cast("bigint").alias("delete_count"),
        F.count_if(kind == UNCHANGED).alias("unchanged_count"),
        F.count_if(kind == PROTECTED).alias("protected_count"),
    )
