"""Applying a landed delta, shared by both delta strategies, replay and streaming."""

from __future__ import annotations

import time
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from driftline.contracts import Contract
from driftline.operators.delta import (
    POSITION,
    POSITION_TYPE,
    SUB_ORDER,
    apply_delta,
    clock_micros,
    compact_delta,
    delta_counts,
    expand_key_changes,
    newer_events,
    position,
)
from driftline.plans.run import RunContext
from driftline.shared import broadcast_limit, scan_bytes, staged
from driftline.sources.curated import (
    Pointer,
    aligned,
    grown_buckets,
    read_curated,
    read_pointer,
    touched_buckets,
    with_splits,
    write_curated,
)
from driftline.sources.landing import read_landed

# Folders of deleted keys that are read side by side before they are folded into one.
_MOST_GRAVES = 16
# Bookkeeping columns of a landed delta, beside the contract's.
AUDIT_DDL = "audit_id bigint, op string"


def change_log_ddl(contract: Contract) -> str:
    """Bookkeeping columns of a landed change-log delta; old keys carry a prefix."""
    types = {f.name: f.type for f in contract.fields}
    old = ", ".join(f"`old_{k}` {types[k]}" for k in contract.keys)
    return f"lsn bigint, seq bigint, xid bigint, op string, {old}"


def curated_ddl(contract: Contract) -> str:
    return f"{contract.ddl}, {POSITION} {POSITION_TYPE}"


def retyped(contract: Contract, pointer: Pointer) -> bool:
    """Whether a column that is stored already has another type in the contract."""
    stored = {f.name: f.dataType.simpleString() for f in StructType.fromDDL(pointer.schema).fields}
    wanted = StructType.fromDDL(contract.ddl).fields
    return any(stored.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString() for f in wanted)


def refuse_misfits(state: DataFrame, contract: Contract, keyed: DataFrame | None = None) -> None:
    """Fails where a stored value has no place in the contract's type, before anything is written.

    With ``keyed`` only rows with one of its keys, in the contract's types, are looked at.
    """
    stored = {f.name: f.dataType.simpleString() for f in state.schema.fields}
    wanted = StructType.fromDDL(contract.ddl).fields
    moved = [f for f in wanted if stored.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
    if not moved:
        return
    types = {f.name: f.dataType.simpleString() for f in wanted}
    lost = {f.name: F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(types[f.name]).isNull() for f in moved}
    if keyed is not None:
        keys = list(contract.keys)
        rows = state.withColumns({f"_lost_{n}": c for n, c in lost.items()})
        rows = rows.withColumns({k: F.col(f"`{k}`").try_cast(types[k]) for k in keys if k in lost})
        state = rows.join(keyed.select(*keys).dropna("any").distinct(), keys, "left_semi")
        lost = {n: F.col(f"_lost_{n}") for n in lost}
    counts = state.agg(*[F.count_if(c).alias(n) for n, c in lost.items()]).first().asDict()
    bad = {n: c for n, c in counts.items() if c}
    if bad:
        told = ", ".join(f"{n} of {stored[n]} into {types[n]} in {c} rows" for n, c in bad.items())
        raise ValueError(f"stored values do not fit the contract: {told}; widen the contract or mend the rows")


def conformed(state: DataFrame, contract: Contract) -> DataFrame:
    """Curated rows under the contract; new columns are NULL. Rows that do not fit are refused before."""
    columns = [
        F.col(f"`{f.name}`").cast(f.type).alias(f.name) if f.name in state.columns else F.lit(None).cast(f.type).alias(f.name)
        for f in contract.fields
    ]
    return state.select(*columns, stored_position(state).alias(POSITION))


def stored_position(state: DataFrame) -> Column:
    """The position of curated rows; one that was stored as a single number is the major part."""
    if POSITION not in state.columns:
        return F.lit(None).cast(POSITION_TYPE)
    if isinstance(state.schema[POSITION].dataType, StructType):
        return F.col(POSITION)
    return F.when(F.col(POSITION).isNotNull(), position(F.col(POSITION), F.lit(0)))


def last_events(contract: Contract, landed: DataFrame, strategy: str) -> DataFrame:
    """Last event per key of a landed delta, with the position it came from."""
    keys = list(contract.keys)
    if strategy == "incremental_audit":
        ident = F.col("audit_id")
        at = position(ident, F.lit(0))
        if "_watermark" in landed.columns:
            at = position(clock_micros(F.col("_watermark"), dict(landed.dtypes)["_watermark"]), ident)
        events = landed.withColumn(POSITION, at)
    else:
        events = expand_key_changes(landed, keys, [f"old_{k}" for k in keys])
        events = events.withColumn(POSITION, position(F.col("lsn"), F.col("seq"), F.col(SUB_ORDER)))
    return compact_delta(events.select(*contract.columns, "op", POSITION), keys, [POSITION])


def deleted_keys(spark: SparkSession, root: str, contract: Contract, folders: list[str]) -> DataFrame:
    """Keys and newest positions of the deletes that the folders tell of, the keys in the contract's types."""
    types = {f.name: f.type for f in contract.fields}
    parts = [spark.read.parquet(f"{root}/graves/{name}") for name in folders]
    typed = [p.select(*[F.col(f"`{k}`").try_cast(types[k]).alias(k) for k in contract.keys], POSITION) for p in parts]
    # A key that the contract's type cannot hold can be in no delta either.
    return reduce(DataFrame.unionByName, typed).dropna("any", subset=list(contract.keys))


def _bury(ctx: RunContext, delta: DataFrame, pointer: Pointer | None, horizon: int | None) -> dict[str, int]:
    """Folders of deleted keys after this delta, with their marks.

    Each delta adds a folder of its own, so writing is in proportion to its deletes. Folders
    whose newest delete is more than ``horizon`` behind the newest of all are let go; many
    small ones are folded into one.
    """
    spark, keys = ctx.spark, list(ctx.contract.keys)
    graves = dict(zip(pointer.graves, pointer.grave_marks, strict=True)) if pointer else {}
    gone = delta.filter(F.col("op") == "D").select(*keys, POSITION)
    newest = gone.agg(F.max(f"{POSITION}.major").alias("m")).first()["m"]
    if newest is not None:
        name = uuid.uuid4().hex
        gone.write.parquet(f"{ctx.target_root}/graves/{name}")
        graves[name] = newest
    if horizon is not None and graves:
        graves = {n: m for n, m in graves.items() if m >= max(graves.values()) - horizon}
    if len(graves) > _MOST_GRAVES:
        name = uuid.uuid4().hex
        whole = deleted_keys(spark, ctx.target_root, ctx.contract, list(graves))
        whole.groupBy(*keys).agg(F.max(POSITION).alias(POSITION)).write.parquet(f"{ctx.target_root}/graves/{name}")
        graves = {name: max(graves.values())}
    return graves


def apply_landed(
    ctx: RunContext, delta_key: str, extra_ddl: str, buckets: int = 16, guard: bool = False, horizon: int | None = None
) -> dict[str, Any]:
    """Applies a landed delta to the curated table and counts its effect."""
    began = time.monotonic()
    landed = read_landed(ctx.spark, ctx.path(delta_key), ctx.contract, extra_ddl)
    delta = staged(last_events(ctx.contract, landed, ctx.strategy), "delta")
    counts = apply_compacted(ctx, delta, buckets, guard, horizon=horizon)
    counts["total_seconds"] = round(time.monotonic() - began, 3)
    return counts


def apply_compacted(
    ctx: RunContext,
    delta: DataFrame,
    buckets: int = 16,
    guard: bool = False,
    run_id: str | None = None,
    horizon: int | None = None,
) -> dict[str, Any]:
    """Rewrites only the buckets the delta's keys fall into, and those that are due to be split.

    With ``guard`` events no newer than the row of their key, or than its delete, are left
    out and not counted. Positions of deleted keys are kept for ``horizon``, in microseconds
    of the clock or bytes of the log, by default for ever.
    """
    spark, keys = ctx.spark, list(ctx.contract.keys)
    pointer = read_pointer(spark, ctx.target_root)
    before = len(pointer.bucket_versions) if pointer else buckets
    total = grown_buckets(pointer) if pointer else buckets
    touched = set(touched_buckets(delta, keys, total))
    columns = [*ctx.contract.columns, POSITION]
    moved = pointer is not None and retyped(ctx.contract, pointer)
    # Where the buckets of retyped keys no longer fit, all are rewritten.
    only, sources = (list(range(total)), list(range(before))) if moved else with_splits(touched, before, total)
    if pointer is None:
        state = spark.createDataFrame([], curated_ddl(ctx.contract))
    else:
        state = read_curated(spark, ctx.target_root, pointer, sources)
        if moved:
            refuse_misfits(state, ctx.contract)
        state = conformed(state, ctx.contract)
    if guard and pointer is not None:
        known = state.select(*keys, POSITION)
        if pointer.graves:
            known = known.unionByName(deleted_keys(spark, ctx.target_root, ctx.contract, list(pointer.graves)))
        delta = staged(newer_events(known, delta, keys), "newer")
    counts = delta_counts(state, delta, keys).first().asDict()
    if not touched and not moved and pointer is not None:
        return counts
    if moved or scan_bytes(delta) > broadcast_limit(spark):
        # Too large to broadcast, or keyed anew: shuffle the curated rows once, for join and write.
        state = aligned(state, keys, total)
    write_curated(
        apply_delta(state, aligned(delta, keys, total), keys, columns=columns),
        ctx.target_root,
        keys,
        run_id or ctx.run_id,
        total,
        previous=pointer,
        only=only if pointer else None,
        in_place=True,
        grown=total,
        graves=_bury(ctx, delta, pointer, horizon),
    )
    return counts
