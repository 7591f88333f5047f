"""Snapshot run: validate and land the whole table, then merge it by hash-diff."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import DataFrame, functions as F

from driftline.functions.hashing import row_hash
from driftline.operators.diff import ROW_HASH, RUN_ID, merge_counts, merge_snapshot, protected_rows
from driftline.operators.validation import (
    explode_errors,
    split_accepted,
    validate,
    validation_counts,
    validation_gate,
)
from driftline.plans.deltas import refuse_misfits, retyped
from driftline.plans.run import RunContext, land, recorded_run
from driftline.shared import staged
from driftline.sources.curated import (
    Pointer,
    aligned,
    bucket_digests,
    bucket_of,
    grown_buckets,
    read_curated,
    read_pointer,
    touched_buckets,
    with_splits,
    write_curated,
)
from driftline.sources.landing import land_accepted, read_landed, rejected_keys_key


def ingest_snapshot(
    ctx: RunContext,
    source: DataFrame,
    policy: str = "quarantine",
    protect_rejected: bool = True,
    buckets: int = 16,
    source_table: str | None = None,
) -> dict[str, dict[str, Any]]:
    """Runs the snapshot strategy once and returns the payloads of its stages.

    ``source`` is read once: the validated rows are staged, and counts, accepted
    rows and errors are all taken from there.
    """
    with recorded_run(ctx, "merge_curated"):
        previous = ctx.ledger.checkpoint(ctx.pipeline_id)
        with ctx.stage("extract_validate_land") as out:
            began = time.monotonic()
            rows = staged(source.select(*ctx.contract.columns), "snapshot")
            checked = staged(validate(rows, ctx.contract), "validated")
            accepted, rejected = split_accepted(checked)
            counts = validation_counts(checked).first()
            some = protect_rejected and counts["invalid_row_count"] > 0
            held = rejected.select(*ctx.contract.keys).dropna().distinct() if some else None
            if held is not None:
                land_accepted(held, ctx.path(rejected_keys_key(ctx.strategy, ctx.namespace, ctx.name, ctx.run_id)))
            land(
                ctx,
                accepted.select(*ctx.contract.columns),
                explode_errors(rejected),
                {
                    "source": counts["source_row_count"],
                    "accepted": counts["accepted_row_count"],
                    "invalid": counts["invalid_row_count"],
                    "errors": counts["error_count"],
                },
            )
            keys = ctx.keys
            validation_gate(
                counts["invalid_row_count"],
                policy,
                error_object_key=keys["error_key"],
                manifest_key=keys["manifest_key"],
                accepted_object_key=keys["accepted_key"],
                invalid_row_count=counts["invalid_row_count"],
            )
            out.update(
                source_row_count=counts["source_row_count"],
                invalid_row_count=counts["invalid_row_count"],
                accepted_object_key=keys["accepted_key"],
                error_object_key=keys["error_key"],
                manifest_key=keys["manifest_key"],
                source_read_seconds=round(time.monotonic() - began, 3),
            )
        with ctx.stage("merge_curated") as out:
            out.update(merge_landed(ctx, keys["accepted_key"], held, buckets))
        with ctx.stage("persist_checkpoint") as out:
            ctx.save_checkpoint(
                {
                    "pipeline_id": ctx.pipeline_id,
                    "contract_id": ctx.contract.contract_id,
                    "contract_version": ctx.contract.version,
                    "checksum": ctx.contract.checksum,
                    "previous_checkpoint_run_id": previous.get("run_id"),
                    "previous_checkpoint_updated_at": previous.get("updated_at"),
                    "source_table": source_table,
                    "target_table_curated": ctx.target_root,
                    "validation_error_object_key": keys["error_key"],
                    "accepted_object_key": keys["accepted_key"],
                    "extract_validate_land": ctx.results["extract_validate_land"],
                    "merge": ctx.results["merge_curated"],
                    "last_completed_run_id": ctx.run_id,
                }
            )
            out.update(status="success")
    return ctx.results


def merge_landed(
    ctx: RunContext, accepted_key: str, rejected: DataFrame | None = None, buckets: int = 16
) -> dict[str, Any]:
    """Merges a landed snapshot into the curated table and counts what changed.

    Digests of the snapshot's buckets are compared with those in the pointer first; only
    buckets that differ, or that are split, are read, joined and rewritten. A table that did
    not change gets no new version. Rows keep the change mark of the run that wrote their bucket.

    The counts are read back from the buckets just written, so a recomputed task cannot
    count a row twice. Fingerprints stored under another contract or method are not
    compared; the curated columns are hashed again and every bucket is rewritten.
    """
    spark, keys = ctx.spark, list(ctx.contract.keys)
    began = time.monotonic()
    pointer = read_pointer(spark, ctx.target_root)
    landed = read_landed(spark, ctx.path(accepted_key), ctx.contract)
    tag = _hash_tag(ctx)
    total, only, sources = buckets, None, None
    if pointer is not None:
        before = len(pointer.bucket_versions)
        total = grown_buckets(pointer)
        if pointer.hash_tag == tag and pointer.bucket_digests:
            values = [c for c in ctx.contract.columns if c not in keys] or keys
            marked = landed.select(*keys, row_hash(landed, values).alias(ROW_HASH))
            digests = bucket_digests(marked, keys, ROW_HASH, total)
            apart = {b for b, d in enumerate(digests) if b >= before or d != pointer.bucket_digests[b]}
            only, sources = with_splits(apart, before, total)
    compared = time.monotonic()
    held_back = 0
    if only is not None:
        held_back = sum(n for b, n in enumerate(pointer.bucket_rows) if b not in set(sources))
        if len(only) < total:
            landed = landed.filter(bucket_of(keys, total).isin(only))
    counts = dict.fromkeys(("read_count", "insert_count", "update_count", "delete_count", "unchanged_count", "protected_count"), 0)
    written_bytes = 0
    if only is None or only:
        curated = _comparable(ctx, pointer, sources)
        # The one shuffle of whole rows: the join and the bucketed write both keep it.
        merged = merge_snapshot(aligned(landed, keys, total), curated, keys, ctx.run_id)
        if rejected is not None and pointer is not None:
            lost = sources
            if not retyped(ctx.contract, pointer):
                near = touched_buckets(rejected.dropna("any", subset=keys), keys, len(pointer.bucket_versions))
                lost = sorted(set(near) & set(sources)) if sources is not None else near
            else:
                refuse_misfits(read_curated(spark, ctx.target_root, pointer), ctx.contract, rejected)
            merged = merged.unionByName(protected_rows(landed, _comparable(ctx, pointer, lost), keys, rejected))
        written = write_curated(
            merged, ctx.target_root, keys, ctx.run_id, total, tag, pointer, only=only, in_place=True, grown=total, fingerprint=ROW_HASH
        )
        rewritten = range(total) if only is None else only
        written_bytes = sum(written.bucket_bytes[b] for b in rewritten)
        before_rows = (pointer.row_count if pointer else 0) - held_back
        counts = merge_counts(read_curated(spark, ctx.target_root, written, list(rewritten)), before_rows).first().asDict()
    counts["read_count"] += held_back
    counts["unchanged_count"] += held_back
    ended = time.monotonic()
    counts.update(
        diff_seconds=round(compared - began, 3),
        write_seconds=round(ended - compared, 3),
        total_seconds=round(ended - began, 3),
        processed_batches=total if only is None else len(only),
        written_bytes=written_bytes,
    )
    return counts


def _hash_tag(ctx: RunContext) -> str:
    return f"xxh128:{ctx.contract.checksum}"


def _comparable(ctx: RunContext, pointer: Pointer | None, buckets: list[int] | None = None) -> DataFrame | None:
    """Curated rows, with stored fingerprints only if they were made the same way."""
    if pointer is None:
        return None
    curated = read_curated(ctx.spark, ctx.target_root, pointer, buckets)
    if pointer.hash_tag == _hash_tag(ctx):
        return curated
    columns = [
        F.col(f"`{f.name}`").try_cast(f.type).alias(f.name)
        if f.name in curated.columns
        else F.lit(None).cast(f.type).alias(f.name)
        for f in ctx.contract.fields
    ]
    return curated.select(*columns, *[c for c in (RUN_ID,) if c in curated.columns])


def current_rows(ctx: RunContext) -> DataFrame | None:
    """The curated table without its bookkeeping columns."""
    state = read_curated(ctx.spark, ctx.target_root)
    return None if state is None else state.select(*ctx.contract.columns)
