"""Replay run: apply an already landed artifact again."""

from __future__ import annotations

from typing import Any

from pyspark.sql import functions as F

from driftline.plans.deltas import AUDIT_DDL, apply_landed, change_log_ddl
from driftline.plans.run import RunContext, recorded_run
from driftline.plans.snapshot import merge_landed
from driftline.shared import file_exists
from driftline.sources.landing import MANIFEST_FILE, REJECTED_KEYS_FILE, read_manifest


def replay(
    ctx: RunContext,
    artifact_key: str,
    buckets: int = 16,
    guard: bool = False,
    parent_run_id: str | None = None,
    reason: str | None = None,
) -> dict[str, dict[str, Any]]:
    """Merges or applies a landed artifact under the context's contract.

    The type of an audit log's clock comes from the landing's manifest, and the keys whose
    rows the landing run protected stay protected. The run's metrics say what was replayed.
    Nothing is extracted, no checkpoint is read or written, and no validation errors
    are recorded. ``guard`` keeps an old delta from overwriting newer rows.
    """
    if ctx.run_mode != "replay":
        raise ValueError("a replay needs a context with run_mode 'replay'")
    stage = "merge_curated" if ctx.strategy == "hash_diff" else "apply_delta"
    with recorded_run(ctx, stage), ctx.stage(stage) as out:
        folder = artifact_key.strip("/").rpartition("/")[0]
        manifest_key = f"{folder}/{MANIFEST_FILE}"
        out.update(
            parent_run_id=parent_run_id,
            replay_reason=reason,
            replayed_contract_version=ctx.contract.version,
            replayed_artifact_key=artifact_key,
            replayed_manifest_key=manifest_key,
        )
        if ctx.strategy == "hash_diff":
            held_path = ctx.path(f"{folder}/{REJECTED_KEYS_FILE}")
            held = None
            if file_exists(ctx.spark, held_path):
                types = {f.name: f.type for f in ctx.contract.fields}
                held = ctx.spark.read.schema(", ".join(f"`{k}` {types[k]}" for k in ctx.contract.keys)).json(held_path)
            out.update(merge_landed(ctx, artifact_key, held, buckets))
        elif ctx.strategy == "incremental_audit":
            told = None
            if file_exists(ctx.spark, ctx.path(manifest_key)):
                told = read_manifest(ctx.spark, ctx.path(manifest_key)).first()
            clock = told["watermark_type"] if told and told["watermark_type"] else "timestamp_ntz"
            ddl = f"{AUDIT_DDL}, _watermark {clock}"
            out.update(apply_landed(ctx, artifact_key, ddl, buckets, guard))
        else:
            out.update(apply_landed(ctx, artifact_key, change_log_ddl(ctx.contract), buckets, guard))
    return ctx.results


def landed_contract_version(ctx: RunContext, manifest_key: str) -> str | None:
    """Contract version a manifest names, or None for a blank one."""
    row = read_manifest(ctx.spark, ctx.path(manifest_key)).select(F.trim("contract_version").alias("v")).first()
    return row["v"] or None if row else None
