"""Audit-log run: extract a watermark window, validate, land and apply it."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from driftline.operators.delta import (
    WATERMARK,
    extract_delta,
    resolve_watermark_mode,
    watermark_column,
    window_bounds,
)
from driftline.operators.validation import (
    explode_errors,
    split_accepted,
    validate,
    validation_counts,
    validation_gate,
)
from driftline.plans.deltas import AUDIT_DDL, apply_landed
from driftline.plans.run import RunContext, land, recorded_run
from driftline.shared import staged


def ingest_audit_log(
    ctx: RunContext,
    source: DataFrame,
    watermark_mode: str = "auto",
    policy: str = "quarantine",
    overlap: Column | None = None,
    buckets: int = 16,
    source_table: str | None = None,
    source_audit_table: str | None = None,
    horizon: int | None = None,
) -> dict[str, dict[str, Any]]:
    """Runs the audit-log strategy once: everything after the stored watermark.

    With ``overlap`` a margin before the watermark is read again; the position guard keeps it
    from overwriting newer rows and from bringing back rows deleted since. Positions of
    deleted keys are kept for ``horizon`` microseconds of the clock, by default for ever.
    """
    with recorded_run(ctx, "apply_delta"):
        previous = ctx.ledger.checkpoint(ctx.pipeline_id)
        stored = previous.get("last_applied_watermark")
        with ctx.stage("ensure_source_audit_capture") as out:
            out.update(status="skipped", reason="capture_is_set_up_at_the_source")
        with ctx.stage("extract_validate_land_delta") as out:
            began = time.monotonic()
            looked = source
            if stored and previous.get("watermark_mode"):
                # Rows up to the watermark are done with; of later ones only those without a clock matter here.
                looked = source.filter(F.col(previous["watermark_mode"]).isNull() & (F.col("audit_id") > stored["id"]))
            mode = resolve_watermark_mode(looked, watermark_mode, previous.get("watermark_mode"))
            clocked = watermark_column(source, mode)
            clock = dict(clocked.dtypes)[WATERMARK]
            start = (F.lit(stored["ts"]).cast(clock), stored["id"]) if stored else None
            window = extract_delta(clocked, start, overlap=overlap)
            rows = staged(
                window.select("audit_id", "op", WATERMARK, *ctx.contract.columns), "audit-window"
            )
            bounds = _texts(window_bounds(rows), clock).first()
            checked = staged(
                validate(
                    rows,
                    ctx.contract,
                    row_number=F.col("audit_id"),
                    unique_keys=False,
                    rules_when=F.col("op") != "D",
                    op="op",
                ),
                "validated",
            )
            accepted, rejected = split_accepted(checked)
            counts = validation_counts(checked, "event").first()
            first, last = bounds["window_start"], bounds["window_end"]
            land(
                ctx,
                accepted.select("audit_id", "op", WATERMARK, *ctx.contract.columns),
                explode_errors(rejected),
                {
                    "source": counts["source_event_count"],
                    "accepted": counts["accepted_event_count"],
                    "invalid": counts["invalid_event_count"],
                    "errors": counts["error_count"],
                },
                (first, last),
                clock,
            )
            keys = ctx.keys
            validation_gate(
                counts["invalid_event_count"],
                policy,
                error_object_key=keys["error_key"],
                manifest_key=keys["manifest_key"],
                delta_object_key=keys["accepted_key"],
                invalid_event_count=counts["invalid_event_count"],
            )
            end = {"mode": mode, "ts": last, "id": bounds["window_end_id"]} if last else None
            out.update(
                source_event_count=counts["source_event_count"],
                invalid_event_count=counts["invalid_event_count"],
                delta_object_key=keys["accepted_key"],
                error_object_key=keys["error_key"],
                manifest_key=keys["manifest_key"],
                window_start=first,
                window_end=last,
                watermark_mode=mode,
                source_read_seconds=round(time.monotonic() - began, 3),
            )
        with ctx.stage("apply_delta") as out:
            guard = overlap is not None
            ddl = f"{AUDIT_DDL}, {WATERMARK} {clock}"
            out.update(apply_landed(ctx, keys["accepted_key"], ddl, buckets, guard, horizon))
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
                    "source_audit_table": source_audit_table,
                    "target_table_curated": ctx.target_root,
                    "delta_object_key": keys["accepted_key"],
                    "validation_error_object_key": keys["error_key"],
                    "invalid_event_count": counts["invalid_event_count"],
                    "window_start": first,
                    "window_end": last,
                    # An empty window carries the old watermark forward.
                    "last_applied_watermark": end or stored,
                    "watermark_mode": mode,
                    "ensure_source_audit_capture": ctx.results["ensure_source_audit_capture"],
                    "extract_validate_land_delta": ctx.results["extract_validate_land_delta"],
                    "apply_delta": ctx.results["apply_delta"],
                    "last_completed_run_id": ctx.run_id,
                }
            )
            out.update(status="success")
    return ctx.results


def _texts(bounds: DataFrame, clock: str) -> DataFrame:
    """Window times as text that reads back as the same time in any session zone."""
    for name in ("window_start", "window_end"):
        time_of = F.col(name)
        if clock == "timestamp":
            time_of = F.date_format(time_of, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        bounds = bounds.withColumn(name, time_of.cast("string"))
    return bounds
