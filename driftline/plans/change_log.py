"""Change-log run: drain decoded events, quarantine bad transactions, land and apply."""

from __future__ import annotations

import time
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from driftline.functions.lsn import lsn_number, lsn_text
from driftline.operators.checkpoint import lsn_window
from driftline.operators.validation import (
    REJECTED,
    explode_errors,
    quarantine_counts,
    quarantine_transactions,
    validate,
    validation_counts,
    validation_gate,
)
from driftline.plans.deltas import apply_landed, change_log_ddl
from driftline.plans.run import RunContext, land, land_quarantined, recorded_run
from driftline.shared import keyed_join, staged
from driftline.sources.landing import quarantine_key
from driftline.sources.scan import change_event_scan


_HELD_COUNTS = (
    "invalid_event_count",
    "invalid_transaction_count",
    "quarantined_event_count",
    "quarantined_transaction_count",
)


def ingest_change_log(
    ctx: RunContext,
    feed: DataFrame,
    end_lsn: int | None = None,
    table: str | None = None,
    policy: str = "quarantine",
    buckets: int = 16,
    source_table: str | None = None,
    publication: str | None = None,
    slot: str | None = None,
    commit: str | None = None,
) -> dict[str, dict[str, Any]]:
    """Runs the change-log strategy once: events after the stored position, up to
    ``end_lsn``, by default the highest position of the feed when the run starts.

    ``commit`` names the flag on a transaction's last event. With it, events of
    transactions that the window cuts are left for a later run, and the stored position
    stays before them. Without it a given window end that cuts a transaction is refused.
    The feed has lsn, xid, seq, op, the contract's columns and the old key columns with
    the prefix ``old_``.
    """
    contract = ctx.contract
    with recorded_run(ctx, "apply_delta"):
        previous = ctx.ledger.checkpoint(ctx.pipeline_id)
        stored = previous.get("last_applied_lsn")
        start = lsn_number(stored) if stored else None
        with ctx.stage("ensure_source_logical_cdc_capture") as out:
            out.update(status="skipped", reason="capture_is_set_up_at_the_source")
        with ctx.stage("extract_validate_land_wal_delta") as out:
            began = time.monotonic()
            own = F.lit(True) if table is None else F.col("source_table") == table
            # Only events after the stored position are read at all.
            fresh = feed if start is None else feed.filter(F.col("lsn") > start)
            if end_lsn is not None and commit is None:
                _refuse_cut(fresh, end_lsn)
            if end_lsn is None:
                end_lsn = fresh.agg(F.max("lsn")).first()[0] or start or 0
            # Bounds before rows: once the feed has passed the window end, a later
            # read holds every event of the window.
            bounds = lsn_window(fresh, F.lit(start or 0).cast("bigint"), F.lit(end_lsn), own).first()
            inside = fresh.filter(F.col("lsn") <= end_lsn)
            old = [f"old_{k}" for k in contract.keys]
            events = change_event_scan(inside, contract, start, table, keep=("xid", "seq", "op", *old))
            held_from = None
            if commit is not None:
                events, held_from = _whole_transactions(events, inside, commit)
            rows = staged(events, "change-window")
            highest = rows.agg(F.max("lsn").alias("m")).first()["m"]
            out.update(land_events(ctx, rows, bounds.asDict(), policy, began)[0])
        with ctx.stage("apply_delta") as out:
            out.update(apply_landed(ctx, ctx.keys["accepted_key"], change_log_ddl(contract), buckets))
        with ctx.stage("persist_checkpoint") as out:
            reached = end_lsn if bounds["reached_window_end"] else 0
            number = max(start or 0, highest or 0, reached)
            if held_from is not None:
                number = max(start or 0, min(number, held_from - 1))
            save_position(
                ctx,
                previous,
                number,
                source_table=source_table,
                source_publication_name=publication,
                source_slot_name=slot,
            )
            out.update(status="success")
        with ctx.stage("ack_replication_slot") as out:
            out.update(status="skipped", reason="positions_are_kept_in_the_checkpoint")
    return ctx.results


def land_events(
    ctx: RunContext,
    rows: DataFrame,
    bounds: dict[str, Any],
    policy: str,
    began: float,
    given_up: Column | None = None,
) -> tuple[dict[str, Any], DataFrame]:
    """Validates staged events and lands them, held-back ones apart, then the manifest.

    ``given_up`` marks events to be held back although they are valid. Returns what the
    extract stage records, and the accepted events.
    """
    contract, keys = ctx.contract, ctx.keys
    columns = ["lsn", "seq", "xid", "op", *[f"old_{k}" for k in contract.keys], *contract.columns]
    checked = validate(
        rows, contract, row_number=F.col("seq"), unique_keys=False, rules_when=F.col("op") != "D", op="op"
    )
    invalid = F.col(REJECTED)
    marked = quarantine_transactions(checked, invalid)
    if given_up is not None:
        marked = marked.withColumn("_quarantined", F.col("_quarantined") | given_up)
    marked = staged(marked, "quarantine")
    counts = validation_counts(marked, "event").first()
    held = quarantine_counts(marked, invalid).first().asDict()
    clean = marked.filter(~F.col("_quarantined"))
    land_quarantined(ctx, marked.filter(F.col("_quarantined") & ~invalid).select(*columns))
    land(
        ctx,
        clean.select(*columns),
        explode_errors(marked.filter(invalid)),
        {
            "source": counts["source_event_count"],
            "accepted": counts["source_event_count"] - held["quarantined_event_count"],
            "invalid": counts["invalid_event_count"],
            "errors": counts["error_count"],
        },
        (bounds["window_start_lsn"], bounds["window_end_lsn"]),
    )
    validation_gate(
        counts["invalid_event_count"],
        policy,
        error_object_key=keys["error_key"],
        manifest_key=keys["manifest_key"],
        delta_object_key=keys["accepted_key"],
        **held,
    )
    told = {
        "source_event_count": counts["source_event_count"],
        "delta_object_key": keys["accepted_key"],
        "error_object_key": keys["error_key"],
        "quarantined_object_key": quarantine_key(ctx.strategy, ctx.namespace, ctx.name, ctx.run_id),
        "manifest_key": keys["manifest_key"],
        "source_read_seconds": round(time.monotonic() - began, 3),
        **held,
        **bounds,
    }
    return told, clean


def save_position(ctx: RunContext, previous: dict[str, Any], number: int, **source: Any) -> tuple[str | None, str]:
    """Stores the run's checkpoint, with the position up to which everything is applied.

    Returns the position and the checkpoint's time.
    """
    extract = ctx.results["extract_validate_land_wal_delta"]
    position = lsn_text(number) if number else None
    stamp = ctx.save_checkpoint(
        {
            "pipeline_id": ctx.pipeline_id,
            "contract_id": ctx.contract.contract_id,
            "contract_version": ctx.contract.version,
            "checksum": ctx.contract.checksum,
            "previous_checkpoint_run_id": previous.get("run_id"),
            "previous_checkpoint_updated_at": previous.get("updated_at"),
            "output_plugin": "pgoutput",
            "target_table_curated": ctx.target_root,
            "delta_object_key": ctx.keys["accepted_key"],
            "validation_error_object_key": ctx.keys["error_key"],
            **{name: extract[name] for name in _HELD_COUNTS},
            "last_applied_lsn": position,
            "last_flushed_lsn": position,
            "extract_validate_land_wal_delta": extract,
            "ensure_source_logical_cdc_capture": ctx.results["ensure_source_logical_cdc_capture"],
            "apply_delta": ctx.results["apply_delta"],
            "last_completed_run_id": ctx.run_id,
            **source,
        }
    )
    return position, stamp


def _whole_transactions(events: DataFrame, window: DataFrame, commit: str) -> tuple[DataFrame, int | None]:
    """Events of transactions that end inside the window, and the first position of any other."""
    ended = staged(window.filter(F.col(commit) & F.col("xid").isNotNull()).select("xid").distinct(), "ended")
    known = staged(events, "window-events")
    grouped = known.filter("xid IS NOT NULL")
    first = keyed_join(grouped, ended, ["xid"], "left_anti").agg(F.min("lsn")).first()[0]
    whole = keyed_join(grouped, ended, ["xid"], "left_semi").select(*known.columns)
    return whole.unionByName(known.filter("xid IS NULL")), first


def _refuse_cut(feed: DataFrame, end_lsn: int) -> None:
    """Fails where the feed already holds events of one transaction on both sides of the window end."""
    sides = feed.filter("xid IS NOT NULL").groupBy("xid").agg(F.min("lsn").alias("a"), F.max("lsn").alias("b"))
    cut = sides.filter((F.col("a") <= end_lsn) & (F.col("b") > end_lsn)).count()
    if cut:
        raise ValueError(f"the window end {lsn_text(end_lsn)} cuts {cut} transactions; name their commit flag or move it")
