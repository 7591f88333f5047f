"""Change events applied by micro-batch, with the batch operators.

Every micro-batch is a run of its own in the ledger. The transactions it completes are
validated and quarantined; accepted events, held-back events, errors and a manifest are
landed; then the delta is compacted and applied, the curated pointer names the batch, and
the position is stored. A batch that is run again after a failure finds its own name in
the pointer and does nothing. The stream's offset log commits after that, as an
acknowledgement would.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from driftline.functions.lsn import lsn_number, lsn_text
from driftline.plans.change_log import land_events, save_position
from driftline.plans.deltas import apply_compacted, last_events
from driftline.plans.run import RunContext, recorded_run
from driftline.shared import remove_path, staged
from driftline.sources.curated import read_pointer
from driftline.streaming.open_transactions import GIVEN_UP, OpenTransactions, all_closed

#: Name of the observation that tells each micro-batch's highest position.
POSITIONS = "driftline_positions"


def stream_deltas(
    ctx: RunContext,
    source: DataFrame,
    checkpoint: str,
    commit: str | None = "tx_end",
    buckets: int = 16,
    trigger: dict[str, Any] | None = None,
    patience: int | None = None,
) -> StreamingQuery:
    """Starts the continuous apply of a stream of change events.

    ``commit`` names the flag on a transaction's last event. Events of transactions
    still open at the end of a batch are held back for the batch that closes them,
    so a bad event always quarantines its transaction whole. Pass None when every
    batch holds whole transactions only. A transaction open for more than ``patience``
    batches is given up and landed with the held-back events; by default none is.

    ``ctx.results["stream"]`` holds the counts of the batches so far, added up.
    """
    held = None
    if commit is not None:
        held = OpenTransactions(ctx.spark, checkpoint, source.schema, commit, patience)
    previous: dict[str, Any] = {}

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        name = f"stream:{ctx.run_id}:{batch_id}"
        pointer = read_pointer(ctx.spark, ctx.target_root)
        if pointer is not None and _batch_of(pointer.run_id, ctx.run_id) >= batch_id:
            return
        if not previous:
            # Read once: from then on each batch knows what the one before it stored.
            previous.update(ctx.ledger.checkpoint(ctx.pipeline_id))
        run = replace(ctx, run_id=name.replace(":", "-"), results={})
        with recorded_run(run, "apply_delta"):
            _run_batch(run, batch, batch_id, held, name, buckets, previous)
        _add_up(ctx.results.setdefault("stream", {"batches": 0}), run)

    observed = source.observe(POSITIONS, F.max("lsn").alias("highest"))
    writer = observed.writeStream.foreachBatch(one_batch).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def _batch_of(pointer_run: str, run_id: str) -> int:
    head = f"stream:{run_id}:"
    return int(pointer_run[len(head) :]) if pointer_run.startswith(head) else -1


def _run_batch(
    run: RunContext,
    batch: DataFrame,
    batch_id: int,
    held: OpenTransactions | None,
    name: str,
    buckets: int,
    previous: dict[str, Any],
) -> None:
    """The stages of one micro-batch, those of a change-log run."""
    stored = previous.get("last_applied_lsn")
    start = lsn_number(stored) if stored else 0
    with run.stage("ensure_source_logical_cdc_capture") as out:
        out.update(status="skipped", reason="capture_is_set_up_at_the_source")
    with run.stage("extract_validate_land_wal_delta") as out:
        began = time.monotonic()
        # A batch that runs again lands the same rows; until then it has no commit marker.
        remove_path(run.spark, run.path(run.keys["manifest_key"]))
        if held is None:
            closed = all_closed(batch)
        else:
            closed = held.advance(batch, batch_id)
        rows = staged(closed.events, "stream-events")
        decoded = rows.agg(F.max("lsn")).first()[0]
        seen = closed.highest
        number = max(start, seen or 0)
        if closed.first_open is not None:
            number = max(start, min(number, closed.first_open - 1))
        bounds = {
            "window_start_lsn": lsn_text(start),
            "window_end_lsn": lsn_text(max(start, seen or 0)),
            "last_decoded_lsn": None if decoded is None else lsn_text(decoded),
            "last_stream_wal_end_lsn": None if seen is None else lsn_text(seen),
            "reached_window_end": True,
        }
        told, clean = land_events(run, rows, bounds, "quarantine", began, F.col(GIVEN_UP))
        out.update(told, held_piece_count=closed.pieces, given_up_transaction_count=closed.given_up)
    with run.stage("apply_delta") as out:
        began = time.monotonic()
        delta = staged(last_events(run.contract, clean, run.strategy), "stream-delta")
        out.update(apply_compacted(run, delta, buckets, run_id=name))
        out["total_seconds"] = round(time.monotonic() - began, 3)
    with run.stage("persist_checkpoint") as out:
        position, stamp = save_position(run, previous, number)
        previous.update(run_id=run.run_id, updated_at=stamp, last_applied_lsn=position)
        out.update(status="success")
    with run.stage("ack_replication_slot") as out:
        out.update(status="skipped", reason="the_stream_commits_its_own_offsets")


def _add_up(totals: dict[str, Any], run: RunContext) -> None:
    """Adds a batch's counts to those of the stream, which stay one small record."""
    totals["batches"] += 1
    totals["last_run_id"] = run.run_id
    for stage in ("extract_validate_land_wal_delta", "apply_delta"):
        for name, value in run.results[stage].items():
            if name.endswith("_count") and name != "held_piece_count":
                totals[name] = totals.get(name, 0) + (value or 0)
    totals["held_piece_count"] = run.results["extract_validate_land_wal_delta"]["held_piece_count"]


@dataclass(frozen=True)
class DrainReport:
    """How a drain went. ``reached_window_end`` is None where no window end was given;
    ``ended`` says that the query came to its own end."""

    reached_window_end: bool | None
    ended: bool
    batches: int
    input_rows: int
    highest_lsn: int | None
    seconds: float


def drain(
    query: StreamingQuery, max_seconds: float, idle_seconds: float | None = None, end_lsn: int | None = None
) -> DrainReport:
    """Waits until the query has read a position at or past ``end_lsn``, has ended, the time
    is up, or no rows have come for ``idle_seconds``; then stops it.

    The batch that passes the window end is applied whole. Positions are those that the
    query itself observes in its micro-batches.
    """
    began = time.monotonic()
    seen: dict[int, int] = {}
    highest: int | None = None
    last_change = began
    done = False
    while not done:
        left = max_seconds - (time.monotonic() - began)
        if left <= 0:
            break
        done = bool(query.awaitTermination(min(left, 0.5)))
        before = sum(seen.values())
        for progress in query.recentProgress:
            if progress["numInputRows"]:
                seen[progress["batchId"]] = progress["numInputRows"]
            told = (progress["observedMetrics"] or {}).get(POSITIONS)
            if told is not None and told["highest"] is not None:
                highest = max(highest or 0, told["highest"])
        if sum(seen.values()) != before:
            last_change = time.monotonic()
        if end_lsn is not None and highest is not None and highest >= end_lsn:
            break
        busy = query.status["isTriggerActive"]
        idle = idle_seconds is not None and not busy and time.monotonic() - last_change >= idle_seconds
        if not done and idle:
            break
    if not done:
        query.stop()
    reached = None if end_lsn is None else highest is not None and highest >= end_lsn
    return DrainReport(reached, done, len(seen), sum(seen.values()), highest, round(time.monotonic() - began, 3))
