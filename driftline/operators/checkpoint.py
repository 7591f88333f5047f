"""Checkpoints: positions to continue from and what a run stores about itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from driftline.functions.lsn import format_lsn


def lsn_window(
    feed: DataFrame,
    start_lsn: Column,
    end_lsn: Column,
    own: Column,
    lsn: str = "lsn",
    by: list[str] | None = None,
) -> DataFrame:
    """Position bounds of a drained window, as text and as numbers.

    ``own`` marks the events of the ingested table. The stream end and whether the
    window end was reached look at the whole feed, before that filter.
    """
    at = F.col(lsn)
    inside = own & (at > start_lsn) & (at <= end_lsn)
    groups = feed.groupBy(*by) if by else feed.groupBy()
    bounds = groups.agg(
        F.first(start_lsn).alias("start"),
        F.first(end_lsn).alias("end"),
        F.max(F.when(inside, at)).alias("decoded"),
        F.max(at).alias("stream"),
        F.coalesce(F.max(at >= end_lsn), F.lit(False)).alias("reached_window_end"),
    )
    return bounds.select(
        *(by or []),
        format_lsn(F.col("start")).alias("window_start_lsn"),
        format_lsn(F.col("end")).alias("window_end_lsn"),
        format_lsn(F.col("decoded")).alias("last_decoded_lsn"),
        format_lsn(F.col("stream")).alias("last_stream_wal_end_lsn"),
        "reached_window_end",
    )


def resolve_checkpoint_lsn(
    runs: DataFrame, start: str = "start_lsn", end: str = "window_end_lsn", applied: str = "applied"
) -> DataFrame:
    """Adds the numeric position to store after each run: the greater of start and
    window end when the delta was applied, else the start. The flushed position
    always equals the applied one."""
    reached = F.greatest(F.col(start), F.when(F.col(applied), F.col(end)))
    return runs.withColumns({"last_applied_lsn": reached, "last_flushed_lsn": reached})


def carry_forward(window_end: Column, start: Column) -> Column:
    """The window end, or the old start when the window was empty."""
    return F.coalesce(window_end, start)


def latest_checkpoint(checkpoints: DataFrame) -> DataFrame:
    """Current checkpoint per pipeline of an append-only checkpoint table."""
    last = F.max_by(
        F.struct("run_id", "checkpoint_json", "updated_at"), F.struct("updated_at", "run_id")
    )
    stamp = F.date_format("_last.updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return (
        checkpoints.groupBy("pipeline_id")
        .agg(last.alias("_last"))
        .select("pipeline_id", "_last.run_id", "_last.checkpoint_json", stamp.alias("updated_at"))
    )


# The members of a stored checkpoint, per strategy and in order.
_COMMON_MEMBERS = (
    "status",
    "strategy",
    "pipeline_id",
    "contract_id",
    "contract_version",
    "checksum",
    "previous_checkpoint_run_id",
    "previous_checkpoint_updated_at",
    "source_table",
    "target_table_curated",
    "validation_error_object_key",
)
CHECKPOINT_MEMBERS = {
    "hash_diff": (*_COMMON_MEMBERS, "accepted_object_key", "extract_validate_land", "merge", "last_completed_run_id"),
    "incremental_audit": (
        *_COMMON_MEMBERS,
        "source_audit_table",
        "delta_object_key",
        "invalid_event_count",
        "window_start",
        "window_end",
        "last_applied_watermark",
        "watermark_mode",
        "ensure_source_audit_capture",
        "extract_validate_land_delta",
        "apply_delta",
        "last_completed_run_id",
    ),
    "logical_cdc": (
        *_COMMON_MEMBERS,
        "source_publication_name",
        "source_slot_name",
        "output_plugin",
        "delta_object_key",
        "invalid_event_count",
        "invalid_transaction_count",
        "quarantined_event_count",
        "quarantined_transaction_count",
        "last_applied_lsn",
        "last_flushed_lsn",
        "extract_validate_land_wal_delta",
        "ensure_source_logical_cdc_capture",
        "apply_delta",
        "last_completed_run_id",
    ),
}


def checkpoint_payload(runs: DataFrame, strategy: str) -> Column:
    """The stored JSON of each run, from the columns of ``runs`` that the strategy
    keeps. Members without a column are stored as null."""
    if strategy not in CHECKPOINT_MEMBERS:
        raise ValueError(f"strategy must be one of: {', '.join(CHECKPOINT_MEMBERS)}")
    fixed = {"status": F.lit("success"), "strategy": F.lit(strategy)}
    members = [
        fixed.get(name, F.col(name) if name in runs.columns else F.lit(None).cast("string")).alias(name)
        for name in CHECKPOINT_MEMBERS[strategy]
    ]
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def checkpoint_lineage(checkpoints: DataFrame, slice_unit: str = "hour") -> DataFrame:
    """Adds the run id and time of each pipeline's previous checkpoint.

    Rows are ordered within slices of time; only the last row of each slice is
    ordered across slices. A pipeline that owns a third of the history is thereby
    spread over its slices instead of being sorted by one task.
    """
    rows = checkpoints.withColumn("_slice", F.date_trunc(slice_unit, "updated_at"))
    here = F.struct("run_id", "updated_at")
    within = Window.partitionBy("pipeline_id", "_slice").orderBy("updated_at", "run_id")
    rows = rows.withColumn("_before", F.lag(here).over(within))
    ends = rows.groupBy("pipeline_id", "_slice").agg(
        F.max_by(here, F.struct("updated_at", "run_id")).alias("_end")
    )
    across = Window.partitionBy("pipeline_id").orderBy("_slice")
    carried = ends.select("pipeline_id", "_slice", F.lag("_end").over(across).alias("_carried"))
    before = F.coalesce(F.col("_before"), F.col("_carried"))
    return rows.join(carried, ["pipeline_id", "_slice"], "left").select(
        *checkpoints.columns,
        before["run_id"].alias("previous_checkpoint_run_id"),
        before["updated_at"].alias("previous_checkpoint_updated_at"),
    )
