"""What every run shares: its identity, its ledger records and its stages."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftline.contracts import Contract
from driftline.operators.checkpoint import CHECKPOINT_MEMBERS, latest_checkpoint
from driftline.operators.error_lines import broken_lines, normalize_error_lines, write_stage_errors
from driftline.operators.ledger import COUNTS, EXPECTED_TASKS, EXTRACT_STAGES, fold_runs, latest_stages
from driftline.operators.metrics import enrich_metrics
from driftline.operators.validation import ValidationFailed
from driftline.shared import file_exists, list_names, scratch_scope, stored_bytes, write_text
from driftline.sources.landing import (
    artifact_keys,
    land_accepted,
    land_errors,
    quarantine_key,
    read_error_lines,
    write_manifest,
)

_RUN_EVENT_DDL = (
    "run_id string, event string, at timestamp, pipeline_id string, strategy string, run_mode string, "
    "contract_id string, version string, checksum string, read_count bigint, insert_count bigint, "
    "update_count bigint, delete_count bigint, unchanged_count bigint, status string, "
    "metrics_json string, error_text string"
)
_STAGE_DDL = (
    "run_id string, stage_name string, pipeline_id string, strategy string, run_mode string, "
    "status string, started_at timestamp, finished_at timestamp, metrics_json string, "
    "error_text string, recorded_at timestamp"
)
_CHECKPOINT_DDL = "pipeline_id string, run_id string, checkpoint_json string, updated_at timestamp"


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


@dataclass(frozen=True)
class Ledger:
    """Append-only tables of run events, stage records and checkpoints under ``root``."""

    spark: SparkSession
    root: str

    def _append(self, table: str, row: dict[str, Any]) -> None:
        stamped = {k: v.isoformat(timespec="microseconds") if isinstance(v, datetime) else v for k, v in row.items()}
        write_text(self.spark, f"{self.root}/{table}/{uuid.uuid4().hex}.json", json.dumps(stamped))

    def _table(self, table: str, ddl: str) -> DataFrame:
        if not list_names(self.spark, f"{self.root}/{table}"):
            return self.spark.createDataFrame([], ddl)
        return self.spark.read.schema(ddl).option("mode", "FAILFAST").json(f"{self.root}/{table}")

    def add_run_event(self, **row: Any) -> None:
        self._append("run_events", row)

    def add_stage(self, **row: Any) -> None:
        self._append("stage_records", {**row, "recorded_at": utc_now()})

    def add_checkpoint(self, **row: Any) -> None:
        self._append("checkpoints", row)

    def runs(self) -> DataFrame:
        """Current row of every run, with its metrics enriched."""
        runs = fold_runs(self._table("run_events", _RUN_EVENT_DDL))
        return enrich_metrics(runs, "metrics_json")

    def stages(self) -> DataFrame:
        """Latest record of every stage, with its metrics enriched."""
        records = self._table("stage_records", _STAGE_DDL)
        latest = latest_stages(records, ["recorded_at", "status"])
        enriched = enrich_metrics(latest, "metrics_json", stage_name="stage_name")
        return enriched.select(
            "run_id", "stage_name", "status", "started_at", "finished_at", "metrics_json", "error_text"
        )

    def checkpoint(self, pipeline_id: str) -> dict[str, Any]:
        """Current checkpoint of a pipeline; empty before its first run."""
        own = self._table("checkpoints", _CHECKPOINT_DDL).filter(F.col("pipeline_id") == pipeline_id)
        row = latest_checkpoint(own).first()
        if row is None:
            return {}
        return {**json.loads(row["checkpoint_json"]), "run_id": row["run_id"], "updated_at": row["updated_at"]}


@dataclass
class RunContext:
    """One run of one pipeline."""

    spark: SparkSession
    contract: Contract
    strategy: str
    namespace: str
    name: str
    landing_root: str
    target_root: str
    ledger: Ledger
    run_mode: str = "ingest"
    run_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    results: dict[str, dict[str, Any]] = field(default_factory=dict)

    @property
    def pipeline_id(self) -> str:
        return f"{self.namespace}.{self.name}.{self.strategy}"

    @property
    def keys(self) -> dict[str, str]:
        return artifact_keys(self.strategy, self.namespace, self.name, self.run_id)

    def path(self, key: str) -> str:
        return f"{self.landing_root.rstrip('/')}/{key}"

    def start(self) -> None:
        self.ledger.add_run_event(
            run_id=self.run_id,
            event="start",
            at=utc_now(),
            pipeline_id=self.pipeline_id,
            strategy=self.strategy,
            run_mode=self.run_mode,
            contract_id=self.contract.contract_id,
            version=self.contract.version,
            checksum=self.contract.checksum,
        )

    @contextmanager
    def stage(self, name: str) -> Iterator[dict[str, Any]]:
        """Records a stage as running, then as success with the members put into the
        yielded payload, or as failed with what the failure tells."""
        started = utc_now()
        record = {
            "run_id": self.run_id,
            "stage_name": name,
            "pipeline_id": self.pipeline_id,
            "strategy": self.strategy,
            "run_mode": self.run_mode,
            "started_at": started,
        }
        self.ledger.add_stage(**record, status="running")
        payload: dict[str, Any] = {}
        try:
            yield payload
        except Exception as exc:
            told: dict[str, Any] = {
                "status": "failed",
                "exception_class": type(exc).__name__,
                "error_message": str(exc),
            }
            if isinstance(exc, ValidationFailed):
                told.update(exc.context())
                told.update(self.artifact_sizes(told))
            self.ledger.add_stage(
                **record,
                status="failed",
                finished_at=utc_now(),
                metrics_json=json.dumps(told),
                error_text=str(exc),
            )
            self.results[f"failed:{name}"] = told
            raise
        payload.update(self.artifact_sizes(payload))
        self.ledger.add_stage(
            **record, status="success", finished_at=utc_now(), metrics_json=json.dumps(payload)
        )
        self.results[name] = payload

    def artifact_sizes(self, payload: dict[str, Any]) -> dict[str, Any]:
        """Bytes of the landed artifacts that a payload names, and their sum; what is not there is left out."""
        sizes = {}
        for name, key in payload.items():
            if name.endswith(("_object_key", "_manifest_key")) and key and str(key).strip():
                size = stored_bytes(self.spark, self.path(str(key).strip()))
                if size is not None:
                    sizes[name] = size
        return {"artifact_sizes_bytes": sizes, "artifact_total_bytes": sum(sizes.values())} if sizes else {}

    def finish(
        self, status: str, counts: dict[str, Any], metrics: dict[str, Any], error_text: str | None = None
    ) -> None:
        self.ledger.add_run_event(
            run_id=self.run_id,
            event="finish",
            at=utc_now(),
            status=status,
            metrics_json=json.dumps(metrics),
            error_text=error_text,
            **{name: int(counts.get(name) or 0) for name in COUNTS},
        )

    def save_checkpoint(self, members: dict[str, Any]) -> str:
        """Stores the run's checkpoint and returns its time; nested stage results are kept as JSON objects."""
        fixed = {"status": "success", "strategy": self.strategy}
        stored = {name: {**members, **fixed}.get(name) for name in CHECKPOINT_MEMBERS[self.strategy]}
        text = json.dumps(stored, default=str)
        now = utc_now()
        self.ledger.add_checkpoint(
            pipeline_id=self.pipeline_id, run_id=self.run_id, checkpoint_json=text, updated_at=now
        )
        return now.strftime("%Y-%m-%dT%H:%M:%S.%f")

    def record_errors(self, stage_name: str, error_key: str | None) -> None:
        """Replaces the stored validation errors of a stage by those of its artifact.

        What is stored stays where there is no artifact, or one with a broken line.
        """
        if not error_key or not file_exists(self.spark, self.path(error_key)):
            return
        lines = read_error_lines(self.spark, self.path(error_key)).withColumns(
            {"run_id": F.lit(self.run_id), "stage_name": F.lit(stage_name)}
        )
        if broken_lines(lines).limit(1).count():
            return
        rows = normalize_error_lines(lines, ["run_id", "stage_name"])
        identity = F.concat_ws("/", "run_id", "stage_name", "part", F.col("line_no").cast("string"))
        full = rows.withColumns(
            {
                "error_id": F.sha2(identity, 256),
                "pipeline_id": F.lit(self.pipeline_id),
                "strategy": F.lit(self.strategy),
                "run_mode": F.lit(self.run_mode),
                "error_object_key": F.lit(error_key),
                "created_at": F.lit(utc_now()),
            }
        ).drop("part", "line_no")
        write_stage_errors(self.spark, f"{self.ledger.root}/validation_errors", full, self.run_id, stage_name)


def land_quarantined(ctx: RunContext, events: DataFrame) -> None:
    """Valid events of quarantined transactions, kept so that they can be applied once mended."""
    land_accepted(events, ctx.path(quarantine_key(ctx.strategy, ctx.namespace, ctx.name, ctx.run_id)))


def land(
    ctx: RunContext,
    accepted: DataFrame,
    errors: DataFrame,
    counts: dict[str, int],
    window: tuple[str | None, str | None] = (None, None),
    watermark_type: str | None = None,
) -> None:
    """Accepted rows, then errors, then the manifest that marks the landing complete."""
    keys = ctx.keys
    land_accepted(accepted, ctx.path(keys["accepted_key"]))
    land_errors(errors, ctx.path(keys["error_key"]))
    write_manifest(
        ctx.spark,
        ctx.path(keys["manifest_key"]),
        run_id=ctx.run_id,
        pipeline_id=ctx.pipeline_id,
        strategy=ctx.strategy,
        contract_id=ctx.contract.contract_id,
        contract_version=ctx.contract.version,
        checksum=ctx.contract.checksum,
        accepted_key=keys["accepted_key"],
        error_key=keys["error_key"],
        source_count=counts["source"],
        accepted_count=counts["accepted"],
        invalid_count=counts["invalid"],
        error_count=counts["errors"],
        window_start=window[0],
        window_end=window[1],
        schema=ctx.contract.ddl,
        watermark_type=watermark_type,
    )


@contextmanager
def recorded_run(ctx: RunContext, apply_stage: str) -> Iterator[None]:
    """Opens the run, and closes it with the outcome of its stages whatever happens."""
    ctx.start()
    with scratch_scope(ctx.spark):
        try:
            yield
        finally:
            _close(ctx, apply_stage)


def _close(ctx: RunContext, apply_stage: str) -> None:
    extract_stage = EXTRACT_STAGES[ctx.strategy]
    replay = ctx.run_mode == "replay"
    named = {"persist_checkpoint": "persist_checkpoint_task"}
    if replay:
        named[apply_stage] = f"{apply_stage}_replay"
    done = {"fetch_contract", "read_checkpoint", "start_run"} | {named.get(n, n) for n in ctx.results}
    missing = [task for task in EXPECTED_TASKS[(ctx.strategy, ctx.run_mode)] if task not in done]
    extract = ctx.results.get(extract_stage) or ctx.results.get(f"failed:{extract_stage}") or {}
    applied = ctx.results.get(apply_stage, {})
    source = extract.get("source_row_count") or extract.get("source_event_count") or 0
    error_key = extract.get("validation_error_object_key") or extract.get("error_object_key")
    metrics: dict[str, Any] = {
        "validation_error_object_key": error_key,
        "validation_manifest_key": extract.get("validation_manifest_key") or extract.get("manifest_key"),
        "checkpoint_persisted": "persist_checkpoint" in ctx.results,
        **{k: extract[k] for k in ("accepted_object_key", "delta_object_key") if extract.get(k)},
    }
    metrics.update(ctx.artifact_sizes(metrics))
    counts = {name: applied.get(name, 0) for name in COUNTS}
    if missing:
        if not replay:
            counts["read_count"] = source
        label = "Replay pipeline" if replay else "Pipeline"
        text = f"{label} failed at stages: {', '.join(missing)}"
        ctx.finish("failed", counts, {**metrics, "failed_tasks": missing}, text)
    else:
        if ctx.strategy == "logical_cdc" and not replay:
            counts["read_count"] = source or counts["read_count"]
        copied = () if ctx.strategy == "hash_diff" else _EVENT_METRICS
        ctx.finish("success", counts, {**applied, **metrics, **{k: extract.get(k) for k in copied}})
    broken = extract.get("invalid_row_count") or extract.get("invalid_event_count")
    if not replay and broken:
        ctx.record_errors(extract_stage, error_key)


# Members of the extract payload that a delta run repeats in its own metrics.
_EVENT_METRICS = (
    "source_event_count",
    "invalid_event_count",
    "invalid_transaction_count",
    "quarantined_event_count",
    "quarantined_transaction_count",
    "window_start",
    "window_end",
    "window_start_lsn",
    "window_end_lsn",
    "last_decoded_lsn",
    "last_stream_wal_end_lsn",
    "reached_window_end",
)
