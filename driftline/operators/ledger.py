"""Run and stage ledger: append-only records folded into current state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The tasks a run must finish, in pipeline order.
EXPECTED_TASKS = {
    ("hash_diff", "ingest"): (
        "fetch_contract",
        "read_checkpoint",
        "start_run",
        "extract_validate_land",
        "merge_curated",
        "persist_checkpoint_task",
    ),
    ("incremental_audit", "ingest"): (
        "fetch_contract",
        "read_checkpoint",
        "start_run",
        "ensure_source_audit_capture",
        "extract_validate_land_delta",
        "apply_delta",
        "persist_checkpoint_task",
    ),
    ("logical_cdc", "ingest"): (
        "fetch_contract",
        "read_checkpoint",
        "start_run",
        "ensure_source_logical_cdc_capture",
        "extract_validate_land_wal_delta",
        "apply_delta",
        "persist_checkpoint_task",
        "ack_replication_slot",
    ),
    ("hash_diff", "replay"): ("merge_curated_replay",),
    ("incremental_audit", "replay"): ("apply_delta_replay",),
    ("logical_cdc", "replay"): ("apply_delta_replay",),
}

# The stage that extracts, per strategy.
EXTRACT_STAGES = {
    "hash_diff": "extract_validate_land",
    "incremental_audit": "extract_validate_land_delta",
    "logical_cdc": "extract_validate_land_wal_delta",
}

_KNOWN_TASKS = sorted({task for tasks in EXPECTED_TASKS.values() for task in tasks})
_EXTRACTS = sorted(EXTRACT_STAGES.values())
_APPLIES = ["apply_delta", "merge_curated"]
_REPLAYS = ["apply_delta_replay", "merge_curated_replay"]

COUNTS = ("read_count", "insert_count", "update_count", "delete_count", "unchanged_count")

RUN_DDL = (
    "run_id string, pipeline_id string, strategy string, run_mode string, contract_id string, "
    "version string, checksum string, started_at timestamp, finished_at timestamp, "
    "read_count bigint, insert_count bigint, update_count bigint, delete_count bigint, "
    "unchanged_count bigint, status string, metrics_json string, error_text string"
)


def fold_runs(events: DataFrame) -> DataFrame:
    """Current row of each run from its ``start`` and ``finish`` records.

    A started run is ``running`` with zero counts. Later finish records overwrite
    earlier ones; a finish without a start leaves no row.
    """
    started = F.col("event") == "start"
    identity = ["pipeline_id", "strategy", "run_mode", "contract_id", "version", "checksum"]
    start = F.min_by(F.struct(*identity, F.col("at").alias("started_at")), F.when(started, F.col("at")))
    outcome = F.struct(F.col("at").alias("finished_at"), *COUNTS, "status", "metrics_json", "error_text")
    # Records of one instant are told apart by what they say.
    finish = F.max_by(outcome, F.when(F.col("event") == "finish", F.struct("at", "status", "metrics_json")))
    folded = events.groupBy("run_id").agg(start.alias("s"), finish.alias("f")).filter("s is not null")
    zero = F.lit(0).cast("bigint")
    return folded.select(
        "run_id",
        *[F.col(f"s.{c}") for c in identity],
        F.col("s.started_at"),
        F.col("f.finished_at"),
        *[F.coalesce(F.col(f"f.{c}"), zero).alias(c) for c in COUNTS],
        F.coalesce("f.status", F.lit("running")).alias("status"),
        F.col("f.metrics_json"),
        F.col("f.error_text"),
    )


def latest_stages(attempts: DataFrame, order_by: list[str]) -> DataFrame:
    """Last attempt of every stage; a retry replaces all earlier ones."""
    pair = ["run_id", "stage_name"]
    rest = [c for c in attempts.columns if c not in pair]
    last = F.max_by(F.struct(*rest), F.struct(*order_by))
    return attempts.groupBy(*pair).agg(last.alias("_last")).select(*pair, "_last.*")


def expected_tasks(strategy: Column, run_mode: Column) -> Column:
    """Expected task list of a run as an array in pipeline order."""
    tasks = F.array().cast("array<string>")
    for (name, mode), names in EXPECTED_TASKS.items():
        listed = F.array(*[F.lit(n) for n in names])
        tasks = F.when((strategy == name) & (run_mode == mode), listed).otherwise(tasks)
    return tasks


def missing_stages(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Adds ``missing``: expected tasks without a result, in pipeline order.

    Any result counts, an empty one too. The finished names of a run come from a
    fixed list, so the set per run stays tiny however often a task was recorded.
    """
    done = (
        results.filter(F.col("task_id").isin(_KNOWN_TASKS))
        .groupBy("run_id")
        .agg(F.collect_set("task_id").alias("_done"))
    )
    return runs.join(done, "run_id", "left").withColumn("missing", _missing(F.col("_done"))).drop("_done")


def _missing(done: Column) -> Column:
    finished = F.coalesce(done, F.array().cast("array<string>"))
    return F.array_except(expected_tasks(F.col("strategy"), F.col("run_mode")), finished)


def _truthy(payload: Column) -> Column:
    """A payload with members; absent and empty objects count as nothing."""
    return F.when(F.size(F.json_object_keys(payload)) > 0, payload)


def _count(payload: Column, key: str) -> Column:
    return F.get_json_object(payload, f"$.{key}").try_cast("bigint")


def run_outcomes(runs: DataFrame, results: DataFrame, stages: DataFrame, at: str) -> DataFrame:
    """Status, counts and error text each run is closed with.

    ``results`` holds one payload per finished task, ``stages`` the latest record
    of every stage. A missing task fails the run; its counts come from what did
    finish. The extract payload is the result of the strategy's extract task, else that
    stage's record. ``at`` names the time of a result: of several of one task the last
    counts, and of those of one time the one whose text is greatest.
    """
    task = F.col("task_id")
    ingest = F.col("run_mode") == "ingest"
    order = F.struct(at, "payload")

    def last(which: Column) -> Column:
        return F.max_by(F.col("payload"), F.when(which, order))

    def of_strategy(prefix: str) -> Column:
        chosen = F.lit(None).cast("string")
        for strategy, name in EXTRACT_STAGES.items():
            chosen = F.when(F.col("strategy") == strategy, F.col(f"{prefix}{name}")).otherwise(chosen)
        return _truthy(chosen)

    by_run = results.filter(task.isin(_KNOWN_TASKS)).groupBy("run_id").agg(
        F.collect_set("task_id").alias("_done"),
        *[last(task == name).alias(f"_result_{name}") for name in _EXTRACTS],
        last(task.isin(_APPLIES)).alias("_applied"),
        last(task.isin(_REPLAYS)).alias("_replayed"),
        last(task == "persist_checkpoint_task").alias("_checkpoint"),
    )
    records = (
        stages.filter(F.col("stage_name").isin(_EXTRACTS))
        .groupBy("run_id")
        .agg(*[F.max(F.when(F.col("stage_name") == n, F.col("metrics_json"))).alias(f"_record_{n}") for n in _EXTRACTS])
    )
    joined = (
        runs.select("run_id", "pipeline_id", "strategy", "run_mode")
        .join(by_run, "run_id", "left")
        .join(records, "run_id", "left")
        .withColumns(
            {
                "missing": _missing(F.col("_done")),
                "_extract_result": of_strategy("_result_"),
                "_apply": _truthy(F.when(ingest, F.col("_applied")).otherwise(F.col("_replayed"))),
            }
        )
        .withColumn("_extract", F.coalesce("_extract_result", of_strategy("_record_")))
    )
    failed = F.size("missing") > 0
    zero = F.lit(0).cast("bigint")
    source = F.when(F.col("strategy") == "hash_diff", _count(F.col("_extract"), "source_row_count")).otherwise(
        _count(F.col("_extract"), "source_event_count")
    )
    applied = _count(F.col("_apply"), "read_count")
    streamed = F.nullif(_count(F.col("_extract_result"), "source_event_count"), zero)
    read = (
        F.when(ingest & failed, source)
        .when(ingest & (F.col("strategy") == "logical_cdc"), F.coalesce(streamed, applied))
        .otherwise(applied)
    )
    names = F.array_join("missing", ", ")
    prefix = F.when(ingest, F.lit("Pipeline failed at stages: ")).otherwise(F.lit("Replay pipeline failed at stages: "))
    error_key = F.coalesce(
        F.nullif(F.get_json_object("_extract", "$.validation_error_object_key"), F.lit("")),
        F.get_json_object("_extract", "$.error_object_key"),
    )
    return joined.select(
        "run_id",
        "pipeline_id",
        "strategy",
        "run_mode",
        F.when(failed, "failed").otherwise("success").alias("status"),
        F.coalesce(read, zero).alias("read_count"),
        *[F.coalesce(_count(F.col("_apply"), c), zero).alias(c) for c in COUNTS[1:]],
        names.alias("failed_tasks"),
        _truthy(F.col("_checkpoint")).isNotNull().alias("checkpoint_persisted"),
        F.when(ingest, error_key).alias("validation_error_object_key"),
        F.when(failed, F.concat(prefix, names)).alias("error_text"),
    )


def pipeline_state(runs: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """State of each pipeline from its latest run.

    With ``previous`` a run that did not succeed keeps the stored success time.
    Without it the state is rebuilt from the whole ledger, where the last success
    is the latest successful run.
    """
    order = F.struct("started_at", "run_id")
    ended = F.coalesce("finished_at", "started_at")
    success = F.col("status") == "success"
    latest = F.max_by(F.struct("status", ended.alias("ended"), "error_text"), order)
    won = F.max_by(ended, F.when(success, order))
    folded = runs.groupBy("pipeline_id").agg(latest.alias("l"), won.alias("won"))
    succeeded = F.col("l.status") == "success"
    error = F.when(~succeeded, F.col("l.error_text"))
    rebuilt = folded.select(
        "pipeline_id",
        F.col("l.ended").alias("last_run_at"),
        F.col("won").alias("last_success_at"),
        F.col("l.status").alias("last_status"),
        error.alias("last_error"),
    )
    if previous is None:
        return rebuilt
    old = previous.select(
        "pipeline_id",
        *[F.col(c).alias(f"_{c}") for c in ("last_run_at", "last_success_at", "last_status", "last_error")],
    )
    now = F.col("last_status").isNotNull()
    return rebuilt.join(old, "pipeline_id", "full_outer").select(
        "pipeline_id",
        F.coalesce("last_run_at", "_last_run_at").alias("last_run_at"),
        F.when(F.col("last_status") == "success", F.col("last_run_at"))
        .otherwise(F.col("_last_success_at"))
        .alias("last_success_at"),
        F.coalesce("last_status", "_last_status").alias("last_status"),
        F.when(now, F.col("last_error")).otherwise(F.col("_last_error")).alias("last_error"),
    )


def backfill_runs(legacy: DataFrame) -> DataFrame:
    """Fills strategy, run mode and delete count of runs recorded before these columns.

    The underscore in the patterns is the single-character wildcard of LIKE.
    """
    metrics = F.col("metrics_json")
    pipeline = F.col("pipeline_id")
    named = F.nullif(F.get_json_object(metrics, "$.strategy"), F.lit(""))
    mode = F.coalesce(
        F.get_json_object(metrics, "$.run_mode"), F.get_json_object(metrics, "$.mode"), F.lit("")
    )
    return legacy.withColumns(
        {
            "strategy": F.when(pipeline.like("%.hash_diff"), "hash_diff")
            .when(pipeline.like("%.incremental_audit"), "incremental_audit")
            .when(pipeline.like("%.logical_cdc"), "logical_cdc")
            .otherwise(F.coalesce(named, F.lit("unknown"))),
            "run_mode": F.when(mode.like("%replay%"), "replay").otherwise("ingest"),
            "delete_count": F.coalesce(
                F.get_json_object(metrics, "$.delete_count").cast("bigint"), F.lit(0).cast("bigint")
            ),
        }
    )
