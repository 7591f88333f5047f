"""Monitoring queries over the ledger."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.functions.timing import seconds_between

_PROBLEMS = (
    "invalid_record_count",
    "invalid_transaction_count",
    "quarantined_event_count",
    "quarantined_transaction_count",
)

PROBLEM_COLUMNS = (
    "run_id",
    "pipeline_id",
    "strategy",
    "run_mode",
    "stage_name",
    "observed_at",
    "scope",
    "problem_type",
    "problem_count",
    "error_artifact_key",
    "error_text",
)

# The payload members the views read. One parse per row serves all of them; values
# stay text until the strict casts below.
_METRICS_DDL = (
    f"problem_summary struct<{', '.join(f'{p}: string' for p in _PROBLEMS)}>, "
    "source_row_count string, source_event_count string, "
    "invalid_row_count string, invalid_event_count string, invalid_transaction_count string, "
    "quarantined_event_count string, quarantined_transaction_count string, "
    "artifact_total_bytes string, validation_error_object_key string, error_object_key string"
)


def _with_metrics(rows: DataFrame) -> DataFrame:
    return rows.withColumn("_m", F.from_json("metrics_json", _METRICS_DDL))


def _first_count(*members: str) -> Column:
    """First member that is present, else 0. Text that is not an integer is an error."""
    return F.coalesce(*[F.col(f"_m.{m}").cast("bigint") for m in members], F.lit(0).cast("bigint"))


def _problem_columns() -> list[Column]:
    chains = {
        "invalid_record_count": ("invalid_row_count", "invalid_event_count"),
        "invalid_transaction_count": ("invalid_transaction_count",),
        "quarantined_event_count": ("quarantined_event_count",),
        "quarantined_transaction_count": ("quarantined_transaction_count",),
    }
    counts = [
        _first_count(f"problem_summary.{name}", *fallbacks).alias(name) for name, fallbacks in chains.items()
    ]
    return counts


def _error_artifact() -> Column:
    key = F.coalesce("_m.validation_error_object_key", "_m.error_object_key")
    return key.alias("error_artifact_key")


def run_metrics(runs: DataFrame) -> DataFrame:
    """One row per run with its duration and the counts of its metrics."""
    return _with_metrics(runs).select(
        F.col("run_id").cast("string").alias("run_id"),
        "pipeline_id",
        "strategy",
        "run_mode",
        "contract_id",
        F.col("version").alias("contract_version"),
        "checksum",
        "started_at",
        "finished_at",
        seconds_between(F.col("started_at"), F.col("finished_at")).alias("run_duration_seconds"),
        "read_count",
        "insert_count",
        "update_count",
        "delete_count",
        "unchanged_count",
        "status",
        "metrics_json",
        "error_text",
        _first_count("source_row_count", "source_event_count").alias("source_input_count"),
        *_problem_columns(),
        _first_count("artifact_total_bytes").alias("artifact_total_bytes"),
        _error_artifact(),
    )


def stage_metrics(stages: DataFrame, runs: DataFrame) -> DataFrame:
    """One row per stage of a known run; stages without a run disappear."""
    owner = runs.select(
        "run_id", "pipeline_id", "strategy", "run_mode", "contract_id", F.col("version").alias("contract_version")
    )
    return (
        _with_metrics(stages)
        .join(owner, "run_id")
        .select(
            F.col("run_id").cast("string").alias("run_id"),
            "pipeline_id",
            "strategy",
            "run_mode",
            "contract_id",
            "contract_version",
            "stage_name",
            "status",
            "started_at",
            "finished_at",
            seconds_between(F.col("started_at"), F.col("finished_at")).alias("stage_duration_seconds"),
            "metrics_json",
            "error_text",
            _first_count("artifact_total_bytes").alias("artifact_total_bytes"),
            *_problem_columns(),
            _error_artifact(),
        )
    )


def pipeline_health(state: DataFrame, runs: DataFrame, as_of: Column) -> DataFrame:
    """State and latest run of each pipeline, with the seconds since its last run and
    last success as of a given time."""
    latest = F.max_by(F.struct("run_id", "strategy", "run_mode"), F.struct("started_at", "run_id"))
    newest = runs.groupBy("pipeline_id").agg(latest.alias("_r"))
    return state.join(newest, "pipeline_id", "left").select(
        "pipeline_id",
        F.col("_r.run_id").cast("string").alias("last_run_id"),
        "_r.strategy",
        "_r.run_mode",
        "last_run_at",
        "last_success_at",
        "last_status",
        "last_error",
        seconds_between(F.col("last_run_at"), as_of).alias("seconds_since_last_run"),
        seconds_between(F.col("last_success_at"), as_of).alias("seconds_since_last_success"),
    )


def problems(run_rows: DataFrame, stage_rows: DataFrame) -> DataFrame:
    """Runs and stages with problems, over the two metric views.

    The type is the gravest problem; the count is the greatest one, not the sum.
    """
    of_runs = _problem_rows(run_rows, "run", F.lit(None).cast("string"), F.col("started_at"))
    of_stages = _problem_rows(
        stage_rows, "stage", F.col("stage_name"), F.coalesce("finished_at", "started_at")
    )
    return of_runs.unionAll(of_stages)


def _problem_rows(rows: DataFrame, scope: str, stage: Column, observed: Column) -> DataFrame:
    failed = F.col("status") == "failed"
    some = failed
    for name in _PROBLEMS:
        some = some | (F.col(name) > 0)
    kind = (
        F.when(failed, f"{scope}_failure")
        .when(F.col("invalid_transaction_count") > 0, "invalid_transactions")
        .when(F.col("quarantined_transaction_count") > 0, "quarantined_transactions")
        .when(F.col("invalid_record_count") > 0, "invalid_records")
        .when(F.col("quarantined_event_count") > 0, "quarantined_events")
        .otherwise("none")
    )
    as_count = F.when(failed, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
    # A row without problems yields an empty list. As a plain filter, the condition
    # would be pushed below the parsed metrics and parse them once more per count.
    found = F.struct(
        kind.alias("problem_type"),
        F.greatest(as_count, *_PROBLEMS).alias("problem_count"),
        F.col("error_artifact_key").alias("error_artifact_key"),
    )
    return rows.select(
        "run_id",
        "pipeline_id",
        "strategy",
        "run_mode",
        stage.alias("stage_name"),
        observed.alias("observed_at"),
        F.lit(scope).alias("scope"),
        "error_text",
        F.inline(F.when(some, F.array(found))),
    ).select(*PROBLEM_COLUMNS)
