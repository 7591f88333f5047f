"""Derived metrics of run and stage payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.functions.payload import first_int, member_text, members, number_or_null, text_or_null

_PARSED = "_parsed"
_READ = (
    "source_row_count",
    "source_event_count",
    "read_count",
    "insert_count",
    "update_count",
    "delete_count",
    "source_read_seconds",
    "total_seconds",
    "invalid_row_count",
    "invalid_event_count",
    "invalid_transaction_count",
    "quarantined_event_count",
    "quarantined_transaction_count",
    "failed_tasks",
    "validation_error_object_key",
    "error_object_key",
)

RATES = ("source_records_per_second", "processed_records_per_second", "change_ratio", "invalid_ratio")


def _parsed(payloads: DataFrame, payload: str) -> DataFrame:
    """Adds the numbers the metrics are derived from, read with one parse per payload."""
    held = payloads.withColumn(_PARSED, members(F.col(payload), _READ))
    zero = F.lit(0).cast("bigint")
    changed = zero
    for name in ("insert_count", "update_count", "delete_count"):
        changed = changed + F.coalesce(first_int(_PARSED, name), zero)
    return held.withColumns(
        {
            "_source": first_int(_PARSED, "source_row_count", "source_event_count"),
            "_read": first_int(_PARSED, "read_count"),
            "_changed": changed,
            "_invalid": first_int(_PARSED, "invalid_row_count", "invalid_event_count"),
            "_read_seconds": number_or_null(F.col(f"{_PARSED}.source_read_seconds")),
            "_total_seconds": number_or_null(F.col(f"{_PARSED}.total_seconds")),
        }
    )


def _rate_columns() -> dict[str, Column]:
    source, read, seconds = F.col("_source"), F.col("_read"), F.col("_read_seconds")
    total = F.col("_total_seconds")
    return {
        "source_records_per_second": F.when(seconds > 0, F.round(source / seconds, 3)),
        "processed_records_per_second": F.when(total > 0, F.round(read / total, 3)),
        "change_ratio": F.when(read > 0, F.round(F.col("_changed") / read, 6)),
        "invalid_ratio": F.when(source > 0, F.round(F.col("_invalid") / source, 6)),
    }


def rate_metrics(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds the four rates of each payload as columns.

    Each is NULL where its inputs are missing or not positive. Rounding goes half
    away from zero.
    """
    rates = [value.alias(name) for name, value in _rate_columns().items()]
    return _parsed(payloads, payload).select(*payloads.columns, *rates)


def _problem_struct() -> Column:
    zero = F.lit(0).cast("bigint")
    failed = F.json_array_length(F.to_json(F.col(f"{_PARSED}.failed_tasks"))).cast("bigint")
    counts = {
        "invalid_record_count": F.col("_invalid"),
        "invalid_transaction_count": first_int(_PARSED, "invalid_transaction_count"),
        "quarantined_event_count": first_int(_PARSED, "quarantined_event_count"),
        "quarantined_transaction_count": first_int(_PARSED, "quarantined_transaction_count"),
        "failed_task_count": failed,
    }
    counts = {name: F.coalesce(value, zero) for name, value in counts.items()}
    any_problem = F.lit(False)
    for value in counts.values():
        any_problem = any_problem | (value != 0)
    artifact = F.coalesce(
        text_or_null(member_text(F.col(f"{_PARSED}.validation_error_object_key"))),
        text_or_null(member_text(F.col(f"{_PARSED}.error_object_key"))),
    )
    return F.struct(
        any_problem.alias("has_problems"),
        *[value.alias(name) for name, value in counts.items()],
        artifact.alias("error_artifact_key"),
    )


def problem_summary(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """Adds ``problem_summary`` to each payload: counts of what went wrong, whether
    anything did, and where the errors are."""
    return _parsed(payloads, payload).select(*payloads.columns, _problem_struct().alias("problem_summary"))


def _members(payload: Column) -> Column:
    """All members of a payload; of members with one name the last counts."""
    pairs = F.map_entries(F.from_json(payload, "map<string,variant>"))

    def later(pair: Column, place: Column) -> Column:
        return F.exists(F.slice(pairs, place + 2, F.size(pairs)), lambda other: other["key"] == pair["key"])

    return F.map_from_entries(F.filter(pairs, lambda pair, place: ~later(pair, place)))


def enrich_metrics(
    payloads: DataFrame,
    payload: str = "payload",
    identity: tuple[str, ...] = ("strategy", "run_mode", "pipeline_id", "run_id"),
    stage_name: str | None = None,
    artifact_total: str | None = None,
) -> DataFrame:
    """Replaces each payload by its enriched form.

    Identity, rates that could be derived, the artifact total where known, and the
    problem summary are set over members of the same name. Members keep their JSON
    types. The stage name is set only when given, so a payload may bring its own.
    """
    empty = F.from_json(F.lit("{}"), "map<string,variant>")
    read = _parsed(payloads, payload).withColumns(
        {
            "_members": F.coalesce(_members(F.col(payload)), empty),
            "_summary": _problem_struct(),
            **{f"_{name}": value for name, value in _rate_columns().items()},
        }
    )
    fixed: dict[str, Column] = {name: F.col(name) for name in identity}
    if stage_name is not None:
        fixed["stage_name"] = F.col(stage_name)
    # A rate that cannot be derived leaves a member of that name as it was.
    kept = {name: F.col(f"_{name}") for name in RATES}
    if artifact_total is not None:
        kept["artifact_total_bytes"] = F.col(artifact_total)
    added = F.struct(*[value.alias(name) for name, value in {**fixed, **kept}.items()])
    # One variant object holds all that is added; absent values are dropped from it.
    read = read.withColumn("_added", F.from_json(F.to_json(added), "map<string,variant>"))
    replaced = [*fixed, "problem_summary"]
    merged = F.map_concat(
        F.map_filter(
            "_members", lambda key, _: ~key.isin(replaced) & ~F.array_contains(F.map_keys("_added"), key)
        ),
        "_added",
        F.create_map(F.lit("problem_summary"), F.to_variant_object("_summary")),
    )
    return read.withColumn(payload, F.to_json(merged)).select(*payloads.columns)
