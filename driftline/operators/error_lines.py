"""Error artifacts into the validation-error table."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftline.functions.payload import member_int, member_text, members, strip, text_or_null
from driftline.shared import keyed_join, remove_path, staged, swap_folder

# Defaults of error fields that are missing or empty.
DEFAULTS = {"field": "$", "code": "validation_error", "message": "validation error"}

# A JSON string, matched without backtracking.
_STRING = r'"[^"\\\x00-\x1f]*+(?:\\.[^"\\\x00-\x1f]*+)*+"'

_MEMBERS = ("row_number", "field", "code", "message", "constraint", "actual_value")

ERROR_COLUMNS = [
    "error_id",
    "run_id",
    "pipeline_id",
    "strategy",
    "run_mode",
    "stage_name",
    "row_number",
    "field",
    "code",
    "message",
    "constraint",
    "actual_value",
    "error_object_key",
    "details_json",
    "created_at",
]


def is_json(line: Column) -> Column:
    """True when the whole text is one JSON value.

    The text is read inside an array and inside an object: what closes one early
    breaks the other. Quotes left over once all proper strings are removed mean a
    single-quoted or unfinished string, which the JSON functions alone would allow.
    """
    alone = F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1
    nested = F.json_object_keys(F.concat(F.lit('{"v":'), line, F.lit("}"))).isNotNull()
    bare = F.regexp_replace(line, _STRING, "")
    return F.coalesce(alone & nested, F.lit(False)) & ~bare.rlike("[\"']")


def error_artifact_key(payload: Column) -> Column:
    """Key of the artifact to read; NULL means nothing to read and nothing to replace."""
    return F.coalesce(
        text_or_null(F.get_json_object(payload, "$.validation_error_object_key")),
        text_or_null(F.get_json_object(payload, "$.error_object_key")),
    )


def broken_lines(lines: DataFrame, line: str = "line") -> DataFrame:
    """The lines that are neither blank nor JSON."""
    return lines.filter((strip(F.col(line)) != "") & ~is_json(strip(F.col(line))))


def normalize_error_lines(lines: DataFrame, artifact: list[str], line: str = "line") -> DataFrame:
    """Error rows of each artifact, parsed and with defaults filled in.

    Blank lines and JSON values that are not objects are passed over. One line that
    is not JSON drops its whole artifact.
    """
    read = lines.withColumn("_text", strip(F.col(line))).filter("_text != ''")
    # Only the search for broken lines checks the syntax. In an artifact without one,
    # every line that opens an object is an object.
    kept = read.filter(F.col("_text").startswith("{"))
    valid = is_json(F.col("_text"))
    dropped = read.groupBy(*artifact).agg(F.max(~valid).alias("_broken")).filter("_broken").select(*artifact)
    # Dropped artifacts are few; the lines are parsed where they were read, so an
    # artifact with most of the lines is not parsed by one task.
    kept = keyed_join(kept, staged(dropped, "broken-artifacts"), artifact, "left_anti")
    parsed = kept.withColumn("_m", members(F.col("_text"), _MEMBERS))
    texts = {f"_{name}": member_text(F.col(f"_m.{name}")) for name in _MEMBERS[1:]}
    return (
        parsed.withColumns({"row_number": member_int(F.col("_m.row_number")), **texts})
        .withColumns(
            {
                **{name: _or_default(name, default) for name, default in DEFAULTS.items()},
                "constraint": text_or_null(F.col("_constraint")),
                "actual_value": text_or_null(F.col("_actual_value")),
                "details_json": F.col("_text"),
            }
        )
        .drop("_text", "_m", line, *texts)
    )


def _or_default(name: str, default: str) -> Column:
    """Text of a member; absent, null and empty values of any type become the default."""
    text = F.col(f"_{name}")
    # These texts may stand for an empty value, unless they were JSON strings.
    hollow = text.isin("false", "[]", "{}") | (text.rlike("^-?0") & (text.try_cast("double") == 0))
    typed = F.schema_of_variant(F.col(f"_m.{name}")) != "STRING"
    empty = text.isNull() | (text == "") | (hollow & typed)
    return F.when(empty, F.lit(default)).otherwise(text)


def replace_stage_errors(table: DataFrame, rows: DataFrame, stages: DataFrame) -> DataFrame:
    """The error table after the errors of ``stages`` are replaced by ``rows``.

    ``stages`` lists the (run_id, stage_name) pairs being replaced, so a stage whose
    new error set is empty loses its old rows too.
    """
    pair = ["run_id", "stage_name"]
    gone = staged(stages.select(*pair).distinct(), "replaced-stages")
    return keyed_join(table, gone, pair, "left_anti").unionByName(rows)


def write_stage_errors(spark: SparkSession, root: str, rows: DataFrame, run_id: str, stage_name: str) -> None:
    """Replaces the stored errors of one stage of one run.

    The pair is a directory of its own, so nothing else is touched and an empty set
    leaves an empty directory. The new set is written beside it, where no reader looks,
    and moved into its place at the end: a write that fails leaves the old errors.
    Between removing the old set and the move readers see neither; a process that dies
    there leaves the new set complete in the folder beside.
    """
    drop = [c for c in ("run_id", "stage_name") if c in rows.columns]
    fresh = f"{root}/run_id={run_id}/_fresh-{uuid.uuid4().hex}"
    try:
        rows.drop(*drop).write.parquet(fresh)
    except Exception:
        remove_path(spark, fresh)
        raise
    swap_folder(spark, fresh, f"{root}/run_id={run_id}/stage_name={stage_name}")


def validation_errors(table: DataFrame) -> DataFrame:
    """Monitoring view of the error table."""
    ids = ["error_id", "run_id"]
    rest = [c for c in ERROR_COLUMNS if c not in (*ids, "created_at")]
    return table.select(
        *[F.col(c).cast("string").alias(c) for c in ids],
        *rest,
        F.col("created_at").alias("observed_at"),
    )
