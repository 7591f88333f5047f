"""Landed artifacts: gzip JSON lines for accepted rows and errors, and a manifest.

An artifact key names a directory of part files. The manifest is written last and
serves as the commit marker of the landing.
"""

from __future__ import annotations

import json
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftline.contracts import Contract
from driftline.functions.payload import strip
from driftline.shared import write_text

# Directory and file names of the three strategies' artifacts.
LAYOUT = {
    "hash_diff": ("accepted", "accepted_snapshot.ndjson.gz"),
    "incremental_audit": ("delta", "accepted_delta.ndjson.gz"),
    "logical_cdc": ("wal_delta", "accepted_delta.ndjson.gz"),
}
ERRORS_FILE = "errors.ndjson.gz"
MANIFEST_FILE = "manifest.json"
REJECTED_KEYS_FILE = "rejected_keys.ndjson.gz"

# Microseconds survive the round trip; the JSON writer's default keeps milliseconds.
_TIME_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "dateFormat": "yyyy-MM-dd",
}

ERROR_DDL = (
    "row_number bigint, field string, code string, message string, "
    "`constraint` string, actual_value string"
)

MANIFEST_DDL = (
    "run_id string, pipeline_id string, strategy string, contract_id string, "
    "contract_version string, checksum string, accepted_key string, error_key string, "
    "source_count bigint, accepted_count bigint, invalid_count bigint, error_count bigint, "
    "window_start string, window_end string, schema string, watermark_type string"
)


def artifact_keys(strategy: str, namespace: str, name: str, run_id: str) -> dict[str, str]:
    """The three artifact keys of one run."""
    if strategy not in LAYOUT:
        raise ValueError(f"strategy must be one of: {', '.join(LAYOUT)}")
    folder, accepted = LAYOUT[strategy]
    base = f"{namespace}/{name}/run_id={run_id}/{folder}"
    return {
        "accepted_key": f"{base}/{accepted}",
        "error_key": f"{base}/{ERRORS_FILE}",
        "manifest_key": f"{base}/{MANIFEST_FILE}",
    }


def quarantine_key(strategy: str, namespace: str, name: str, run_id: str) -> str:
    """Key of the valid events that a run held back with their transactions."""
    folder = artifact_keys(strategy, namespace, name, run_id)["manifest_key"].rpartition("/")[0]
    return f"{folder}/quarantined.ndjson.gz"


def rejected_keys_key(strategy: str, namespace: str, name: str, run_id: str) -> str:
    """Key of the keys whose rows a snapshot run rejected and left as they were."""
    folder = artifact_keys(strategy, namespace, name, run_id)["manifest_key"].rpartition("/")[0]
    return f"{folder}/{REJECTED_KEYS_FILE}"


def with_artifact_keys(
    runs: DataFrame,
    namespace: str = "namespace",
    name: str = "name",
    run_id: str = "run_id",
    strategy: str = "strategy",
) -> DataFrame:
    """Adds the artifact keys to a table of runs; unknown strategies get NULL."""
    folder: Column = F.lit(None).cast("string")
    accepted: Column = F.lit(None).cast("string")
    for label, (directory, file) in LAYOUT.items():
        folder = F.when(F.col(strategy) == label, F.lit(directory)).otherwise(folder)
        accepted = F.when(F.col(strategy) == label, F.lit(file)).otherwise(accepted)
    base = F.concat(
        F.col(namespace), F.lit("/"), F.col(name), F.lit("/run_id="), F.col(run_id), F.lit("/"), folder, F.lit("/")
    )
    return runs.withColumns(
        {
            "accepted_key": F.concat(base, accepted),
            "error_key": F.concat(base, F.lit(ERRORS_FILE)),
            "manifest_key": F.concat(base, F.lit(MANIFEST_FILE)),
        }
    )


def land_accepted(df: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """Accepted records as gzip JSON lines. A gzip part cannot be split by readers,
    so ``rows_per_file`` bounds the parts of large landings."""
    _write_lines(df, path, rows_per_file)


def land_errors(errors: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """One JSON line per violation."""
    _write_lines(errors, path, rows_per_file)


def _write_lines(df: DataFrame, path: str, rows_per_file: int) -> None:
    (
        df.write.mode("overwrite")
        .options(compression="gzip", ignoreNullFields="false", maxRecordsPerFile=rows_per_file, **_TIME_FORMATS)
        .json(path)
    )


def read_landed(spark: SparkSession, path: str, contract: Contract, extra_ddl: str = "") -> DataFrame:
    """A landed artifact under the contract's schema; broken lines fail the read."""
    ddl = f"{extra_ddl}, {contract.ddl}" if extra_ddl else contract.ddl
    return spark.read.schema(ddl).options(mode="FAILFAST", **_TIME_FORMATS).json(path)


def read_error_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines of error artifacts with their place: part file and line within it.

    Part files are gzip and so are read whole, in order, by one task each.
    """
    # The partition number and the running id share one scan task per gzip part.
    return spark.read.text(path).select(
        F.col("_metadata.file_name").alias("part"),
        F.monotonically_increasing_id().alias("line_no"),
        F.col("value").alias("line"),
    )


def write_manifest(spark: SparkSession, path: str, **fields: Any) -> None:
    """The run's manifest, one JSON object. Write it only after all else has landed."""
    write_text(spark, path, json.dumps(fields))


def read_manifest(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.schema(MANIFEST_DDL).option("mode", "FAILFAST").json(path)


def artifact_listing(spark: SparkSession, root: str) -> DataFrame:
    """Size of every artifact under ``root``: the sum over its part files.

    Only file names and lengths are read, never contents.
    """
    files = (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup="true", pathGlobFilter="*part-*")
        .load(root)
        .select("path", "length")
    )
    folder = F.regexp_replace("path", r"/[^/]+$", "")
    base = "/" + root.split("://")[-1].strip("/") + "/"
    key = F.substring_index(folder, base, -1)
    return files.groupBy(key.alias("artifact_key")).agg(F.sum("length").alias("size_bytes"))


def artifact_sizes(payloads: DataFrame, listing: DataFrame, ids: list[str], payload: str = "payload") -> DataFrame:
    """Sizes of the artifacts a payload names, one row per payload and member.

    Members ending in ``_object_key`` or ``_manifest_key`` with a non-blank value
    count; a bare ``manifest_key`` does not. Artifacts that are not listed are left
    out.
    """
    return (
        _artifact_members(payloads, ids, payload)
        .join(listing, "artifact_key", "inner")
        .select(*ids, "metric_key", "artifact_key", "size_bytes")
    )


def artifact_total(payloads: DataFrame, listing: DataFrame, ids: list[str], payload: str = "payload") -> DataFrame:
    """Total artifact bytes per payload; payloads without a listed artifact are left out."""
    return (
        artifact_sizes(payloads, listing, ids, payload)
        .groupBy(*ids)
        .agg(F.sum("size_bytes").alias("artifact_total_bytes"))
    )


def _artifact_members(payloads: DataFrame, ids: list[str], payload: str) -> DataFrame:
    members = F.from_json(F.col(payload), "map<string,string>")
    named = F.map_filter(
        members,
        lambda key, value: (key.endswith("_object_key") | key.endswith("_manifest_key"))
        & (strip(value) != ""),
    )
    return payloads.select(*ids, F.explode(named).alias("metric_key", "artifact_key")).withColumn(
        "artifact_key", strip(F.col("artifact_key"))
    )
