"""Resolving replay requests, many at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.functions.payload import member_text, members, strip, text_or_null
from driftline.operators.ledger import EXTRACT_STAGES
from driftline.sources.landing import LAYOUT, MANIFEST_FILE, with_artifact_keys

# What is wrong with a request that cannot be replayed.
PROBLEMS = {
    "one_input": "Provide exactly one of accepted_object_key or parent_run_id",
    "no_delta_key": "delta_object_key is not supported; use parent_run_id",
    "no_parent": "Missing required configuration values: parent_run_id",
    "no_version": "Replay requires contract_version or a resolvable manifest with contract_version.",
    "manifest_gone": {
        "hash_diff": "Replay manifest was not found in object store.",
        "incremental_audit": "Incremental replay manifest was not found in object store.",
        "logical_cdc": "Logical CDC replay manifest was not found in object store.",
    },
    "key_unset": {
        "incremental_audit": "Parent incremental run has extract metadata without delta_object_key.",
        "logical_cdc": "Parent logical CDC run has extract metadata without delta_object_key.",
    },
    "delta_gone": {
        "incremental_audit": "Incremental replay delta artifact was not found in object store.",
        "logical_cdc": "Logical CDC replay delta artifact was not found in object store.",
    },
}


def manifest_key_of(accepted_key: Column) -> Column:
    """Manifest next to an accepted snapshot; NULL for any other key."""
    folder, file = LAYOUT["hash_diff"]
    suffix = f"/{folder}/{file}"
    key = F.btrim(strip(accepted_key), F.lit("/"))
    base = F.substring(key, F.lit(1), F.char_length(key) - len(suffix))
    return F.when(key.endswith(suffix), F.concat(base, F.lit(f"/{folder}/{MANIFEST_FILE}")))


def resolve_replays(
    requests: DataFrame, stages: DataFrame, manifests: DataFrame, listing: DataFrame
) -> DataFrame:
    """Artifact, manifest and contract version of each request, or what is wrong with it.

    ``requests`` has request_id, strategy, namespace, name, object_key,
    parent_run_id and contract_version. ``stages`` holds the latest stage records,
    ``manifests`` the manifest_key and raw manifest_json of each existing manifest,
    ``listing`` the existing artifact keys.
    """
    asked = requests.select(
        "request_id",
        "strategy",
        "namespace",
        "name",
        *[text_or_null(F.col(c)).alias(c) for c in ("object_key", "parent_run_id", "contract_version")],
    )
    laid_out = with_artifact_keys(asked, run_id="parent_run_id")
    extracts = (
        stages.filter((F.col("status") == "success") & F.col("stage_name").isin(list(EXTRACT_STAGES.values())))
        .filter(F.size(F.json_object_keys("metrics_json")) > 0)
        .withColumn("_m", members(F.col("metrics_json"), ("delta_object_key", "manifest_key")))
        .select(
            F.col("run_id").alias("parent_run_id"),
            "stage_name",
            F.lit(True).alias("_recorded"),
            text_or_null(member_text(F.col("_m.delta_object_key"))).alias("_delta_key"),
            text_or_null(member_text(F.col("_m.manifest_key"))).alias("_stage_manifest"),
        )
    )
    stage = F.lit(None).cast("string")
    for name, stage_name in EXTRACT_STAGES.items():
        if name != "hash_diff":
            stage = F.when(F.col("strategy") == name, F.lit(stage_name)).otherwise(stage)
    found = _lookup(laid_out.withColumn("stage_name", stage), extracts, ["parent_run_id", "stage_name"])

    snapshot = F.col("strategy") == "hash_diff"
    recorded = F.coalesce("_recorded", F.lit(False))
    key = (
        F.when(snapshot & F.col("parent_run_id").isNull(), F.col("object_key"))
        .when(recorded, F.col("_delta_key"))
        .otherwise(F.col("accepted_key"))
    )
    manifest = (
        F.when(snapshot & F.col("parent_run_id").isNull(), manifest_key_of(F.col("object_key")))
        .when(recorded, F.col("_stage_manifest"))
        .otherwise(F.col("manifest_key"))
    )
    located = found.select(
        "request_id",
        "strategy",
        "object_key",
        "parent_run_id",
        F.col("contract_version").alias("_asked_version"),
        recorded.alias("parent_stage_found"),
        key.alias("artifact_key"),
        manifest.alias("manifest_key"),
    )
    # Only a text version counts; a number in its place is not one.
    stated = F.col("_m.contract_version")
    version = F.when(F.schema_of_variant(stated) == "STRING", text_or_null(member_text(stated)))
    known = manifests.withColumn("_m", members(F.col("manifest_json"), ("contract_version",))).select(
        "manifest_key", version.alias("_version"), F.lit(True).alias("_manifest")
    )
    present = listing.select("artifact_key", F.lit(True).alias("_landed"))
    joined = _lookup(_lookup(located, known, ["manifest_key"]), present, ["artifact_key"])

    resolved = F.coalesce("_asked_version", "_version")
    return joined.select(
        "request_id",
        "strategy",
        "parent_run_id",
        "parent_stage_found",
        "artifact_key",
        "manifest_key",
        resolved.alias("contract_version"),
        _problem(resolved).alias("problem"),
    )


def _lookup(requests: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on keys that are often NULL. A NULL key would send its rows to one
    task; here it stands as a value of its own per request, which finds nothing."""
    first = keys[0]
    own = F.concat(F.lit("\0"), F.col("request_id"))
    right = known.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    matches = F.coalesce(F.col(first), own) == F.col(f"_k_{first}")
    for key in keys[1:]:
        matches = matches & (F.col(key) == F.col(f"_k_{key}"))
    return requests.join(right, matches, "left").drop(*[f"_k_{k}" for k in keys])


def _problem(version: Column) -> Column:
    snapshot = F.col("strategy") == "hash_diff"
    has_key, has_parent = F.col("object_key").isNotNull(), F.col("parent_run_id").isNotNull()
    needs_manifest = F.col("_asked_version").isNull() & F.col("manifest_key").isNotNull()
    return (
        F.when(snapshot & (has_key == has_parent), PROBLEMS["one_input"])
        .when(~snapshot & has_key, PROBLEMS["no_delta_key"])
        .when(~snapshot & ~has_parent, PROBLEMS["no_parent"])
        .when(~snapshot & F.col("artifact_key").isNull(), _by_strategy(PROBLEMS["key_unset"]))
        .when(needs_manifest & F.col("_manifest").isNull(), _by_strategy(PROBLEMS["manifest_gone"]))
        .when(version.isNull(), PROBLEMS["no_version"])
        .when(~snapshot & F.col("_landed").isNull(), _by_strategy(PROBLEMS["delta_gone"]))
    )


def _by_strategy(texts: dict[str, str]) -> Column:
    text = F.lit(None).cast("string")
    for strategy, value in texts.items():
        text = F.when(F.col("strategy") == strategy, F.lit(value)).otherwise(text)
    return text
