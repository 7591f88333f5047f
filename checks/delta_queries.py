"""Audit-log and change-log deltas, checkpoints, replay and streaming."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from checks.contracts import USERS
from checks.fixtures import frame, with_fixtures
from checks.snapshot_queries import _context
from driftline.contracts import Contract, FieldRule
from driftline.functions.lsn import format_lsn, parse_lsn
from driftline.operators.checkpoint import (
    carry_forward,
    checkpoint_lineage,
    checkpoint_payload,
    latest_checkpoint,
    lsn_window,
    resolve_checkpoint_lsn,
)
from driftline.operators.delta import (
    SUB_ORDER,
    WATERMARK,
    apply_delta,
    classify_delta,
    compact_delta,
    delta_counts,
    expand_key_changes,
    extract_delta,
    watermark_column,
    window_bounds,
)
from driftline.operators.replay import manifest_key_of, resolve_replays
from driftline.operators.validation import quarantine_counts, quarantine_transactions
from driftline.plans import ingest_audit_log, ingest_change_log, replay
from driftline.plans.snapshot import current_rows
from driftline.shared import scratch_path, staged
from driftline.sources.curated import write_curated
from driftline.streaming import drain, stream_deltas

def _bad() -> Column:
    return F.col("bad") == 1


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    marked = quarantine_transactions(frame(spark, sf, "wal_events"), _bad())
    return marked.filter(~F.col("_quarantined"))


def _change_delta(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine, then key changes, then the last event of each key."""
    halves = expand_key_changes(_clean(spark, sf).select("lsn", "op", "k", "old_k", "v"), ["k"], ["old_k"])
    halves = halves.withColumn("v", F.when(F.col(SUB_ORDER) == 1, F.col("v")))
    return staged(compact_delta(halves, ["k"], ["lsn", SUB_ORDER]).select("k", "op", "v"), "delta")


def quarantined_events(spark: SparkSession, sf: str) -> DataFrame:
    marked = quarantine_transactions(frame(spark, sf, "wal_events"), _bad())
    return marked.select("seq", "xid", "_quarantined")


def quarantine_count_row(spark: SparkSession, sf: str) -> DataFrame:
    return quarantine_counts(quarantine_transactions(frame(spark, sf, "wal_events"), _bad()), _bad())


def watermarks_auto(spark: SparkSession, sf: str) -> DataFrame:
    return watermark_column(frame(spark, sf, "audit_events"), "auto").select("audit_id", WATERMARK)


def watermarks_commit(spark: SparkSession, sf: str) -> DataFrame:
    return watermark_column(frame(spark, sf, "audit_events"), "commit_timestamp").select("audit_id", WATERMARK)


def window_bound_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Bounds of the whole log, and of a window nothing falls into."""
    events = watermark_column(frame(spark, sf, "audit_events"), "commit_timestamp")
    empty = extract_delta(events, (F.lit("2999-01-01").cast("timestamp_ntz"), 0))
    whole = window_bounds(events).withColumn("which", F.lit("whole"))
    return whole.unionByName(window_bounds(empty).withColumn("which", F.lit("empty")))


def extracted_window(spark: SparkSession, sf: str) -> DataFrame:
    """Hourly watermarks make ties, cut by the audit id on both ends."""
    start = (F.lit("2024-01-05 05:00:00").cast("timestamp_ntz"), 1370)
    end = (F.lit("2024-01-25 07:00:00").cast("timestamp_ntz"), 8100)
    rows = extract_delta(frame(spark, sf, "audit_events"), start, end, watermark="hour_at")
    return rows.select("audit_id", "k", "hour_at")


def compacted_delta(spark: SparkSession, sf: str) -> DataFrame:
    events = watermark_column(frame(spark, sf, "audit_events"), "recorded_at")
    return compact_delta(events, ["k"], [WATERMARK, "audit_id"]).select("k", "op", "v", "audit_id")


def expanded_events(spark: SparkSession, sf: str) -> DataFrame:
    events = frame(spark, sf, "wal_events").select("lsn", "op", "k", "old_k", "v")
    return expand_key_changes(events, ["k"], ["old_k"]).select("k", "op", "lsn", SUB_ORDER)


def applied_delta(spark: SparkSession, sf: str) -> DataFrame:
    return apply_delta(frame(spark, sf, "cur_users"), _change_delta(spark, sf), ["k"])


def applied_twice(spark: SparkSession, sf: str) -> DataFrame:
    delta = _change_delta(spark, sf)
    once = apply_delta(frame(spark, sf, "cur_users"), delta, ["k"])
    return apply_delta(once, delta, ["k"])


def guarded_apply(spark: SparkSession, sf: str) -> DataFrame:
    """An old window applied over newer rows: the guard keeps the newer ones."""
    events = frame(spark, sf, "audit_events").withColumn("_position", F.col("audit_id"))
    newest = compact_delta(events, ["k"], ["audit_id"]).select("k", "v", "_position")
    old = events.filter(F.col("recorded_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    delta = compact_delta(old, ["k"], ["audit_id"]).select("k", "op", "v", "_position")
    return apply_delta(newest, delta, ["k"], guard=True)


def classified_delta(spark: SparkSession, sf: str) -> DataFrame:
    return classify_delta(frame(spark, sf, "cur_users"), _change_delta(spark, sf), ["k"])


def delta_count_row(spark: SparkSession, sf: str) -> DataFrame:
    return delta_counts(frame(spark, sf, "cur_users"), _change_delta(spark, sf), ["k"])


def lsn_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    position = F.col("lsn") * 1000003
    events = frame(spark, sf, "wal_events").select("seq", position.alias("lsn"))
    return events.select("seq", format_lsn(F.col("lsn")).alias("text")).withColumn(
        "number", parse_lsn(F.concat(F.lit(" "), F.lower("text"), F.lit(" ")))
    )


def lsn_windows(spark: SparkSession, sf: str) -> DataFrame:
    """One window per kind of operation, over the events of one table."""
    feed = frame(spark, sf, "wal_events")
    start, end = F.lit(4294967296 + 640), F.lit(4294967296 + 6400 * 64)
    return lsn_window(feed, start, end, F.col("source_table") == "click", by=["op"])


def checkpoint_positions(spark: SparkSession, sf: str) -> DataFrame:
    events = frame(spark, sf, "wal_events")
    runs = events.select(
        "seq",
        F.when(F.col("seq") % 5 != 0, F.col("lsn") + 64 * (F.col("seq") % 3 - 1)).alias("start_lsn"),
        F.when(F.col("seq") % 7 != 0, F.col("lsn")).alias("window_end_lsn"),
        (F.col("bad") == 0).alias("applied"),
    )
    return resolve_checkpoint_lsn(runs).select("seq", "last_applied_lsn", "last_flushed_lsn")


def carried_watermarks(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "audit_events").select(
        "audit_id", carry_forward(F.col("commit_timestamp"), F.col("hour_at")).alias("last_applied_watermark")
    )


def latest_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    return latest_checkpoint(frame(spark, sf, "checkpoints"))


def checkpoint_payloads(spark: SparkSession, sf: str) -> DataFrame:
    runs = frame(spark, sf, "run_audit").select(
        "pipeline_id",
        "contract_id",
        F.col("version").alias("contract_version"),
        F.struct("read_count", "insert_count").alias("merge"),
        F.col("run_id").alias("last_completed_run_id"),
    )
    text = F.col("c")
    return runs.select("last_completed_run_id", checkpoint_payload(runs, "hash_diff").alias("c")).select(
        F.col("last_completed_run_id").alias("run_id"),
        F.array_join(F.json_object_keys(text), ",").alias("members"),
        F.get_json_object(text, "$.status").alias("status"),
        F.get_json_object(text, "$.pipeline_id").alias("pipeline_id"),
        F.get_json_object(text, "$.merge.read_count").cast("bigint").alias("read_count"),
        F.get_json_object(text, "$.source_table").alias("source_table"),
    )


def checkpoint_history(spark: SparkSession, sf: str) -> DataFrame:
    return checkpoint_lineage(frame(spark, sf, "checkpoints")).drop("checkpoint_json")


def manifest_keys(spark: SparkSession, sf: str) -> DataFrame:
    requests = frame(spark, sf, "requests")
    slashed = F.concat(F.lit(" /"), F.trim("object_key"), F.lit("// "))
    return requests.select(
        "request_id",
        manifest_key_of(F.col("object_key")).alias("manifest_key"),
        manifest_key_of(slashed).alias("slashed"),
    )


def resolved_replays(spark: SparkSession, sf: str) -> DataFrame:
    stages = frame(spark, sf, "closing_stages")
    manifests = frame(spark, sf, "manifests_snapshot").unionAll(frame(spark, sf, "manifests_stage"))
    return resolve_replays(frame(spark, sf, "requests"), stages, manifests, frame(spark, sf, "listing"))


def _feed(spark: SparkSession, sf: str) -> DataFrame:
    return frame(spark, sf, "wal_events").select("lsn", "xid", "seq", "op", "old_k", "k", "v", "tx_end")


def _users_seed(spark: SparkSession, sf: str, root: str) -> None:
    seed = frame(spark, sf, "cur_users").withColumn("_position", F.lit(0).cast("bigint"))
    write_curated(seed, root, ["k"], "seed", buckets=4)


def audit_log_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs: the first up to mid-month, the second the rest after its watermark."""
    folder = scratch_path(spark, "audit-run")
    events = frame(spark, sf, "audit_events")
    first = events.filter(F.col("recorded_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    ingest_audit_log(_context(spark, USERS, "incremental_audit", folder), first, buckets=4)
    second = _context(spark, USERS, "incremental_audit", folder)
    ingest_audit_log(second, events, buckets=4)
    return current_rows(second)


def audit_overlap_late_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the events became visible late, also those of keys deleted meanwhile: re-reading finds their place."""
    folder = scratch_path(spark, "late-commit")
    events = frame(spark, sf, "audit_events")
    seen = events.filter((F.col("audit_id") % 3 != 1) | (F.col("recorded_at") < F.lit("2024-01-05").cast("timestamp_ntz")))
    ingest_audit_log(_context(spark, USERS, "incremental_audit", folder), seen, "recorded_at", buckets=4)
    second = _context(spark, USERS, "incremental_audit", folder)
    ingest_audit_log(second, events, "recorded_at", overlap=F.expr("INTERVAL 400 DAYS"), buckets=4)
    return current_rows(second)


def delta_run_narrower_type(spark: SparkSession, sf: str) -> DataFrame:
    """A contract that cannot hold the stored keys is refused before it destroys any: the first run's rows stay."""
    folder = scratch_path(spark, "narrower")
    events = frame(spark, sf, "audit_events").withColumn("k", F.col("k") + F.lit(5_000_000_000))
    first = _context(spark, USERS, "incremental_audit", folder)
    ingest_audit_log(first, events.filter(F.col("recorded_at") < F.lit("2024-01-15").cast("timestamp_ntz")), buckets=4)
    narrow = Contract("users", "2.0.0", (FieldRule("k", "int"), *[f for f in USERS.fields if f.name != "k"]), USERS.keys)
    small = frame(spark, sf, "audit_events").filter(F.col("recorded_at") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    told = "0"
    try:
        ingest_audit_log(_context(spark, narrow, "incremental_audit", folder), small, buckets=4)
    except ValueError as exc:
        told = str(exc).split(" in ")[1].split()[0]
    return current_rows(first).select((F.col("k") - F.lit(5_000_000_000)).alias("k"), "v", F.lit(int(told)).cast("bigint").alias("refused"))


def change_log_windows(spark: SparkSession, sf: str) -> DataFrame:
    """Windows that end inside transactions leave the state of one run over all."""
    folder = scratch_path(spark, "windows")
    feed = _feed(spark, sf)
    ctx = _context(spark, USERS, "logical_cdc", folder)
    _users_seed(spark, sf, ctx.target_root)
    top = feed.agg(F.max("lsn")).first()[0]
    for share in (0.23, 0.61, 1):
        ctx = _context(spark, USERS, "logical_cdc", folder)
        ingest_change_log(ctx, feed, end_lsn=int(top * share), buckets=4, commit="tx_end")
    return current_rows(ctx)


def audit_run_null_clock(spark: SparkSession, sf: str) -> DataFrame:
    """A run whose clock some events lack is refused, and tells how many they are."""
    ctx = _context(spark, USERS, "incremental_audit", scratch_path(spark, "null-clock"))
    try:
        ingest_audit_log(ctx, frame(spark, sf, "audit_events"), "commit_timestamp", buckets=4)
        told = "0"
    except ValueError as exc:
        told = str(exc).split()[0]
    status = ctx.ledger.runs().first()["status"]
    return spark.range(1).select(F.lit(int(told)).cast("bigint").alias("without_clock"), F.lit(status).alias("status"))


def delta_unknown_op(spark: SparkSession, sf: str) -> DataFrame:
    """Events with an unknown or missing operation are rejected; the others decide the state."""
    events = frame(spark, sf, "audit_events")
    place = F.col("audit_id") % 10
    odd = events.withColumn("op", F.when(place == 3, F.lower("op")).when(place != 7, F.col("op")))
    ctx = _context(spark, USERS, "incremental_audit", scratch_path(spark, "unknown-op"))
    ingest_audit_log(ctx, odd, buckets=4)
    return current_rows(ctx)


def delta_run_new_column(spark: SparkSession, sf: str) -> DataFrame:
    """The second run's contract has one column more; rows it does not touch have NULL there."""
    folder = scratch_path(spark, "new-column")
    events = frame(spark, sf, "audit_events").withColumn("w", F.col("audit_id") * 2)
    first = events.filter(F.col("recorded_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    ingest_audit_log(_context(spark, USERS, "incremental_audit", folder), first, buckets=4)
    wider = Contract("users", "2.0.0", (*USERS.fields, FieldRule("w", "bigint")), USERS.keys)
    second = _context(spark, wider, "incremental_audit", folder)
    ingest_audit_log(second, events, buckets=4)
    return current_rows(second)


def delta_run_wider_key(spark: SparkSession, sf: str) -> DataFrame:
    """The second run's contract gives the key and the value other types."""
    folder = scratch_path(spark, "wider-key")
    events = frame(spark, sf, "audit_events")
    first = events.filter(F.col("recorded_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    narrow = Contract("users", "1.0.0", (FieldRule("k", "int"), FieldRule("v", "string")), USERS.keys)
    ingest_audit_log(_context(spark, narrow, "incremental_audit", folder), first, buckets=4)
    second = _context(spark, USERS, "incremental_audit", folder)
    ingest_audit_log(second, events, buckets=4)
    return current_rows(second)


def replay_audit_run(spark: SparkSession, sf: str) -> DataFrame:
    """A delta landed with a zoned clock, applied again: the state stays the same."""
    folder = scratch_path(spark, "replay-audit")
    events = frame(spark, sf, "audit_events")
    zoned = events.withColumns({c: F.col(c).cast("timestamp") for c in ("commit_timestamp", "recorded_at")})
    ctx = _context(spark, USERS, "incremental_audit", folder)
    ingest_audit_log(ctx, zoned, buckets=4)
    again = _context(spark, USERS, "incremental_audit", folder, mode="replay")
    replay(again, ctx.keys["accepted_key"])
    return current_rows(again)


def quarantined_artifact(spark: SparkSession, sf: str) -> DataFrame:
    """Valid events of bad transactions, as the run landed them beside its delta."""
    ctx = _context(spark, USERS, "logical_cdc", scratch_path(spark, "held-events"))
    _users_seed(spark, sf, ctx.target_root)
    ingest_change_log(ctx, _feed(spark, sf))
    key = ctx.results["extract_validate_land_wal_delta"]["quarantined_object_key"]
    return spark.read.schema("seq bigint, xid bigint").json(ctx.path(key))


def change_log_run(spark: SparkSession, sf: str) -> DataFrame:
    """One run over the whole feed, from a seeded curated table."""
    ctx = _context(spark, USERS, "logical_cdc", scratch_path(spark, "change-run"))
    _users_seed(spark, sf, ctx.target_root)
    ingest_change_log(ctx, _feed(spark, sf))
    return current_rows(ctx)


def replayed_run(spark: SparkSession, sf: str) -> DataFrame:
    """A landed change-log delta applied again: the state stays the same."""
    folder = scratch_path(spark, "replay-run")
    ctx = _context(spark, USERS, "logical_cdc", folder)
    _users_seed(spark, sf, ctx.target_root)
    ingest_change_log(ctx, _feed(spark, sf))
    again = _context(spark, USERS, "logical_cdc", folder, mode="replay")
    replay(again, ctx.keys["accepted_key"])
    return current_rows(again)


def _stream(spark: SparkSession, sf: str):
    """The feed as a stream in three slices, cut in the middle of transactions."""
    folder = scratch_path(spark, "stream")
    ctx = _context(spark, USERS, "logical_cdc", folder)
    _users_seed(spark, sf, ctx.target_root)
    feed = _feed(spark, sf)
    last = feed.agg(F.max("seq").alias("m")).first()["m"]
    cuts = [last // 3 // 4 * 4 + 1, last // 3 * 2 // 4 * 4 + 2, last + 1]
    files = 4
    for low, high in zip([0, *cuts[:-1]], cuts, strict=True):
        part = feed.filter((F.col("seq") >= low) & (F.col("seq") < high))
        part.repartition(files).write.mode("append").parquet(f"{folder}/feed")
    source = spark.readStream.schema(feed.schema).option("maxFilesPerTrigger", files).parquet(f"{folder}/feed")
    query = stream_deltas(ctx, source, f"{folder}/checkpoint", buckets=4)
    end = feed.agg(F.max("lsn").alias("m")).first()["m"]
    return ctx, drain(query, max_seconds=600, end_lsn=end)


def streamed_deltas(spark: SparkSession, sf: str) -> DataFrame:
    """State after the stream: equal to one batch over the same events."""
    ctx, _ = _stream(spark, sf)
    return current_rows(ctx)


def streamed_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine counts added up over the micro-batches."""
    ctx, _ = _stream(spark, sf)
    names = ("invalid_event_count", "quarantined_event_count", "quarantined_transaction_count")
    totals = {n: sum(r[n] for r in ctx.results.values() if n in r) for n in names}
    return spark.range(1).select(*[F.lit(v).cast("bigint").alias(n) for n, v in totals.items()])


def streamed_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the stream's runs as the ledger has them, and the position the last one stored."""
    ctx, _ = _stream(spark, sf)
    runs = ctx.ledger.runs().filter("status = 'success'").select("run_id")
    extracts = ctx.ledger.stages().filter("stage_name = 'extract_validate_land_wal_delta'").join(runs, "run_id")
    names = ("source_event_count", "invalid_event_count", "quarantined_event_count", "quarantined_transaction_count")
    sums = [F.sum(F.get_json_object("metrics_json", f"$.{n}").cast("bigint")).alias(n) for n in names]
    stored = ctx.ledger.checkpoint(ctx.pipeline_id)["last_applied_lsn"]
    position = parse_lsn(F.lit(stored)).alias("last_applied_lsn")
    return extracts.agg(F.count("*").alias("runs"), *sums).select("*", position)


def streamed_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Violations that the stream's batches stored for the monitoring views."""
    ctx, _ = _stream(spark, sf)
    stored = spark.read.parquet(f"{ctx.ledger.root}/validation_errors")
    return stored.select("row_number", "field", "code", "strategy", "stage_name")


def drained_stream(spark: SparkSession, sf: str) -> DataFrame:
    _, report = _stream(spark, sf)
    return spark.range(1).select(
        F.lit(report.reached_window_end).alias("reached_window_end"),
        F.lit(report.input_rows).cast("bigint").alias("input_rows"),
    )


_QUARANTINE = "marked AS (SELECT *, max(bad) OVER (PARTITION BY xid) AS q FROM wal_events)"
_LAST = f"""{_QUARANTINE},
halves AS (SELECT k, lsn, 1 AS sub, op, v FROM marked WHERE q = 0
  UNION ALL SELECT old_k, lsn, 0, 'D', CAST(NULL AS DOUBLE) FROM marked WHERE q = 0 AND old_k IS NOT NULL),
delta AS (SELECT k, op, v FROM halves QUALIFY row_number() OVER (PARTITION BY k ORDER BY lsn DESC, sub DESC) = 1)"""
_APPLIED = """SELECT k, v FROM delta WHERE op <> 'D'
  UNION ALL SELECT k, v FROM cur_users c WHERE NOT EXISTS (SELECT 1 FROM delta d WHERE d.k = c.k)"""
_CLASSIFIED = """effect AS (SELECT d.k, CASE WHEN op = 'D' AND c.k IS NOT NULL THEN 'delete' WHEN op = 'D' THEN 'noop_delete'
  WHEN c.k IS NULL THEN 'insert' WHEN d.v IS DISTINCT FROM c.v THEN 'update' ELSE 'unchanged' END AS action
  FROM delta d LEFT JOIN cur_users c ON d.k = c.k)"""
# The runs' own contract rejects values below 2 unless the event is a delete.
_RUN_DELTA = """marked AS (SELECT *, max(CASE WHEN v < 2 AND op <> 'D' THEN 1 ELSE 0 END) OVER (PARTITION BY xid) AS q FROM wal_events),
halves AS (SELECT k, lsn, 1 AS sub, op, v FROM marked WHERE q = 0
  UNION ALL SELECT old_k, lsn, 0, 'D', CAST(NULL AS DOUBLE) FROM marked WHERE q = 0 AND old_k IS NOT NULL),
delta AS (SELECT k, op, v FROM halves QUALIFY row_number() OVER (PARTITION BY k ORDER BY lsn DESC, sub DESC) = 1)"""
_STREAM_DELTA = _RUN_DELTA.replace(
    "FROM wal_events)", "FROM wal_events WHERE xid IN (SELECT xid FROM wal_events WHERE tx_end))"
)
_HEX = "printf('%X/%X', {0} >> 32, {0} & 4294967295)"
_SUFFIX = "/accepted/accepted_snapshot.ndjson.gz"
_MANIFEST_OF = (
    f"CASE WHEN object_key LIKE '%{_SUFFIX}' THEN "
    f"replace(trim(object_key), '{_SUFFIX}', '/accepted/manifest.json') END"
)
_MEMBERS = (
    "status,strategy,pipeline_id,contract_id,contract_version,checksum,previous_checkpoint_run_id,"
    "previous_checkpoint_updated_at,source_table,target_table_curated,validation_error_object_key,"
    "accepted_object_key,extract_validate_land,merge,last_completed_run_id"
)
_ISO = "strftime({0}, '%Y-%m-%dT%H:%M:%S.%f')"
_REPLAY_SQL = """asked AS (SELECT request_id, strategy, namespace, name, nullif(trim(object_key), '') AS object_key,
    nullif(trim(parent_run_id), '') AS parent, nullif(trim(contract_version), '') AS version FROM requests),
  ext AS (SELECT a.*, s.metrics_json AS m,
    'sales/' || name || '/run_id=' || parent || '/' || CASE strategy WHEN 'hash_diff' THEN 'accepted/'
      WHEN 'incremental_audit' THEN 'delta/' ELSE 'wal_delta/' END AS base
    FROM asked a LEFT JOIN closing_stages s ON s.run_id = a.parent AND s.status = 'success' AND s.stage_name =
      CASE a.strategy WHEN 'incremental_audit' THEN 'extract_validate_land_delta' WHEN 'logical_cdc' THEN 'extract_validate_land_wal_delta' END),
  loc AS (SELECT *, m IS NOT NULL AS found,
    CASE WHEN strategy = 'hash_diff' AND parent IS NULL THEN object_key
      WHEN m IS NOT NULL THEN nullif(trim(json_extract_string(m, '$.delta_object_key')), '')
      ELSE base || CASE strategy WHEN 'hash_diff' THEN 'accepted_snapshot' ELSE 'accepted_delta' END || '.ndjson.gz' END AS akey,
    CASE WHEN strategy = 'hash_diff' AND parent IS NULL THEN """ + _MANIFEST_OF + """
      WHEN m IS NOT NULL THEN nullif(trim(json_extract_string(m, '$.manifest_key')), '')
      ELSE base || 'manifest.json' END AS mkey FROM ext),
  man AS (SELECT * FROM manifests_snapshot UNION ALL SELECT * FROM manifests_stage),
  res AS (SELECT loc.*, man.manifest_key IS NOT NULL AS has_manifest, l.artifact_key IS NOT NULL AS landed,
    coalesce(version, CASE WHEN json_type(manifest_json, '$.contract_version') = 'VARCHAR'
      THEN nullif(trim(json_extract_string(manifest_json, '$.contract_version')), '') END) AS ver
    FROM loc LEFT JOIN man ON man.manifest_key = mkey LEFT JOIN listing l ON l.artifact_key = akey)
SELECT request_id, strategy, parent AS parent_run_id, found AS parent_stage_found, akey AS artifact_key, mkey AS manifest_key,
  ver AS contract_version,
  CASE WHEN strategy = 'hash_diff' AND (object_key IS NULL) = (parent IS NULL) THEN 'Provide exactly one of accepted_object_key or parent_run_id'
    WHEN strategy <> 'hash_diff' AND object_key IS NOT NULL THEN 'delta_object_key is not supported; use parent_run_id'
    WHEN strategy <> 'hash_diff' AND parent IS NULL THEN 'Missing required configuration values: parent_run_id'
    WHEN strategy = 'incremental_audit' AND akey IS NULL THEN 'Parent incremental run has extract metadata without delta_object_key.'
    WHEN strategy = 'logical_cdc' AND akey IS NULL THEN 'Parent logical CDC run has extract metadata without delta_object_key.'
    WHEN version IS NULL AND mkey IS NOT NULL AND NOT has_manifest THEN CASE strategy WHEN 'hash_diff' THEN 'Replay manifest'
      WHEN 'incremental_audit' THEN 'Incremental replay manifest' ELSE 'Logical CDC replay manifest' END || ' was not found in object store.'
    WHEN ver IS NULL THEN 'Replay requires contract_version or a resolvable manifest with contract_version.'
    WHEN strategy <> 'hash_diff' AND NOT landed THEN CASE strategy WHEN 'incremental_audit' THEN 'Incremental' ELSE 'Logical CDC' END
      || ' replay delta artifact was not found in object store.' END AS problem FROM res"""

QUERIES = {
    "quarantine_transactions": (
        quarantined_events,
        with_fixtures("wal_events", f"WITH {_QUARANTINE} SELECT seq, xid, q = 1 AS _quarantined FROM marked"),
    ),
    "quarantine_counts": (
        quarantine_count_row,
        with_fixtures(
            "wal_events",
            f"""WITH {_QUARANTINE} SELECT CAST(sum(bad) AS BIGINT) AS invalid_event_count,
            count(DISTINCT CASE WHEN bad = 1 THEN xid END) AS invalid_transaction_count,
            CAST(sum(q) AS BIGINT) AS quarantined_event_count,
            count(DISTINCT CASE WHEN q = 1 THEN xid END) AS quarantined_transaction_count FROM marked""",
        ),
    ),
    "watermark_auto": (
        watermarks_auto,
        with_fixtures(
            "audit_events",
            """SELECT audit_id, CASE WHEN (SELECT bool_and(commit_timestamp IS NOT NULL) FROM audit_events)
            THEN commit_timestamp ELSE recorded_at END AS _watermark FROM audit_events""",
        ),
    ),
    "watermark_commit": (
        watermarks_commit,
        with_fixtures("audit_events", "SELECT audit_id, commit_timestamp AS _watermark FROM audit_events"),
    ),
    "window_bounds": (
        window_bound_rows,
        with_fixtures(
            "audit_events",
            """WITH t AS (SELECT * FROM audit_events WHERE commit_timestamp IS NOT NULL)
            SELECT 'whole' AS which,
              (SELECT commit_timestamp FROM t ORDER BY commit_timestamp, audit_id LIMIT 1) AS window_start,
              (SELECT audit_id FROM t ORDER BY commit_timestamp, audit_id LIMIT 1) AS window_start_id,
              (SELECT commit_timestamp FROM t ORDER BY commit_timestamp DESC, audit_id DESC LIMIT 1) AS window_end,
              (SELECT audit_id FROM t ORDER BY commit_timestamp DESC, audit_id DESC LIMIT 1) AS window_end_id
            UNION ALL SELECT 'empty', NULL, NULL, NULL, NULL""",
        ),
    ),
    "extract_delta": (
        extracted_window,
        with_fixtures(
            "audit_events",
            """SELECT audit_id, k, hour_at FROM audit_events
            WHERE hour_at >= TIMESTAMP '2024-01-05 05:00:00' AND hour_at <= TIMESTAMP '2024-01-25 07:00:00'
              AND NOT (hour_at = TIMESTAMP '2024-01-05 05:00:00' AND audit_id <= 1370)
              AND NOT (hour_at = TIMESTAMP '2024-01-25 07:00:00' AND audit_id > 8100)""",
        ),
    ),
    "compact_delta": (
        compacted_delta,
        with_fixtures(
            "audit_events",
            """SELECT k, op, v, audit_id FROM audit_events
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1""",
        ),
    ),
    "expand_key_changes": (
        expanded_events,
        with_fixtures(
            "wal_events",
            """SELECT k, op, lsn, CAST(1 AS INTEGER) AS _sub FROM wal_events
            UNION ALL SELECT old_k, 'D', lsn, 0 FROM wal_events WHERE old_k IS NOT NULL""",
        ),
    ),
    "apply_delta": (applied_delta, with_fixtures("wal_events cur_users", f"WITH {_LAST} {_APPLIED}")),
    "apply_delta_twice": (applied_twice, with_fixtures("wal_events cur_users", f"WITH {_LAST} {_APPLIED}")),
    "apply_delta_guarded": (
        guarded_apply,
        with_fixtures(
            "audit_events",
            """SELECT k, v, audit_id AS _position FROM audit_events
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY audit_id DESC) = 1""",
        ),
    ),
    "classify_delta": (
        classified_delta,
        with_fixtures("wal_events cur_users", f"WITH {_LAST}, {_CLASSIFIED} SELECT k, action FROM effect"),
    ),
    "delta_counts": (
        delta_count_row,
        with_fixtures(
            "wal_events cur_users",
            f"""WITH {_LAST}, {_CLASSIFIED} SELECT count(*) AS read_count,
            count(*) FILTER (action = 'insert') AS insert_count, count(*) FILTER (action = 'update') AS update_count,
            count(*) FILTER (action = 'delete') AS delete_count, count(*) FILTER (action = 'unchanged') AS unchanged_count,
            count(*) FILTER (action = 'noop_delete') AS noop_delete_count FROM effect""",
        ),
    ),
    "lsn_round_trip": (
        lsn_round_trip,
        with_fixtures(
            "wal_events",
            f"SELECT seq, {_HEX.format('(lsn * 1000003)')} AS text, lsn * 1000003 AS number FROM wal_events",
        ),
    ),
    "lsn_window": (
        lsn_windows,
        with_fixtures(
            "wal_events",
            f"""SELECT op, {_HEX.format('4294967936')} AS window_start_lsn, {_HEX.format('4295376896')} AS window_end_lsn,
            CASE WHEN decoded IS NOT NULL THEN {_HEX.format('decoded')} END AS last_decoded_lsn,
            {_HEX.format('stream')} AS last_stream_wal_end_lsn, reached AS reached_window_end FROM (
              SELECT op, max(CASE WHEN source_table = 'click' AND lsn > 4294967936 AND lsn <= 4295376896 THEN lsn END) AS decoded,
                max(lsn) AS stream, bool_or(lsn >= 4295376896) AS reached FROM wal_events GROUP BY op) t""",
        ),
    ),
    "resolve_checkpoint_lsn": (
        checkpoint_positions,
        with_fixtures(
            "wal_events",
            """WITH t AS (SELECT seq, CASE WHEN seq % 5 <> 0 THEN lsn + 64 * (seq % 3 - 1) END AS s,
              CASE WHEN seq % 7 <> 0 AND bad = 0 THEN lsn END AS e FROM wal_events)
            SELECT seq, CASE WHEN s IS NULL THEN e WHEN e IS NULL OR s > e THEN s ELSE e END AS last_applied_lsn,
              CASE WHEN s IS NULL THEN e WHEN e IS NULL OR s > e THEN s ELSE e END AS last_flushed_lsn FROM t""",
        ),
    ),
    "carry_forward": (
        carried_watermarks,
        with_fixtures(
            "audit_events",
            """SELECT audit_id, CASE WHEN commit_timestamp IS NULL THEN hour_at ELSE commit_timestamp END
            AS last_applied_watermark FROM audit_events""",
        ),
    ),
    "latest_checkpoint": (
        latest_checkpoints,
        with_fixtures(
            "checkpoints",
            f"""SELECT pipeline_id, run_id, checkpoint_json, {_ISO.format('updated_at')} AS updated_at FROM checkpoints
            QUALIFY row_number() OVER (PARTITION BY pipeline_id ORDER BY updated_at DESC, run_id DESC) = 1""",
        ),
    ),
    "checkpoint_payload": (
        checkpoint_payloads,
        with_fixtures(
            "run_audit",
            f"""SELECT run_id, '{_MEMBERS}' AS members, 'success' AS status, pipeline_id, read_count,
            CAST(NULL AS VARCHAR) AS source_table FROM run_audit""",
        ),
    ),
    "checkpoint_lineage": (
        checkpoint_history,
        with_fixtures(
            "checkpoints",
            """SELECT pipeline_id, run_id, updated_at, lag(run_id) OVER w AS previous_checkpoint_run_id,
            lag(updated_at) OVER w AS previous_checkpoint_updated_at FROM checkpoints
            WINDOW w AS (PARTITION BY pipeline_id ORDER BY updated_at, run_id)""",
        ),
    ),
    "manifest_key_of": (
        manifest_keys,
        with_fixtures(
            "requests", f"SELECT request_id, {_MANIFEST_OF} AS manifest_key, {_MANIFEST_OF} AS slashed FROM requests"
        ),
    ),
    "resolve_replays": (
        resolved_replays,
        with_fixtures("requests closing_stages manifests_snapshot manifests_stage listing", f"WITH {_REPLAY_SQL}"),
    ),
    "audit_log_run": (
        audit_log_run,
        with_fixtures(
            "audit_events",
            """SELECT k, v FROM (SELECT * FROM audit_events WHERE op = 'D' OR v >= 2) t
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "audit_overlap_late_commit": (
        audit_overlap_late_commit,
        with_fixtures(
            "audit_events",
            """SELECT k, v FROM audit_events WHERE op = 'D' OR v >= 2
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "delta_run_narrower_type": (
        delta_run_narrower_type,
        with_fixtures(
            "audit_events",
            """WITH base AS (SELECT k, v, op FROM audit_events
              WHERE (op = 'D' OR v >= 2) AND recorded_at < TIMESTAMP '2024-01-15'
              QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1)
            SELECT k, v, (SELECT count(*) FROM base WHERE op <> 'D') AS refused FROM base WHERE op <> 'D'""",
        ),
    ),
    "change_log_windows": (change_log_windows, with_fixtures("wal_events cur_users", f"WITH {_STREAM_DELTA} {_APPLIED}")),
    "audit_run_null_clock": (
        audit_run_null_clock,
        with_fixtures(
            "audit_events",
            "SELECT count(*) FILTER (commit_timestamp IS NULL) AS without_clock, 'failed' AS status FROM audit_events",
        ),
    ),
    "delta_unknown_op": (
        delta_unknown_op,
        with_fixtures(
            "audit_events",
            """SELECT k, v FROM (SELECT * FROM audit_events WHERE (op = 'D' OR v >= 2) AND audit_id % 10 NOT IN (3, 7)) t
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "delta_run_new_column": (
        delta_run_new_column,
        with_fixtures(
            "audit_events",
            """SELECT k, v, CASE WHEN recorded_at >= TIMESTAMP '2024-01-15' THEN audit_id * 2 END AS w
            FROM (SELECT * FROM audit_events WHERE op = 'D' OR v >= 2) t
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "delta_run_wider_key": (
        delta_run_wider_key,
        with_fixtures(
            "audit_events",
            """SELECT k, v FROM (SELECT * FROM audit_events WHERE op = 'D' OR v >= 2 OR recorded_at < TIMESTAMP '2024-01-15') t
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "replay_audit_run": (
        replay_audit_run,
        with_fixtures(
            "audit_events",
            """SELECT k, v FROM (SELECT * FROM audit_events WHERE op = 'D' OR v >= 2) t
            QUALIFY row_number() OVER (PARTITION BY k ORDER BY recorded_at DESC, audit_id DESC) = 1 AND op <> 'D'""",
        ),
    ),
    "quarantined_artifact": (
        quarantined_artifact,
        with_fixtures(
            "wal_events",
            """WITH marked AS (SELECT seq, xid, coalesce(v < 2 AND op <> 'D', false) AS bad FROM wal_events)
            SELECT seq, xid FROM marked WHERE NOT bad AND xid IN (SELECT xid FROM marked WHERE bad)""",
        ),
    ),
    "change_log_run": (change_log_run, with_fixtures("wal_events cur_users", f"WITH {_RUN_DELTA} {_APPLIED}")),
    "replay_run": (replayed_run, with_fixtures("wal_events cur_users", f"WITH {_RUN_DELTA} {_APPLIED}")),
    "stream_deltas": (streamed_deltas, with_fixtures("wal_events cur_users", f"WITH {_STREAM_DELTA} {_APPLIED}")),
    "stream_quarantine": (
        streamed_counts,
        with_fixtures(
            "wal_events",
            """WITH marked AS (SELECT xid, CASE WHEN v < 2 AND op <> 'D' THEN 1 ELSE 0 END AS b FROM wal_events
              WHERE xid IN (SELECT xid FROM wal_events WHERE tx_end)),
            q AS (SELECT *, max(b) OVER (PARTITION BY xid) AS q FROM marked)
            SELECT CAST(sum(b) AS BIGINT) AS invalid_event_count, CAST(sum(q) AS BIGINT) AS quarantined_event_count,
              count(DISTINCT CASE WHEN q = 1 THEN xid END) AS quarantined_transaction_count FROM q""",
        ),
    ),
    "stream_ledger": (
        streamed_ledger,
        with_fixtures(
            "wal_events",
            """WITH whole AS (SELECT *, xid IN (SELECT xid FROM wal_events WHERE tx_end) AS ended FROM wal_events),
            marked AS (SELECT xid, CASE WHEN v < 2 AND op <> 'D' THEN 1 ELSE 0 END AS b FROM whole WHERE ended),
            q AS (SELECT *, max(b) OVER (PARTITION BY xid) AS q FROM marked)
            SELECT CAST(3 AS BIGINT) AS runs, count(*) AS source_event_count, CAST(sum(b) AS BIGINT) AS invalid_event_count,
              CAST(sum(q) AS BIGINT) AS quarantined_event_count,
              count(DISTINCT CASE WHEN q = 1 THEN xid END) AS quarantined_transaction_count,
              (SELECT coalesce(min(lsn) FILTER (WHERE NOT ended) - 1, max(lsn)) FROM whole) AS last_applied_lsn FROM q""",
        ),
    ),
    "stream_errors": (
        streamed_errors,
        with_fixtures(
            "wal_events",
            """SELECT seq AS row_number, 'v' AS field, 'range' AS code, 'logical_cdc' AS strategy,
              'extract_validate_land_wal_delta' AS stage_name
            FROM wal_events WHERE v < 2 AND op <> 'D' AND xid IN (SELECT xid FROM wal_events WHERE tx_end)""",
        ),
    ),
    "drain": (
        drained_stream,
        "SELECT true AS reached_window_end, count(*) AS input_rows FROM events",
    ),
}
