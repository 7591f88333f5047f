"""Scans, landing, validation and hash-diff."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.contracts import DIRTY_LINES, EVENTS, ORDERS
from checks.fixtures import frame, table, with_fixtures
from driftline.contracts import Contract, FieldRule
from driftline.functions.hashing import row_hash
from driftline.operators.diff import ROW_HASH, change_counts, hash_diff, merge_snapshot
from driftline.operators.validation import (
    REJECTED,
    VIOLATIONS,
    explode_errors,
    gate_decisions,
    number_rows,
    split_accepted,
    validate,
    validation_counts,
)
from driftline.plans import Ledger, RunContext, ingest_snapshot, replay
from driftline.plans.snapshot import current_rows
from driftline.shared import scratch_path
from driftline.sources.curated import read_curated, write_curated
from driftline.sources.landing import (
    ERROR_DDL,
    artifact_listing,
    artifact_sizes,
    artifact_total,
    land_accepted,
    land_errors,
    read_landed,
    read_manifest,
    with_artifact_keys,
    write_manifest,
)
from driftline.sources.scan import Source, audit_log_scan, change_event_scan, snapshot_scan

KEY = ["o_orderkey"]
_ORDER_COLUMNS = ", ".join(ORDERS.columns)

# The contract's rules once more, as SQL: one row per violation of each input row.
_VIOLATIONS = """
copies AS (SELECT id, count(*) AS n FROM dirty_lines WHERE id IS NOT NULL GROUP BY id HAVING count(*) > 1),
rows_in AS (SELECT d.*, copies.n FROM dirty_lines d LEFT JOIN copies ON d.id = copies.id),
errors AS (
  SELECT part_no AS row_number, 'id' AS field, 'null_key' AS code, 'key is missing' AS message, 'key' AS "constraint", CAST(NULL AS VARCHAR) AS actual_value FROM rows_in WHERE id IS NULL
  UNION ALL SELECT part_no, 'qty', 'type', 'value is not a int', 'type=int', qty FROM rows_in WHERE TRY_CAST(qty AS INTEGER) IS NULL
  UNION ALL SELECT part_no, 'qty', 'range', 'value is too small', 'min=2', qty FROM rows_in WHERE TRY_CAST(qty AS INTEGER) < 2
  UNION ALL SELECT part_no, 'qty', 'range', 'value is too large', 'max=45', qty FROM rows_in WHERE TRY_CAST(qty AS INTEGER) > 45
  UNION ALL SELECT part_no, 'price', 'not_null', 'value is missing', 'not_null', NULL FROM rows_in WHERE price IS NULL
  UNION ALL SELECT part_no, 'flag', 'allowed', 'value is not allowed', 'allowed=A,N', flag FROM rows_in WHERE flag NOT IN ('A', 'N')
  UNION ALL SELECT part_no, 'state', 'length', 'text is too long', 'max_length=1', state FROM rows_in WHERE length(state) > 1
  UNION ALL SELECT part_no, 'state', 'pattern', 'text does not match', 'pattern=^[FO]', state FROM rows_in WHERE NOT regexp_matches(state, '^[FO]')
  UNION ALL SELECT part_no, '$', 'duplicate_key', 'key occurs more than once', 'unique=id', CAST(n AS VARCHAR) FROM rows_in WHERE n IS NOT NULL
)"""
_ROW_OK = (
    "id IS NOT NULL AND TRY_CAST(qty AS INTEGER) BETWEEN 2 AND 45 AND price IS NOT NULL "
    "AND flag IN ('A', 'N') AND length(state) <= 1 AND regexp_matches(state, '^[FO]') AND n IS NULL"
)


def _validated(spark: SparkSession, sf: str) -> DataFrame:
    return validate(frame(spark, sf, "dirty_lines"), DIRTY_LINES, row_number=F.col("part_no"))


def _context(spark: SparkSession, contract, strategy: str, folder: str, mode: str = "ingest") -> RunContext:
    return RunContext(
        spark,
        contract,
        strategy,
        "sales",
        contract.contract_id,
        f"{folder}/landing",
        f"{folder}/curated",
        Ledger(spark, f"{folder}/ledger"),
        run_mode=mode,
    )


def snapshot_scan_rows(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_scan(spark, Source(path=sf), "orders.parquet", ORDERS)


def audit_log_scan_rows(spark: SparkSession, sf: str) -> DataFrame:
    source = Source(path=sf)
    return audit_log_scan(spark, source, "events.parquet", EVENTS, "event_type", "event_id", "ts", "ts")


def change_event_scan_rows(spark: SparkSession, sf: str) -> DataFrame:
    feed = frame(spark, sf, "wal_events").withColumnsRenamed({"k": "user_id", "v": "value"})
    return change_event_scan(feed, EVENTS, start_lsn=4294967296 + 64 * 100, table="click")


def landed_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "landed")
    land_accepted(frame(spark, sf, "src_orders"), path, rows_per_file=5_000_000)
    return read_landed(spark, path, ORDERS)


def landed_errors(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "errors")
    land_errors(explode_errors(_validated(spark, sf)), path)
    return spark.read.schema(ERROR_DDL).json(path)


def manifest_row(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "manifest")
    counts = validation_counts(_validated(spark, sf)).first()
    write_manifest(
        spark,
        path,
        run_id="r1",
        contract_version=DIRTY_LINES.version,
        source_count=counts["source_row_count"],
        accepted_count=counts["accepted_row_count"],
        invalid_count=counts["invalid_row_count"],
        error_count=counts["error_count"],
    )
    return read_manifest(spark, path).select(
        "run_id", "contract_version", "source_count", "accepted_count", "invalid_count", "error_count"
    )


def curated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions: the second rewrites only the buckets of changed keys."""
    root = scratch_path(spark, "curated")
    first = write_curated(frame(spark, sf, "cur_orders"), root, KEY, "r1", buckets=8)
    old = read_curated(spark, root, first, buckets=[1, 4])
    changed = old.withColumn("o_custkey", F.col("o_custkey") + 1)
    second = write_curated(changed, root, KEY, "r2", previous=first, only=[1, 4])
    new = read_curated(spark, root, second)
    return new.groupBy("o_orderkey").agg(
        F.count("*").alias("copies"), F.max("o_orderpriority").alias("o_orderpriority")
    )


def artifact_bytes(spark: SparkSession, sf: str) -> DataFrame:
    return artifact_sizes(frame(spark, sf, "payloads"), frame(spark, sf, "listing"), ["id"])


def artifact_totals(spark: SparkSession, sf: str) -> DataFrame:
    return artifact_total(frame(spark, sf, "payloads"), frame(spark, sf, "listing"), ["id"])


def landed_listing(spark: SparkSession, sf: str) -> DataFrame:
    """Artifacts of one landing per order status, as found under the landing root."""
    root = scratch_path(spark, "listing")
    orders = table(spark, sf, "orders")
    for status in ("F", "O", "P"):
        land_accepted(orders.filter(F.col("o_orderstatus") == status), f"{root}/s/t/run_id={status}/accepted.gz")
    listed = artifact_listing(spark, root)
    return listed.select("artifact_key", (F.col("size_bytes") > 0).alias("has_bytes"))


def validated_rows(spark: SparkSession, sf: str) -> DataFrame:
    codes = F.array_join(F.transform(VIOLATIONS, lambda v: F.concat_ws(":", v["field"], v["code"])), ",")
    return _validated(spark, sf).select(
        "id", "qty", "part_no", F.size(VIOLATIONS).cast("bigint").alias("violations"), codes.alias("codes")
    )


def accepted_rows(spark: SparkSession, sf: str) -> DataFrame:
    accepted, _ = split_accepted(_validated(spark, sf))
    return accepted.select(*DIRTY_LINES.columns)


def rejected_rows(spark: SparkSession, sf: str) -> DataFrame:
    _, rejected = split_accepted(_validated(spark, sf))
    return rejected.select("part_no", "id", "price")


def violation_rows(spark: SparkSession, sf: str) -> DataFrame:
    return explode_errors(_validated(spark, sf))


def validation_count_row(spark: SparkSession, sf: str) -> DataFrame:
    return validation_counts(_validated(spark, sf))


def gate_rows(spark: SparkSession, sf: str) -> DataFrame:
    stages = (
        _validated(spark, sf)
        .groupBy("part_no")
        .agg(F.count_if(REJECTED).alias("invalid_row_count"))
        .withColumn("policy", F.when(F.col("part_no") % 2 == 0, "fail").otherwise("quarantine"))
    )
    return gate_decisions(stages, "invalid_row_count")


def numbered_rows(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return number_rows(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "_row_number")


def row_fingerprint_classes(spark: SparkSession, sf: str) -> DataFrame:
    """As many fingerprints as distinct rows, per order status, NULLs included."""
    rows = frame(spark, sf, "src_orders").withColumn("o_totalprice", F.col("o_totalprice") % 10)
    columns = ["o_custkey", "o_totalprice", "o_orderpriority"]
    return (
        rows.groupBy("o_orderstatus")
        .agg(F.count_distinct(row_hash(rows, columns)).alias("fingerprints"))
        .select("o_orderstatus", "fingerprints")
    )


def row_fingerprint_sha256(spark: SparkSession, sf: str) -> DataFrame:
    documents = table(spark, sf, "documents")
    fingerprint = row_hash(documents, ["text", "lang", "source"], "sha256")
    return documents.select("doc_id", fingerprint.alias("fingerprint"))


def hash_diff_rows(spark: SparkSession, sf: str) -> DataFrame:
    return hash_diff(frame(spark, sf, "src_orders"), frame(spark, sf, "cur_orders"), KEY)


def hash_diff_actions(spark: SparkSession, sf: str) -> DataFrame:
    return hash_diff_rows(spark, sf).groupBy("action").agg(F.count("*").alias("n"))


def hash_diff_counts(spark: SparkSession, sf: str) -> DataFrame:
    return change_counts(hash_diff_rows(spark, sf))


def hash_diff_protected(spark: SparkSession, sf: str) -> DataFrame:
    new, old, bad = (frame(spark, sf, n) for n in ("src_orders", "cur_orders", "bad_orders"))
    return hash_diff(new, old, KEY, rejected=bad)


def merged_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    new, old, bad = (frame(spark, sf, n) for n in ("src_orders", "cur_orders", "bad_orders"))
    old = old.withColumn("_run_id", F.lit("r1"))
    return merge_snapshot(new, old, KEY, "r2", rejected=bad).drop(ROW_HASH)


def keyed_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = frame(spark, sf, "requests").select(
        "request_id", "strategy", "namespace", "name", F.col("parent_run_id").alias("run_id")
    )
    return with_artifact_keys(runs)


def snapshot_run(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs through landing, merge and ledger: the state is the second snapshot."""
    folder = scratch_path(spark, "snapshot-run")
    ingest_snapshot(_context(spark, ORDERS, "hash_diff", folder), frame(spark, sf, "cur_orders"), buckets=4)
    second = _context(spark, ORDERS, "hash_diff", folder)
    ingest_snapshot(second, frame(spark, sf, "src_orders"), buckets=4)
    return current_rows(second)


def replay_snapshot_run(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot with rejected rows, merged and merged again by replay: their keys stay."""
    folder = scratch_path(spark, "replay-snapshot")
    last = FieldRule("o_orderpriority", "string", nullable=False)
    strict = Contract("orders", "1.0.0", (*ORDERS.fields[:-1], last), ORDERS.keys)
    ingest_snapshot(_context(spark, ORDERS, "hash_diff", folder), frame(spark, sf, "cur_orders"), buckets=4)
    run = _context(spark, strict, "hash_diff", folder)
    ingest_snapshot(run, frame(spark, sf, "src_orders"), buckets=4)
    again = _context(spark, strict, "hash_diff", folder, mode="replay")
    replay(again, run.keys["accepted_key"])
    return current_rows(again)


def snapshot_run_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """Counts the ledger keeps of a first and a second snapshot run."""
    folder = scratch_path(spark, "snapshot-ledger")
    first = _context(spark, ORDERS, "hash_diff", folder)
    ingest_snapshot(first, frame(spark, sf, "cur_orders"), buckets=4)
    second = _context(spark, ORDERS, "hash_diff", folder)
    ingest_snapshot(second, frame(spark, sf, "src_orders"), buckets=4)
    step = F.when(F.col("run_id") == first.run_id, 1).otherwise(2).cast("bigint")
    counts = ["read_count", "insert_count", "update_count", "delete_count", "unchanged_count"]
    return second.ledger.runs().select(step.alias("step"), "status", *counts)


_DIFF = """joined AS (
  SELECT coalesce(s.o_orderkey, c.o_orderkey) AS o_orderkey,
    CASE WHEN c.o_orderkey IS NULL THEN 'insert' WHEN s.o_orderkey IS NULL THEN 'delete'
      WHEN s.o_custkey IS DISTINCT FROM c.o_custkey OR s.o_orderstatus IS DISTINCT FROM c.o_orderstatus
        OR s.o_totalprice IS DISTINCT FROM c.o_totalprice OR s.o_orderdate IS DISTINCT FROM c.o_orderdate
        OR s.o_orderpriority IS DISTINCT FROM c.o_orderpriority THEN 'update'
      ELSE 'unchanged' END AS action
  FROM src_orders s FULL OUTER JOIN cur_orders c ON s.o_orderkey = c.o_orderkey)"""
_COUNTS = """count(*) FILTER (action IN ('insert', 'update', 'unchanged')) AS read_count,
  count(*) FILTER (action = 'insert') AS insert_count, count(*) FILTER (action = 'update') AS update_count,
  count(*) FILTER (action = 'delete') AS delete_count, count(*) FILTER (action = 'unchanged') AS unchanged_count"""
_DIRTY_COUNTS = f"""count(*) AS source_row_count, count(*) FILTER (NOT coalesce({_ROW_OK}, false)) AS invalid_row_count,
  count(*) FILTER (coalesce({_ROW_OK}, false)) AS accepted_row_count"""
_PATHS = """'sales/' || name || '/run_id=' || parent_run_id || '/' ||
  CASE strategy WHEN 'hash_diff' THEN 'accepted/' WHEN 'incremental_audit' THEN 'delta/' ELSE 'wal_delta/' END"""
_MEMBERS = """members AS (
  SELECT id, 'error_object_key' AS metric_key, trim(json_extract_string(payload, '$.error_object_key')) AS artifact_key FROM payloads
  UNION ALL SELECT id, 'validation_error_object_key', trim(json_extract_string(payload, '$.validation_error_object_key')) FROM payloads
  UNION ALL SELECT id, 'validation_manifest_key', trim(json_extract_string(payload, '$.validation_manifest_key')) FROM payloads
  UNION ALL SELECT id, 'delta_object_key', trim(json_extract_string(payload, '$.delta_object_key')) FROM payloads)"""

QUERIES = {
    "snapshot_scan": (snapshot_scan_rows, f"SELECT {_ORDER_COLUMNS} FROM orders"),
    "audit_log_scan": (
        audit_log_scan_rows,
        "SELECT event_id AS audit_id, event_type AS op, ts AS commit_timestamp, ts AS recorded_at, user_id, value FROM events",
    ),
    "change_event_scan": (
        change_event_scan_rows,
        with_fixtures(
            "wal_events",
            "SELECT lsn, xid, seq, op, k AS user_id, v AS value FROM wal_events "
            "WHERE lsn > 4294967296 + 64 * 100 AND source_table = 'click'",
        ),
    ),
    "landed_snapshot": (landed_snapshot, with_fixtures("src_orders", "SELECT * FROM src_orders")),
    "landed_errors": (landed_errors, with_fixtures("dirty_lines", f"WITH {_VIOLATIONS} SELECT * FROM errors")),
    "manifest": (
        manifest_row,
        with_fixtures(
            "dirty_lines",
            f"""WITH {_VIOLATIONS} SELECT 'r1' AS run_id, '1.0.0' AS contract_version, source_row_count AS source_count,
            accepted_row_count AS accepted_count, invalid_row_count AS invalid_count,
            (SELECT count(*) FROM errors) AS error_count FROM (SELECT {_DIRTY_COUNTS} FROM rows_in) t""",
        ),
    ),
    "curated_versions": (
        curated_rows,
        with_fixtures(
            "cur_orders", "SELECT o_orderkey, CAST(1 AS BIGINT) AS copies, o_orderpriority FROM cur_orders"
        ),
    ),
    "artifact_sizes": (
        artifact_bytes,
        with_fixtures(
            "payloads listing",
            f"WITH {_MEMBERS} SELECT id, metric_key, artifact_key, size_bytes FROM members JOIN listing USING (artifact_key)",
        ),
    ),
    "artifact_total": (
        artifact_totals,
        with_fixtures(
            "payloads listing",
            f"""WITH {_MEMBERS} SELECT id, CAST(sum(size_bytes) AS BIGINT) AS artifact_total_bytes
            FROM members JOIN listing USING (artifact_key) GROUP BY id""",
        ),
    ),
    "artifact_listing": (
        landed_listing,
        "SELECT DISTINCT 's/t/run_id=' || o_orderstatus || '/accepted.gz' AS artifact_key, true AS has_bytes FROM orders",
    ),
    "validate": (
        validated_rows,
        with_fixtures(
            "dirty_lines",
            f"""WITH {_VIOLATIONS} SELECT id, TRY_CAST(qty AS INTEGER) AS qty, part_no,
            CAST(len(codes) AS BIGINT) AS violations, array_to_string(codes, ',') AS codes FROM (
              SELECT *, list_filter([
                CASE WHEN id IS NULL THEN 'id:null_key' END,
                CASE WHEN TRY_CAST(qty AS INTEGER) IS NULL THEN 'qty:type' END,
                CASE WHEN TRY_CAST(qty AS INTEGER) < 2 THEN 'qty:range' END,
                CASE WHEN TRY_CAST(qty AS INTEGER) > 45 THEN 'qty:range' END,
                CASE WHEN price IS NULL THEN 'price:not_null' END,
                CASE WHEN flag NOT IN ('A', 'N') THEN 'flag:allowed' END,
                CASE WHEN length(state) > 1 THEN 'state:length' END,
                CASE WHEN NOT regexp_matches(state, '^[FO]') THEN 'state:pattern' END,
                CASE WHEN n IS NOT NULL THEN '$:duplicate_key' END], lambda x: x IS NOT NULL) AS codes
              FROM rows_in) t""",
        ),
    ),
    "split_accepted": (
        accepted_rows,
        with_fixtures(
            "dirty_lines",
            f"WITH {_VIOLATIONS} SELECT id, CAST(qty AS INTEGER) AS qty, price, flag, state FROM rows_in WHERE {_ROW_OK}",
        ),
    ),
    "split_rejected": (
        rejected_rows,
        with_fixtures(
            "dirty_lines", f"WITH {_VIOLATIONS} SELECT part_no, id, price FROM rows_in WHERE NOT coalesce({_ROW_OK}, false)"
        ),
    ),
    "explode_errors": (violation_rows, with_fixtures("dirty_lines", f"WITH {_VIOLATIONS} SELECT * FROM errors")),
    "validation_counts": (
        validation_count_row,
        with_fixtures(
            "dirty_lines",
            f"WITH {_VIOLATIONS} SELECT {_DIRTY_COUNTS}, (SELECT count(*) FROM errors) AS error_count FROM rows_in",
        ),
    ),
    "validation_gate": (
        gate_rows,
        with_fixtures(
            "dirty_lines",
            f"""WITH {_VIOLATIONS} SELECT part_no, n AS invalid_row_count,
            CASE WHEN part_no % 2 = 0 THEN 'fail' ELSE 'quarantine' END AS policy,
            part_no % 2 = 1 OR n = 0 AS passed FROM (
              SELECT part_no, count(*) FILTER (NOT coalesce({_ROW_OK}, false)) AS n FROM rows_in GROUP BY part_no) t""",
        ),
    ),
    "number_rows": (
        numbered_rows,
        "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS _row_number FROM orders",
    ),
    "row_hash": (
        row_fingerprint_classes,
        with_fixtures(
            "src_orders",
            """SELECT o_orderstatus, count(*) AS fingerprints FROM (
            SELECT DISTINCT o_orderstatus, o_custkey, o_totalprice % 10 AS p, o_orderpriority FROM src_orders) t GROUP BY 1""",
        ),
    ),
    "row_hash_sha256": (
        row_fingerprint_sha256,
        """SELECT doc_id, sha256(coalesce(length(text) || ':' || text, '~') || coalesce(length(lang) || ':' || lang, '~')
        || coalesce(length(source) || ':' || source, '~')) AS fingerprint FROM documents""",
    ),
    "hash_diff": (hash_diff_rows, with_fixtures("src_orders cur_orders", f"WITH {_DIFF} SELECT * FROM joined")),
    "hash_diff_actions": (
        hash_diff_actions,
        with_fixtures("src_orders cur_orders", f"WITH {_DIFF} SELECT action, count(*) AS n FROM joined GROUP BY action"),
    ),
    "change_counts": (
        hash_diff_counts,
        with_fixtures("src_orders cur_orders", f"WITH {_DIFF} SELECT {_COUNTS} FROM joined"),
    ),
    "hash_diff_protected": (
        hash_diff_protected,
        with_fixtures(
            "src_orders cur_orders bad_orders",
            f"""WITH {_DIFF} SELECT o_orderkey, CASE WHEN action = 'delete' AND o_orderkey IN (SELECT o_orderkey FROM bad_orders)
            THEN 'protected' ELSE action END AS action FROM joined""",
        ),
    ),
    "merge_snapshot": (
        merged_snapshot,
        with_fixtures(
            "src_orders cur_orders bad_orders",
            f"""WITH {_DIFF} SELECT s.*, CASE action WHEN 'unchanged' THEN 'r1' ELSE 'r2' END AS _run_id, action AS _change
            FROM src_orders s JOIN joined USING (o_orderkey)
            UNION ALL SELECT c.*, 'r1', 'protected' FROM cur_orders c
            WHERE o_orderkey IN (SELECT o_orderkey FROM bad_orders)
              AND NOT EXISTS (SELECT 1 FROM src_orders s WHERE s.o_orderkey = c.o_orderkey)""",
        ),
    ),
    "artifact_keys": (
        keyed_runs,
        with_fixtures(
            "requests",
            f"""SELECT request_id, strategy, namespace, name, parent_run_id AS run_id,
            {_PATHS} || CASE strategy WHEN 'hash_diff' THEN 'accepted_snapshot' ELSE 'accepted_delta' END || '.ndjson.gz' AS accepted_key,
            {_PATHS} || 'errors.ndjson.gz' AS error_key, {_PATHS} || 'manifest.json' AS manifest_key FROM requests""",
        ),
    ),
    "snapshot_run": (snapshot_run, with_fixtures("src_orders", "SELECT * FROM src_orders")),
    "replay_snapshot_run": (
        replay_snapshot_run,
        with_fixtures(
            "src_orders cur_orders",
            """SELECT * FROM src_orders WHERE o_orderpriority IS NOT NULL
            UNION ALL SELECT c.* FROM cur_orders c JOIN src_orders s USING (o_orderkey) WHERE s.o_orderpriority IS NULL""",
        ),
    ),
    "snapshot_run_ledger": (
        snapshot_run_ledger,
        with_fixtures(
            "src_orders cur_orders",
            f"""WITH {_DIFF} SELECT CAST(1 AS BIGINT) AS step, 'success' AS status, count(*) AS read_count, count(*) AS insert_count,
            CAST(0 AS BIGINT) AS update_count, CAST(0 AS BIGINT) AS delete_count, CAST(0 AS BIGINT) AS unchanged_count FROM cur_orders
            UNION ALL SELECT 2, 'success', {_COUNTS} FROM joined""",
        ),
    ),
}
