"""Inputs derived from the test tables, as column expressions both engines read.

The same text builds the Spark frame and the SQL of the oracle, so both sides start
from equal rows and only the operators differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

_STRATEGY = (
    "CASE {k} % 3 WHEN 0 THEN 'hash_diff' WHEN 1 THEN 'incremental_audit' ELSE 'logical_cdc' END"
)
_BY_CUSTOMER = _STRATEGY.format(k="o_custkey")
_PIPELINE = f"'sales.t' || CAST(o_custkey % 40 AS STRING) || '.' || {_BY_CUSTOMER}"
_RUN_MODE = "CASE WHEN o_orderkey % 9 = 0 THEN 'replay' ELSE 'ingest' END"
_FINISHED = (
    "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + (o_orderkey % 600 + 1) * INTERVAL '1' SECOND END"
)
_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'O' THEN 'failed' ELSE 'running' END"
_RUN_METRICS = """'{"source_row_count":' || CAST(o_orderkey AS STRING) ||
    ',"invalid_row_count":' || CAST(o_orderkey % 5 AS STRING) ||
    CASE WHEN o_orderkey % 3 = 0 THEN ',"problem_summary":{"invalid_record_count":' || CAST(o_orderkey % 2 AS STRING) || '}' ELSE '' END ||
    CASE WHEN o_orderkey % 4 = 0 THEN ',"quarantined_event_count":3' ELSE '' END ||
    CASE WHEN o_orderkey % 8 = 0 THEN ',"artifact_total_bytes":' || CAST(o_orderkey * 10 AS STRING) ELSE '' END ||
    CASE WHEN o_orderkey % 6 = 0 THEN ',"error_object_key":"k/' || CAST(o_orderkey AS STRING) || '"' ELSE '' END ||
    '}'"""
_RUN_ERROR = "CASE WHEN o_orderstatus = 'O' THEN 'Pipeline failed at stages: s' || CAST(o_orderkey % 4 AS STRING) END"
_OP = "CASE event_type WHEN 'signup' THEN 'I' WHEN 'error' THEN 'D' ELSE 'U' END"
_STAGE = """CASE l_linenumber WHEN 1 THEN 'ensure_source_logical_cdc_capture'
    WHEN 2 THEN 'extract_validate_land_wal_delta' WHEN 3 THEN 'apply_delta'
    WHEN 4 THEN 'persist_checkpoint' ELSE 'ack_replication_slot' END"""
# One list of tasks per strategy of the run, so every run misses some of its own.
_TASK = """CASE l_orderkey % 3
    WHEN 0 THEN CASE l_linenumber WHEN 1 THEN 'fetch_contract' WHEN 2 THEN 'read_checkpoint' WHEN 3 THEN 'start_run'
        WHEN 4 THEN 'extract_validate_land' WHEN 5 THEN 'merge_curated' WHEN 6 THEN 'persist_checkpoint_task'
        ELSE CASE WHEN l_orderkey % 4 = 0 THEN 'merge_curated_replay' ELSE 'merge_curated' END END
    WHEN 1 THEN CASE l_linenumber WHEN 1 THEN 'fetch_contract' WHEN 2 THEN 'read_checkpoint' WHEN 3 THEN 'start_run'
        WHEN 4 THEN 'extract_validate_land_delta' WHEN 5 THEN 'apply_delta' WHEN 6 THEN 'persist_checkpoint_task'
        ELSE CASE WHEN l_orderkey % 4 = 0 THEN 'apply_delta_replay' ELSE 'apply_delta' END END
    ELSE CASE l_linenumber WHEN 1 THEN 'fetch_contract' WHEN 2 THEN 'read_checkpoint' WHEN 3 THEN 'ack_replication_slot'
        WHEN 4 THEN 'extract_validate_land_wal_delta' WHEN 5 THEN 'apply_delta' WHEN 6 THEN 'persist_checkpoint_task'
        ELSE CASE WHEN l_orderkey % 4 = 0 THEN 'apply_delta_replay' ELSE 'apply_delta' END END END"""
_RESULT = """CASE WHEN l_linenumber IN (1, 2) THEN '{}'
    WHEN l_linenumber = 4 AND l_orderkey % 5 = 0 THEN '{}'
    WHEN l_linenumber = 4 THEN '{"source_row_count":' || CAST(l_orderkey AS STRING) || ',"source_event_count":'
        || CAST(l_orderkey % 2 * l_orderkey AS STRING) || ',"error_object_key":"e/' || CAST(l_orderkey AS STRING) || '"}'
    WHEN l_linenumber IN (5, 7) THEN '{"read_count":' || CAST(l_orderkey % 100 + l_linenumber AS STRING)
        || ',"insert_count":' || CAST(l_orderkey % 7 AS STRING) || ',"update_count":"'
        || CAST(l_orderkey % 11 AS STRING) || '","delete_count":' || CAST(l_orderkey % 3 AS STRING) || '}'
    ELSE '{"status":"success"}' END"""
_PAYLOAD = """'{"source_row_count":' || CASE WHEN o_orderkey % 10 = 0 THEN '"x"' ELSE CAST(o_orderkey AS STRING) END ||
    ',"source_event_count":"' || CAST(o_custkey AS STRING) || '"' ||
    CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE ',"read_count":' || CAST(o_orderkey % 50 AS STRING) END ||
    ',"insert_count":' || CAST(o_orderkey % 7 AS STRING) ||
    CASE WHEN o_orderkey % 4 = 0 THEN ',"update_count":""' ELSE ',"update_count":"' || CAST(o_orderkey % 3 AS STRING) || '"' END ||
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE ',"delete_count":' || CAST(o_orderkey % 2 AS STRING) END ||
    ',"source_read_seconds":' || CAST(o_orderkey % 8 AS STRING) ||
    ',"total_seconds":"' || CAST(o_orderkey % 16 + 1 AS STRING) || '"' ||
    CASE WHEN o_orderkey % 3 = 0 THEN ',"invalid_row_count":' || CAST(o_orderkey % 4 AS STRING) ELSE '' END ||
    CASE WHEN o_orderkey % 9 = 0 THEN ',"invalid_event_count":2' ELSE '' END ||
    CASE WHEN o_orderkey % 12 = 0 THEN ',"quarantined_transaction_count":1' ELSE '' END ||
    CASE WHEN o_orderstatus = 'O' THEN ',"failed_tasks":["a","b"]' ELSE '' END ||
    CASE WHEN o_orderkey % 13 = 0 THEN ',"validation_error_object_key":"  "' ELSE '' END ||
    ',"error_object_key":" e/' || CAST(o_orderkey % 100 AS STRING) || ' "' ||
    ',"manifest_key":"m/' || CAST(o_orderkey % 100 AS STRING) || '"' ||
    ',"validation_manifest_key":"m/' || CAST(o_orderkey % 100 AS STRING) || '"' ||
    ',"delta_object_key":"d/' || CAST(o_custkey AS STRING) || '"' || '}'"""

# name: (table, column expressions, condition, grouping)
FIXTURES: dict[str, tuple[str, list[str], str | None, str | None]] = {
    # The new snapshot: %11 rows vanish, %7 and %17 rows change.
    "src_orders": (
        "orders",
        [
            "o_orderkey",
            "o_custkey",
            "o_orderstatus",
            "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice",
            "o_orderdate",
            "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority",
        ],
        "o_orderkey % 11 <> 0",
        None,
    ),
    # The curated state before the run: %13 rows are missing.
    "cur_orders": (
        "orders",
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        "o_orderkey % 13 <> 0",
        None,
    ),
    # Keys that broke the contract: some of the vanished ones.
    "bad_orders": ("orders", ["o_orderkey"], "o_orderkey % 33 = 0", None),
    # Trigger-style change log; commit times are sometimes unknown or out of order.
    "audit_events": (
        "events",
        [
            "event_id AS audit_id",
            "user_id AS k",
            f"{_OP} AS op",
            "value AS v",
            "CASE WHEN event_id % 20 = 0 THEN NULL ELSE ts - (event_id % 5) * INTERVAL '1' SECOND END AS commit_timestamp",
            "ts AS recorded_at",
            "date_trunc('hour', ts) AS hour_at",
        ],
        None,
        None,
    ),
    # Decoded change events, 4 per transaction, some moving their key, some bad.
    "wal_events": (
        "events",
        [
            "event_id AS seq",
            "CAST(floor(event_id / 4) AS BIGINT) AS xid",
            "CAST(4294967296 + event_id * 64 AS BIGINT) AS lsn",
            "ts AS commit_ts",
            "event_type AS source_table",
            f"{_OP} AS op",
            "user_id AS k",
            "CASE WHEN event_type = 'click' AND event_id % 10 = 0 THEN user_id + 1 END AS old_k",
            "value AS v",
            "CASE WHEN value < 2 THEN 1 ELSE 0 END AS bad",
            "event_id % 4 = 3 AS tx_end",
        ],
        None,
        None,
    ),
    # Curated state the change events apply to.
    "cur_users": ("events", ["user_id AS k", "max(value) AS v"], "user_id % 4 <> 0", "user_id"),
    "run_audit": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS run_id",
            f"{_PIPELINE} AS pipeline_id",
            f"{_BY_CUSTOMER} AS strategy",
            f"{_RUN_MODE} AS run_mode",
            "'c' || CAST(o_custkey % 7 AS STRING) AS contract_id",
            "'1.' || CAST(o_custkey % 5 AS STRING) AS version",
            "o_orderpriority AS checksum",
            "o_orderdate AS started_at",
            f"{_FINISHED} AS finished_at",
            "o_orderkey % 1000 AS read_count",
            "o_orderkey % 10 AS insert_count",
            "o_orderkey % 20 AS update_count",
            "o_orderkey % 30 AS delete_count",
            "o_orderkey % 40 AS unchanged_count",
            f"{_STATUS} AS status",
            f"{_RUN_METRICS} AS metrics_json",
            f"{_RUN_ERROR} AS error_text",
        ],
        None,
        None,
    ),
    # Several attempts per stage; (started_at, attempt_id, attempt_sub, tb) breaks ties.
    "stage_attempts": (
        "lineitem",
        [
            "CAST(l_orderkey AS STRING) AS run_id",
            f"{_STAGE} AS stage_name",
            "l_shipdate AS started_at",
            "l_partkey AS attempt_id",
            "l_suppkey AS attempt_sub",
            "l_extendedprice AS tb",
            "CASE l_returnflag WHEN 'R' THEN 'failed' ELSE 'success' END AS status",
        ],
        "l_linenumber <= 5",
        None,
    ),
    # Stage records for the views, some of runs that do not exist.
    "stage_rows": (
        "lineitem",
        [
            "CASE WHEN l_partkey % 19 = 0 THEN 'x' ELSE '' END || CAST(l_orderkey AS STRING) AS run_id",
            f"{_STAGE} AS stage_name",
            "CASE l_returnflag WHEN 'R' THEN 'failed' WHEN 'A' THEN 'running' ELSE 'success' END AS status",
            "l_shipdate AS started_at",
            "CASE WHEN l_returnflag <> 'A' THEN l_shipdate + (l_partkey % 90) * INTERVAL '1' SECOND END AS finished_at",
            """CASE WHEN l_linenumber = 1 THEN NULL ELSE '{"invalid_event_count":' || CAST(l_suppkey % 3 AS STRING) ||
                CASE WHEN l_partkey % 4 = 0 THEN ',"problem_summary":{"invalid_transaction_count":"1","quarantined_transaction_count":2}' ELSE '' END ||
                CASE WHEN l_partkey % 5 = 0 THEN ',"quarantined_transaction_count":7,"validation_error_object_key":"v"' ELSE '' END ||
                ',"error_object_key":"e","artifact_total_bytes":' || CAST(l_partkey AS STRING) || '}' END AS metrics_json""",
            "CASE l_returnflag WHEN 'R' THEN 'boom' END AS error_text",
        ],
        None,
        None,
    ),
    # Raw lines of error artifacts: non-objects, numeric text and blank fields.
    "error_lines": (
        "lineitem",
        [
            "CAST(l_orderkey % 50 AS STRING) AS run_id",
            "CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '/' || CAST(l_extendedprice AS STRING) AS part",
            "l_partkey AS line_no",
            "l_suppkey AS line_sub",
            "l_orderkey AS place_a",
            "l_linenumber AS place_b",
            "CAST(round(l_extendedprice * 100) AS BIGINT) AS place_c",
            """CASE WHEN l_partkey % 97 = 0 THEN '[1,2]'
                WHEN l_partkey % 89 = 0 THEN '   '
                WHEN l_orderkey % 50 = 7 AND l_partkey % 151 = 0 THEN '{"row_number":1,'
                WHEN l_partkey % 5 = 0 THEN '{"row_number":"' || CAST(l_suppkey AS STRING) || '","field":"","actual_value":"  "}'
                WHEN l_partkey % 7 = 0 THEN '{"row_number":"n/a","field":0,"code":false,"message":null,"constraint":0,"actual_value":""}'
                ELSE '{"row_number":' || CAST(l_suppkey AS STRING) ||
                    ',"field":"l_qty","code":"range","message":"m","constraint":" max=10 ","actual_value":' ||
                    CAST(CAST(l_quantity AS INT) AS STRING) || '}' END AS line""",
        ],
        None,
        None,
    ),
    # A snapshot with missing and repeated keys and values that break the contract.
    "dirty_lines": (
        "lineitem",
        [
            "CASE WHEN l_partkey % 41 = 0 THEN NULL ELSE l_orderkey * 10 + l_linenumber END AS id",
            "CASE WHEN l_partkey % 29 = 0 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS qty",
            "CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE l_extendedprice END AS price",
            "l_returnflag AS flag",
            "l_linestatus || CASE WHEN l_suppkey % 23 = 0 THEN '?' ELSE '' END AS state",
            "l_partkey AS part_no",
        ],
        None,
        None,
    ),
    # Metric payloads with text numbers, blanks and unreadable members.
    "payloads": (
        "orders",
        [
            "o_orderkey AS id",
            f"{_BY_CUSTOMER} AS strategy",
            f"{_RUN_MODE} AS run_mode",
            f"{_PIPELINE} AS pipeline_id",
            "CAST(o_orderkey AS STRING) AS run_id",
            f"{_PAYLOAD} AS payload",
        ],
        None,
        None,
    ),
    # Landed artifacts known to exist.
    "listing": ("customer", ["'d/' || CAST(c_custkey AS STRING) AS artifact_key", "c_custkey * 7 + 1 AS size_bytes"], "c_custkey % 3 <> 0", None),
    # Checkpoint history; one pipeline owns a third of it.
    "checkpoints": (
        "events",
        [
            "CASE WHEN event_id % 3 = 0 THEN 'hot' ELSE 'p' || CAST(user_id % 40 AS STRING) END AS pipeline_id",
            "CAST(event_id AS STRING) AS run_id",
            "'{\"n\":' || CAST(event_id AS STRING) || '}' AS checkpoint_json",
            "date_trunc('hour', ts) AS updated_at",
        ],
        None,
        None,
    ),
    # Start and finish records of runs; some runs finish twice, some never start.
    "run_events": (
        "lineitem",
        [
            "CAST(l_orderkey AS STRING) AS run_id",
            "CASE WHEN l_linenumber = 1 THEN 'start' ELSE 'finish' END AS event",
            "l_shipdate + l_partkey * INTERVAL '1' SECOND + l_suppkey * INTERVAL '1' MILLISECOND AS at",
            "'p' || CAST(l_orderkey % 40 AS STRING) AS pipeline_id",
            f"{_STRATEGY.format(k='l_orderkey')} AS strategy",
            "'ingest' AS run_mode",
            "'c' AS contract_id",
            "'1' AS version",
            "CAST(l_partkey AS STRING) AS checksum",
            "l_partkey AS read_count",
            "l_suppkey AS insert_count",
            "l_partkey % 5 AS update_count",
            "CASE WHEN l_partkey % 2 = 0 THEN l_partkey END AS delete_count",
            "l_partkey % 7 AS unchanged_count",
            "CASE l_returnflag WHEN 'R' THEN 'failed' ELSE 'success' END AS status",
            "'{}' AS metrics_json",
            "CASE l_returnflag WHEN 'R' THEN 'boom' END AS error_text",
        ],
        None,
        None,
    ),
    # Runs and the results of their finished tasks.
    "closing_runs": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS run_id",
            "'p' || CAST(o_orderkey % 40 AS STRING) AS pipeline_id",
            f"{_STRATEGY.format(k='o_orderkey')} AS strategy",
            "CASE WHEN o_orderkey % 4 = 0 THEN 'replay' ELSE 'ingest' END AS run_mode",
        ],
        None,
        None,
    ),
    "task_results": (
        "lineitem",
        [
            "CAST(l_orderkey AS STRING) AS run_id",
            f"{_TASK} AS task_id",
            f"{_RESULT} AS payload",
            # The seventh result repeats the fifth's task, before it or after it.
            "CASE WHEN l_linenumber = 7 AND l_orderkey % 2 = 0 THEN 0 ELSE l_linenumber END AS told_at",
        ],
        None,
        None,
    ),
    "closing_stages": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS run_id",
            "CASE o_orderkey % 3 WHEN 0 THEN 'extract_validate_land' WHEN 1 THEN 'extract_validate_land_delta' "
            "ELSE 'extract_validate_land_wal_delta' END AS stage_name",
            "CASE WHEN o_orderstatus = 'O' THEN 'failed' ELSE 'success' END AS status",
            """'{"source_row_count":' || CAST(o_custkey AS STRING) || ',"source_event_count":"' || CAST(o_custkey AS STRING)
                || '"' || CASE WHEN o_custkey % 2 = 0 THEN ',"validation_error_object_key":"v/' || CAST(o_custkey AS STRING) || '"' ELSE '' END
                || CASE WHEN o_custkey % 5 = 0 THEN '' ELSE ',"delta_object_key":"d/' || CAST(o_custkey AS STRING) || '"' END
                || CASE WHEN o_custkey % 7 = 0 THEN '' ELSE ',"manifest_key":" m/' || CAST(o_custkey AS STRING) || '"' END
                || '}' AS metrics_json""",
        ],
        None,
        None,
    ),
    # Replay requests of every kind: explicit key, parent run, both, neither.
    "requests": (
        "lineitem",
        [
            "CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) || '-' || CAST(l_partkey AS STRING) "
            "|| '-' || CAST(l_suppkey AS STRING) AS request_id",
            f"{_STRATEGY.format(k='(l_orderkey + l_linenumber)')} AS strategy",
            "'sales' AS namespace",
            "'t' || CAST(l_suppkey AS STRING) AS name",
            "CASE WHEN l_linenumber = 1 THEN ' s/t/run_id=' || CAST(l_orderkey AS STRING) || '/accepted/accepted_snapshot.ndjson.gz'"
            " WHEN l_linenumber = 2 AND l_partkey % 3 = 0 THEN 'odd/key.gz' WHEN l_linenumber = 3 THEN '  ' END AS object_key",
            "CASE WHEN l_linenumber = 1 AND l_partkey % 5 <> 0 THEN NULL WHEN l_linenumber = 4 AND l_partkey % 4 = 0 THEN ' '"
            " WHEN l_linenumber = 5 THEN CAST(l_orderkey * 1000 AS STRING) ELSE CAST(l_orderkey AS STRING) END AS parent_run_id",
            "CASE WHEN l_partkey % 6 = 0 THEN ' 2.0 ' WHEN l_partkey % 6 = 1 THEN '' END AS contract_version",
        ],
        None,
        None,
    ),
    "manifests_snapshot": (
        "orders",
        [
            "'s/t/run_id=' || CAST(o_orderkey AS STRING) || '/accepted/manifest.json' AS manifest_key",
            "CASE WHEN o_orderkey % 4 = 0 THEN '{\"contract_version\":7}' WHEN o_orderkey % 4 = 1 THEN '{\"contract_version\":\" \"}' "
            "ELSE '{\"contract_version\":\" 1.0 \"}' END AS manifest_json",
        ],
        "o_orderkey % 5 <> 0",
        None,
    ),
    "manifests_stage": (
        "customer",
        [
            "'m/' || CAST(c_custkey AS STRING) AS manifest_key",
            "'{\"contract_version\":\"3.' || CAST(c_custkey AS STRING) || '\"}' AS manifest_json",
        ],
        "c_custkey % 4 <> 0",
        None,
    ),
    # Runs recorded before strategy, mode and delete count were columns.
    "legacy_runs": (
        "orders",
        [
            "CAST(o_orderkey AS STRING) AS run_id",
            "CASE o_orderkey % 5 WHEN 0 THEN 's.t.hash_diff' WHEN 1 THEN 's.t.incrementalXaudit' WHEN 2 THEN 's.t.logical_cdc' "
            "WHEN 3 THEN 's.t.other' ELSE 'hash_diff' END AS pipeline_id",
            """'{' || CASE o_orderkey % 4 WHEN 0 THEN '"strategy":"",' WHEN 1 THEN '"strategy":"custom",' ELSE '' END ||
                CASE o_orderkey % 7 WHEN 0 THEN '"run_mode":"x_replay_y",' WHEN 1 THEN '"mode":"replay",'
                WHEN 2 THEN '"run_mode":"ingest","mode":"replay",' ELSE '' END ||
                CASE WHEN o_orderkey % 2 = 0 THEN '"delete_count":"' || CAST(o_custkey AS STRING) || '",' ELSE '' END || '"z":1}' AS metrics_json""",
        ],
        None,
        None,
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Fixtures of long texts: reading them costs far more than moving the bare columns.
_TEXTS = {"error_lines", "payloads", "requests", "stage_rows", "run_audit", "task_results", "dirty_lines"}


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture as a Spark frame.

    A test table is one file with one row group, which one task reads. The rows of
    text fixtures, which are built by long expressions, are spread out first.
    """
    source, columns, condition, grouping = FIXTURES[name]
    df = table(spark, sf_dir, source)
    if name in _TEXTS:
        df = df.repartition(spark.sparkContext.defaultParallelism, df.columns[0])
    if condition:
        df = df.where(condition)
    if grouping:
        return df.groupBy(F.expr(columns[0])).agg(*[F.expr(c) for c in columns[1:]])
    rows = df.selectExpr(*columns)
    # date_trunc yields a zoned time; the tables, and the oracle, have times without a zone.
    zoned = [name for name, kind in rows.dtypes if kind == "timestamp"]
    return rows.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else rows


def sql_of(name: str) -> str:
    source, columns, condition, grouping = FIXTURES[name]
    text = f"SELECT {', '.join(columns)} FROM {source}"
    if condition:
        text += f" WHERE {condition}"
    if grouping:
        text += f" GROUP BY {grouping}"
    return text


def with_fixtures(names: str, body: str) -> str:
    """Oracle SQL: the named fixtures as common tables, then the query."""
    tables = [f"{name} AS ({sql_of(name)})" for name in names.split()]
    rest = body.strip()
    if rest[:5].upper() == "WITH ":
        return f"WITH {', '.join(tables)}, {rest[5:]}"
    return f"WITH {', '.join(tables)} {rest}"
