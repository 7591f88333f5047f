"""Error lines, run ledger, metrics and monitoring views."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.fixtures import frame, with_fixtures
from driftline.operators.error_lines import (
    ERROR_COLUMNS,
    normalize_error_lines,
    replace_stage_errors,
    validation_errors,
)
from driftline.operators.ledger import (
    backfill_runs,
    fold_runs,
    latest_stages,
    missing_stages,
    pipeline_state,
    run_outcomes,
)
from driftline.operators.metrics import enrich_metrics, problem_summary, rate_metrics
from driftline.operators.views import pipeline_health, problems, run_metrics, stage_metrics

_AS_OF = "2030-01-01 00:00:00"
_ERROR_FIELDS = ["row_number", "field", "code", "message", "constraint", "actual_value", "details_json"]
_PLACE = ["line_no", "line_sub", "place_a", "place_b", "place_c"]


def normalized_lines(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize_error_lines(frame(spark, sf, "error_lines"), ["run_id"])
    return rows.select("run_id", "line_no", *_ERROR_FIELDS)


def _error_table(spark: SparkSession, sf: str) -> DataFrame:
    rows = normalize_error_lines(frame(spark, sf, "error_lines"), ["run_id"])
    return rows.select(
        F.concat_ws("-", "run_id", "part", "line_no", "line_sub").alias("error_id"),
        "run_id",
        F.concat(F.lit("p"), "run_id").alias("pipeline_id"),
        F.lit("hash_diff").alias("strategy"),
        F.lit("ingest").alias("run_mode"),
        F.when(F.col("line_no") % 3 == 0, "a").otherwise("b").alias("stage_name"),
        *_ERROR_FIELDS[:-1],
        F.lit("k").alias("error_object_key"),
        "details_json",
        F.lit("2024-05-01 10:00:00").cast("timestamp_ntz").alias("created_at"),
    ).select(*ERROR_COLUMNS)


def replaced_errors(spark: SparkSession, sf: str) -> DataFrame:
    """Stage ``a`` of every fourth run is replaced, by nothing for every eighth."""
    table = _error_table(spark, sf)
    stages = table.select("run_id", "stage_name").distinct().filter("stage_name = 'a' and cast(run_id as int) % 4 = 0")
    fresh = table.filter("stage_name = 'b' and cast(run_id as int) % 8 = 4").withColumn("stage_name", F.lit("a"))
    return replace_stage_errors(table, fresh, stages).select("run_id", "stage_name", "error_id", "row_number", "field")


def error_view(spark: SparkSession, sf: str) -> DataFrame:
    return validation_errors(_error_table(spark, sf))


def folded_runs(spark: SparkSession, sf: str) -> DataFrame:
    return fold_runs(frame(spark, sf, "run_events"))


def latest_stage_rows(spark: SparkSession, sf: str) -> DataFrame:
    return latest_stages(frame(spark, sf, "stage_attempts"), ["started_at", "attempt_id", "attempt_sub", "tb"])


def missing_stage_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = missing_stages(frame(spark, sf, "closing_runs"), frame(spark, sf, "task_results"))
    return rows.select("run_id", F.array_join("missing", ",").alias("missing"))


def run_outcome_rows(spark: SparkSession, sf: str) -> DataFrame:
    runs, results, stages = (frame(spark, sf, n) for n in ("closing_runs", "task_results", "closing_stages"))
    return run_outcomes(runs, results, stages, "told_at")


def rate_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rate_metrics(frame(spark, sf, "payloads")).drop("payload", "strategy", "run_mode", "pipeline_id", "run_id")


def problem_structs(spark: SparkSession, sf: str) -> DataFrame:
    return problem_summary(frame(spark, sf, "payloads")).select("id", "problem_summary.*")


def enriched_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Members of the enriched payloads: identity, a rate, and what was there before."""
    rows = enrich_metrics(frame(spark, sf, "payloads"))
    names = {
        "strategy_member": "strategy",
        "pipeline_member": "pipeline_id",
        "source_event_count": "source_event_count",
        "change_ratio": "change_ratio",
        "failed_tasks": "failed_tasks",
        "has_problems": "problem_summary.has_problems",
        "failed_task_count": "problem_summary.failed_task_count",
        "error_artifact_key": "problem_summary.error_artifact_key",
    }
    members = [F.get_json_object("payload", f"$.{path}").alias(name) for name, path in names.items()]
    return rows.select("id", *members).withColumn("change_ratio", F.col("change_ratio").cast("double"))


def state_rows(spark: SparkSession, sf: str) -> DataFrame:
    return pipeline_state(frame(spark, sf, "run_audit"))


def state_after_runs(spark: SparkSession, sf: str) -> DataFrame:
    """State carried over from before: runs since 1998 on top of the earlier state."""
    runs = frame(spark, sf, "run_audit")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    before = pipeline_state(runs.filter(F.col("started_at") < cut))
    return pipeline_state(runs.filter(F.col("started_at") >= cut), before)


def backfilled_runs(spark: SparkSession, sf: str) -> DataFrame:
    return backfill_runs(frame(spark, sf, "legacy_runs")).drop("metrics_json")


def run_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return run_metrics(frame(spark, sf, "run_audit"))


def stage_metric_rows(spark: SparkSession, sf: str) -> DataFrame:
    return stage_metrics(frame(spark, sf, "stage_rows"), frame(spark, sf, "run_audit"))


def health_rows(spark: SparkSession, sf: str) -> DataFrame:
    runs = frame(spark, sf, "run_audit")
    return pipeline_health(pipeline_state(runs), runs, F.lit(_AS_OF).cast("timestamp_ntz"))


def problem_rows(spark: SparkSession, sf: str) -> DataFrame:
    return problems(run_metric_rows(spark, sf), stage_metric_rows(spark, sf))


def _lines_sql() -> str:
    falsy = "raw IS NULL OR raw IN ('\"\"', '0', 'false', 'null', '[]', '{}')"

    def filled(name: str, default: str) -> str:
        raw = f"json_extract(t, '$.{name}')"
        return (
            f"CASE WHEN {falsy.replace('raw', f'CAST({raw} AS VARCHAR)')} THEN '{default}' "
            f"ELSE json_extract_string(t, '$.{name}') END AS {name}"
        )

    def blank(name: str) -> str:
        return f"nullif(trim(json_extract_string(t, '$.{name}')), '') AS \"{name}\""

    place = ", ".join(_PLACE)
    kept = "SELECT * FROM objects WHERE run_id NOT IN (SELECT run_id FROM lines WHERE NOT ok)"
    return f"""WITH lines AS (
      SELECT *, trim(line) AS t, json_valid(line) AS ok,
        row_number() OVER (PARTITION BY run_id ORDER BY {place}) AS pos
      FROM error_lines WHERE trim(line) <> ''),
    objects AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY pos) AS rn FROM lines
      WHERE ok AND CASE WHEN ok THEN json_type(line) = 'OBJECT' END),
    kept AS ({kept}),
    errors AS (SELECT run_id, line_no, part, line_sub,
      CASE WHEN regexp_matches(json_extract_string(t, '$.row_number'), '^\\s*[+-]?[0-9]+\\s*$')
        THEN CAST(trim(json_extract_string(t, '$.row_number')) AS BIGINT) END AS row_number,
      {filled('field', '$')}, {filled('code', 'validation_error')}, {filled('message', 'validation error')},
      {blank('constraint')}, {blank('actual_value')}, t AS details_json FROM kept)"""


_ERROR_SELECT = 'run_id, line_no, row_number, field, code, message, "constraint", actual_value, details_json'
_ERROR_TABLE = """full_errors AS (SELECT run_id || '-' || part || '-' || line_no || '-' || line_sub AS error_id, run_id,
  'p' || run_id AS pipeline_id, 'hash_diff' AS strategy, 'ingest' AS run_mode,
  CASE WHEN line_no % 3 = 0 THEN 'a' ELSE 'b' END AS stage_name, row_number, field, code, message, "constraint",
  actual_value, 'k' AS error_object_key, details_json, TIMESTAMP '2024-05-01 10:00:00' AS created_at FROM errors)"""

# Integer of a payload member, skipping what does not read as one.
def _int(key: str, column: str = "payload") -> str:
    text = f"json_extract_string({column}, '$.{key}')"
    return f"CASE WHEN regexp_matches({text}, '^[+-]?[0-9]+$') THEN CAST({text} AS BIGINT) END"


_CHANGED = " + ".join(f"coalesce({_int(k)}, 0)" for k in ("insert_count", "update_count", "delete_count"))
_SOURCE = f"coalesce({_int('source_row_count')}, {_int('source_event_count')})"
_INVALID = f"coalesce({_int('invalid_row_count')}, {_int('invalid_event_count')})"
_READ = _int("read_count")
_SECONDS = "CAST(json_extract_string(payload, '$.{0}') AS DOUBLE)"
_CHANGE_RATIO = f"CASE WHEN {_READ} > 0 THEN round(({_CHANGED}) / {_READ}, 6) END"
_FAILED = "coalesce(json_array_length(payload, '$.failed_tasks'), 0)"
_ERROR_KEY = """coalesce(nullif(trim(json_extract_string(payload, '$.validation_error_object_key')), ''),
  nullif(trim(json_extract_string(payload, '$.error_object_key')), ''))"""
_SUMMARY = f"""summary AS (SELECT id, coalesce({_INVALID}, 0) AS invalid_record_count,
  coalesce({_int('invalid_transaction_count')}, 0) AS invalid_transaction_count,
  coalesce({_int('quarantined_event_count')}, 0) AS quarantined_event_count,
  coalesce({_int('quarantined_transaction_count')}, 0) AS quarantined_transaction_count,
  CAST({_FAILED} AS BIGINT) AS failed_task_count, {_ERROR_KEY} AS error_artifact_key FROM payloads)"""
_ANY = (
    "invalid_record_count + invalid_transaction_count + quarantined_event_count "
    "+ quarantined_transaction_count + failed_task_count > 0 AS has_problems"
)


def _member(*paths: str) -> str:
    chain = ", ".join(f"CAST(json_extract_string(metrics_json, '$.{p}') AS BIGINT)" for p in paths)
    return f"coalesce({chain}, 0)"


_VIEW_COUNTS = f"""{_member('problem_summary.invalid_record_count', 'invalid_row_count', 'invalid_event_count')} AS invalid_record_count,
  {_member('problem_summary.invalid_transaction_count', 'invalid_transaction_count')} AS invalid_transaction_count,
  {_member('problem_summary.quarantined_event_count', 'quarantined_event_count')} AS quarantined_event_count,
  {_member('problem_summary.quarantined_transaction_count', 'quarantined_transaction_count')} AS quarantined_transaction_count,
  {_member('artifact_total_bytes')} AS artifact_total_bytes,
  coalesce(json_extract_string(metrics_json, '$.validation_error_object_key'),
    json_extract_string(metrics_json, '$.error_object_key')) AS error_artifact_key"""
_EPOCH = "CAST(epoch_us({1}) - epoch_us({0}) AS DOUBLE) / 1000000"
_RUN_VIEW = f"""run_view AS (SELECT run_id, pipeline_id, strategy, run_mode, contract_id, version AS contract_version, checksum,
  started_at, finished_at, {_EPOCH.format('started_at', 'finished_at')} AS run_duration_seconds,
  read_count, insert_count, update_count, delete_count, unchanged_count, status, metrics_json, error_text,
  {_member('source_row_count', 'source_event_count')} AS source_input_count, {_VIEW_COUNTS} FROM run_audit)"""
_STAGE_VIEW = f"""stage_view AS (SELECT s.run_id, r.pipeline_id, r.strategy, r.run_mode, r.contract_id, r.version AS contract_version,
  stage_name, s.status, s.started_at, s.finished_at, {_EPOCH.format('s.started_at', 's.finished_at')} AS stage_duration_seconds,
  s.metrics_json, s.error_text, {_VIEW_COUNTS.replace('metrics_json', 's.metrics_json')}
  FROM stage_rows s JOIN run_audit r ON r.run_id = s.run_id)"""


def _problem_sql(view: str, scope: str, stage: str, observed: str) -> str:
    return f"""SELECT run_id, pipeline_id, strategy, run_mode, {stage} AS stage_name, {observed} AS observed_at, '{scope}' AS scope,
      CASE WHEN status = 'failed' THEN '{scope}_failure' WHEN invalid_transaction_count > 0 THEN 'invalid_transactions'
        WHEN quarantined_transaction_count > 0 THEN 'quarantined_transactions' WHEN invalid_record_count > 0 THEN 'invalid_records'
        ELSE 'quarantined_events' END AS problem_type,
      (SELECT max(x) FROM (VALUES (CASE WHEN status = 'failed' THEN CAST(1 AS BIGINT) ELSE 0 END), (invalid_record_count),
        (invalid_transaction_count), (quarantined_event_count), (quarantined_transaction_count)) v(x)) AS problem_count,
      error_artifact_key, error_text FROM {view}
    WHERE status = 'failed' OR invalid_record_count > 0 OR invalid_transaction_count > 0
      OR quarantined_event_count > 0 OR quarantined_transaction_count > 0"""


_STATE = """latest AS (SELECT DISTINCT ON (pipeline_id) *, coalesce(finished_at, started_at) AS ended FROM run_audit
  ORDER BY pipeline_id, started_at DESC, run_id DESC),
won AS (SELECT DISTINCT ON (pipeline_id) pipeline_id, coalesce(finished_at, started_at) AS ended FROM run_audit
  WHERE status = 'success' ORDER BY pipeline_id, started_at DESC, run_id DESC),
state AS (SELECT l.pipeline_id, l.ended AS last_run_at, w.ended AS last_success_at, l.status AS last_status,
  CASE WHEN l.status <> 'success' THEN l.error_text END AS last_error
  FROM latest l LEFT JOIN won w ON l.pipeline_id = w.pipeline_id)"""
# The tasks of each kind of run, in pipeline order.
_EXPECTED = """expected(strategy, run_mode, pos, task) AS (VALUES
  ('hash_diff', 'ingest', 1, 'fetch_contract'), ('hash_diff', 'ingest', 2, 'read_checkpoint'),
  ('hash_diff', 'ingest', 3, 'start_run'), ('hash_diff', 'ingest', 4, 'extract_validate_land'),
  ('hash_diff', 'ingest', 5, 'merge_curated'), ('hash_diff', 'ingest', 6, 'persist_checkpoint_task'),
  ('incremental_audit', 'ingest', 1, 'fetch_contract'), ('incremental_audit', 'ingest', 2, 'read_checkpoint'),
  ('incremental_audit', 'ingest', 3, 'start_run'), ('incremental_audit', 'ingest', 4, 'ensure_source_audit_capture'),
  ('incremental_audit', 'ingest', 5, 'extract_validate_land_delta'), ('incremental_audit', 'ingest', 6, 'apply_delta'),
  ('incremental_audit', 'ingest', 7, 'persist_checkpoint_task'),
  ('logical_cdc', 'ingest', 1, 'fetch_contract'), ('logical_cdc', 'ingest', 2, 'read_checkpoint'),
  ('logical_cdc', 'ingest', 3, 'start_run'), ('logical_cdc', 'ingest', 4, 'ensure_source_logical_cdc_capture'),
  ('logical_cdc', 'ingest', 5, 'extract_validate_land_wal_delta'), ('logical_cdc', 'ingest', 6, 'apply_delta'),
  ('logical_cdc', 'ingest', 7, 'persist_checkpoint_task'), ('logical_cdc', 'ingest', 8, 'ack_replication_slot'),
  ('hash_diff', 'replay', 1, 'merge_curated_replay'), ('incremental_audit', 'replay', 1, 'apply_delta_replay'),
  ('logical_cdc', 'replay', 1, 'apply_delta_replay')),
gaps AS (SELECT r.run_id, string_agg(e.task, ', ' ORDER BY pos) AS missing
  FROM closing_runs r JOIN expected e USING (strategy, run_mode)
  WHERE NOT EXISTS (SELECT 1 FROM task_results t WHERE t.run_id = r.run_id AND t.task_id = e.task) GROUP BY r.run_id)"""
_OUTCOMES = f"""{_EXPECTED},
ranked AS (SELECT *, row_number() OVER (PARTITION BY run_id, task_id ORDER BY told_at DESC, payload DESC) AS nth FROM task_results),
told AS (SELECT run_id, task_id, nullif(payload, '{{}}') AS payload FROM ranked WHERE nth = 1),
named AS (SELECT r.*, r.run_mode = 'ingest' AS ing,
  CASE strategy WHEN 'hash_diff' THEN 'extract_validate_land' WHEN 'incremental_audit' THEN 'extract_validate_land_delta'
    ELSE 'extract_validate_land_wal_delta' END AS xt,
  CASE strategy WHEN 'hash_diff' THEN 'merge_curated' ELSE 'apply_delta' END
    || CASE run_mode WHEN 'replay' THEN '_replay' ELSE '' END AS apt FROM closing_runs r),
given AS (SELECT n.*, coalesce(g.missing, '') AS failed_tasks, x.payload AS xr, s.metrics_json AS xs, a.payload AS ap,
  c.payload IS NOT NULL AS checkpoint_persisted
  FROM named n LEFT JOIN gaps g ON g.run_id = n.run_id
  LEFT JOIN told x ON x.run_id = n.run_id AND x.task_id = xt
  LEFT JOIN closing_stages s ON s.run_id = n.run_id AND s.stage_name = xt
  LEFT JOIN told a ON a.run_id = n.run_id AND a.task_id = apt
  LEFT JOIN told c ON c.run_id = n.run_id AND c.task_id = 'persist_checkpoint_task')"""


def _num(column: str, key: str) -> str:
    return f"TRY_CAST(json_extract_string({column}, '$.{key}') AS BIGINT)"


_OUTCOME_SELECT = f"""SELECT run_id, pipeline_id, strategy, run_mode,
  CASE WHEN failed_tasks <> '' THEN 'failed' ELSE 'success' END AS status,
  coalesce(CASE
    WHEN ing AND failed_tasks <> '' AND strategy = 'hash_diff' THEN {_num('coalesce(xr, xs)', 'source_row_count')}
    WHEN ing AND failed_tasks <> '' THEN {_num('coalesce(xr, xs)', 'source_event_count')}
    WHEN ing AND strategy = 'logical_cdc' THEN coalesce(nullif({_num('xr', 'source_event_count')}, 0), {_num('ap', 'read_count')})
    ELSE {_num('ap', 'read_count')} END, 0) AS read_count,
  coalesce({_num('ap', 'insert_count')}, 0) AS insert_count, coalesce({_num('ap', 'update_count')}, 0) AS update_count,
  coalesce({_num('ap', 'delete_count')}, 0) AS delete_count, coalesce({_num('ap', 'unchanged_count')}, 0) AS unchanged_count,
  failed_tasks, checkpoint_persisted,
  CASE WHEN ing THEN coalesce(json_extract_string(coalesce(xr, xs), '$.validation_error_object_key'),
    json_extract_string(coalesce(xr, xs), '$.error_object_key')) END AS validation_error_object_key,
  CASE WHEN failed_tasks <> '' THEN CASE WHEN ing THEN 'Pipeline' ELSE 'Replay pipeline' END || ' failed at stages: ' || failed_tasks END
    AS error_text FROM given"""

QUERIES = {
    "error_lines": (
        normalized_lines,
        with_fixtures("error_lines", f"{_lines_sql()} SELECT {_ERROR_SELECT} FROM errors"),
    ),
    "replace_stage_errors": (
        replaced_errors,
        with_fixtures(
            "error_lines",
            f"""{_lines_sql()}, {_ERROR_TABLE}
            SELECT run_id, stage_name, error_id, row_number, field FROM full_errors
            WHERE NOT (stage_name = 'a' AND CAST(run_id AS INTEGER) % 4 = 0)
            UNION ALL SELECT run_id, 'a', error_id, row_number, field FROM full_errors
            WHERE stage_name = 'b' AND CAST(run_id AS INTEGER) % 8 = 4""",
        ),
    ),
    "validation_errors": (
        error_view,
        with_fixtures(
            "error_lines",
            f"""{_lines_sql()}, {_ERROR_TABLE}
            SELECT * EXCLUDE (created_at), created_at AS observed_at FROM full_errors""",
        ),
    ),
    "fold_runs": (
        folded_runs,
        with_fixtures(
            "run_events",
            """WITH s AS (SELECT * FROM run_events WHERE event = 'start' QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY "at") = 1),
            f AS (SELECT * FROM run_events WHERE event = 'finish' QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY "at" DESC) = 1)
            SELECT s.run_id, s.pipeline_id, s.strategy, s.run_mode, s.contract_id, s.version, s.checksum, s."at" AS started_at,
              f."at" AS finished_at, coalesce(f.read_count, 0) AS read_count, coalesce(f.insert_count, 0) AS insert_count,
              coalesce(f.update_count, 0) AS update_count, coalesce(f.delete_count, 0) AS delete_count,
              coalesce(f.unchanged_count, 0) AS unchanged_count, coalesce(f.status, 'running') AS status,
              f.metrics_json, f.error_text FROM s LEFT JOIN f ON s.run_id = f.run_id""",
        ),
    ),
    "latest_stages": (
        latest_stage_rows,
        with_fixtures(
            "stage_attempts",
            """SELECT * FROM stage_attempts QUALIFY row_number() OVER (PARTITION BY run_id, stage_name
            ORDER BY started_at DESC, attempt_id DESC, attempt_sub DESC, tb DESC) = 1""",
        ),
    ),
    "missing_stages": (
        missing_stage_rows,
        with_fixtures(
            "closing_runs task_results",
            f"""WITH {_EXPECTED} SELECT run_id, coalesce(replace(g.missing, ', ', ','), '') AS missing
            FROM closing_runs LEFT JOIN gaps g USING (run_id)""",
        ),
    ),
    "run_outcomes": (
        run_outcome_rows,
        with_fixtures("closing_runs task_results closing_stages", f"WITH {_OUTCOMES} {_OUTCOME_SELECT}"),
    ),
    "rate_metrics": (
        rate_rows,
        with_fixtures(
            "payloads",
            f"""SELECT id, CASE WHEN {_SECONDS.format('source_read_seconds')} > 0
              THEN round({_SOURCE} / {_SECONDS.format('source_read_seconds')}, 3) END AS source_records_per_second,
            CASE WHEN {_SECONDS.format('total_seconds')} > 0
              THEN round({_READ} / {_SECONDS.format('total_seconds')}, 3) END AS processed_records_per_second,
            {_CHANGE_RATIO} AS change_ratio,
            CASE WHEN {_SOURCE} > 0 THEN round({_INVALID} / {_SOURCE}, 6) END AS invalid_ratio FROM payloads""",
        ),
    ),
    "problem_summary": (
        problem_structs,
        with_fixtures("payloads", f"WITH {_SUMMARY} SELECT *, {_ANY} FROM summary"),
    ),
    "enrich_metrics": (
        enriched_payloads,
        with_fixtures(
            "payloads",
            f"""WITH {_SUMMARY}, flagged AS (SELECT *, {_ANY} FROM summary)
            SELECT p.id, strategy AS strategy_member, pipeline_id AS pipeline_member,
              json_extract_string(payload, '$.source_event_count') AS source_event_count, {_CHANGE_RATIO} AS change_ratio,
              json_extract_string(payload, '$.failed_tasks') AS failed_tasks,
              CASE WHEN has_problems THEN 'true' ELSE 'false' END AS has_problems,
              CAST(failed_task_count AS VARCHAR) AS failed_task_count, error_artifact_key
            FROM payloads p JOIN flagged f ON p.id = f.id""",
        ),
    ),
    "pipeline_state": (state_rows, with_fixtures("run_audit", f"WITH {_STATE} SELECT * FROM state")),
    "pipeline_state_carried": (
        state_after_runs,
        with_fixtures(
            "run_audit",
            """WITH latest AS (SELECT DISTINCT ON (pipeline_id) *, coalesce(finished_at, started_at) AS ended FROM run_audit
              ORDER BY pipeline_id, started_at DESC, run_id DESC),
            before AS (SELECT DISTINCT ON (pipeline_id) pipeline_id, coalesce(finished_at, started_at) AS ended FROM run_audit
              WHERE status = 'success' AND started_at < TIMESTAMP '1998-01-01' ORDER BY pipeline_id, started_at DESC, run_id DESC)
            SELECT l.pipeline_id, ended AS last_run_at, CASE WHEN l.status = 'success' THEN ended ELSE
                (SELECT b.ended FROM before b WHERE b.pipeline_id = l.pipeline_id) END AS last_success_at,
              l.status AS last_status, CASE WHEN l.status <> 'success' THEN l.error_text END AS last_error FROM latest l""",
        ),
    ),
    "backfill_runs": (
        backfilled_runs,
        with_fixtures(
            "legacy_runs",
            """SELECT run_id, pipeline_id, CASE WHEN pipeline_id LIKE '%.hash_diff' THEN 'hash_diff'
              WHEN pipeline_id LIKE '%.incremental_audit' THEN 'incremental_audit' WHEN pipeline_id LIKE '%.logical_cdc' THEN 'logical_cdc'
              ELSE coalesce(nullif(json_extract_string(metrics_json, '$.strategy'), ''), 'unknown') END AS strategy,
            CASE WHEN coalesce(json_extract_string(metrics_json, '$.run_mode'), json_extract_string(metrics_json, '$.mode'), '')
              LIKE '%replay%' THEN 'replay' ELSE 'ingest' END AS run_mode,
            coalesce(CAST(json_extract_string(metrics_json, '$.delete_count') AS BIGINT), 0) AS delete_count FROM legacy_runs""",
        ),
    ),
    "run_metrics": (run_metric_rows, with_fixtures("run_audit", f"WITH {_RUN_VIEW} SELECT * FROM run_view")),
    "stage_metrics": (
        stage_metric_rows,
        with_fixtures("stage_rows run_audit", f"WITH {_STAGE_VIEW} SELECT * FROM stage_view"),
    ),
    "pipeline_health": (
        health_rows,
        with_fixtures(
            "run_audit",
            f"""WITH {_STATE} SELECT s.pipeline_id, r.run_id AS last_run_id, r.strategy, r.run_mode, last_run_at, last_success_at,
              last_status, last_error, {_EPOCH.format('last_run_at', f"TIMESTAMP '{_AS_OF}'")} AS seconds_since_last_run,
              {_EPOCH.format('last_success_at', f"TIMESTAMP '{_AS_OF}'")} AS seconds_since_last_success
            FROM state s LEFT JOIN LATERAL (SELECT * FROM run_audit a WHERE a.pipeline_id = s.pipeline_id
              ORDER BY started_at DESC, run_id DESC LIMIT 1) r ON true""",
        ),
    ),
    "problem_rows": (
        problem_rows,
        with_fixtures(
            "run_audit stage_rows",
            f"""WITH {_RUN_VIEW}, {_STAGE_VIEW} {_problem_sql('run_view', 'run', 'CAST(NULL AS VARCHAR)', 'started_at')}
            UNION ALL {_problem_sql('stage_view', 'stage', 'stage_name', 'coalesce(finished_at, started_at)')}""",
        ),
    ),
}
