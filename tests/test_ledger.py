import json

import pytest
from pyspark.sql import functions as F

from driftline.operators.checkpoint import (
    CHECKPOINT_MEMBERS,
    checkpoint_lineage,
    checkpoint_payload,
    latest_checkpoint,
    lsn_window,
    resolve_checkpoint_lsn,
)
from driftline.operators.ledger import fold_runs, missing_stages, pipeline_state, run_outcomes
from driftline.operators.metrics import enrich_metrics, problem_summary, rate_metrics
from driftline.operators.replay import resolve_replays
from driftline.operators.views import pipeline_health, problems, run_metrics, stage_metrics

RUNS = "run_id string, pipeline_id string, strategy string, run_mode string"
RUN_ROWS = (
    "run_id string, pipeline_id string, strategy string, run_mode string, contract_id string, version string, "
    "checksum string, started_at string, finished_at string, read_count bigint, insert_count bigint, "
    "update_count bigint, delete_count bigint, unchanged_count bigint, status string, metrics_json string, error_text string"
)


def run_row(run_id, status="success", metrics="{}", started="2024-01-01", finished="2024-01-01 00:00:10", error=None, pipeline="p"):
    return (run_id, pipeline, "hash_diff", "ingest", "c", "1", "x", started, finished, 1, 1, 0, 0, 0, status, metrics, error)


def runs_of(spark, *rows):
    df = spark.createDataFrame(list(rows), RUN_ROWS)
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "finished_at")})


def test_runs_without_finish_or_start(spark):
    ddl = "run_id string, event string, at timestamp, pipeline_id string, strategy string, run_mode string, contract_id string, version string, checksum string, read_count bigint, insert_count bigint, update_count bigint, delete_count bigint, unchanged_count bigint, status string, metrics_json string, error_text string"
    t = [F.lit(f"2024-01-01 00:00:0{i}").cast("timestamp") for i in range(4)]
    start = ("p", "hash_diff", "ingest", "c", "1", "x", None, None, None, None, None, None, None, None)
    done = (None,) * 6 + (5, 1, 2, 3, 4)
    rows = [("a", "start", 0, *start), ("b", "finish", 1, *done, "success", "{}", None), ("c", "start", 0, *start), ("c", "finish", 1, *done, "failed", "{}", "e"), ("c", "finish", 2, *done, "success", "{}", None)]
    df = spark.createDataFrame(rows, ddl.replace("at timestamp", "at int"))
    df = df.withColumn("at", F.element_at(F.array(*t), F.col("at") + 1))
    got = {r["run_id"]: (r["status"], r["read_count"], r["error_text"]) for r in fold_runs(df).collect()}
    assert got == {"a": ("running", 0, None), "c": ("success", 5, None)}


def outcome(spark, strategy, mode, results, stages=()):
    runs = spark.createDataFrame([("r", "p", strategy, mode)], RUNS)
    res = spark.createDataFrame([("r", t, json.dumps(p), 1) for t, p in results.items()], "run_id string, task_id string, payload string, at int")
    stg = spark.createDataFrame([("r", n, "failed", json.dumps(m)) for n, m in stages], "run_id string, stage_name string, status string, metrics_json string")
    return run_outcomes(runs, res, stg, "at").first().asDict()


def test_failure_takes_the_extract_count_from_the_stage_record(spark):
    got = outcome(spark, "hash_diff", "ingest", {"fetch_contract": {}, "read_checkpoint": {}, "start_run": {"a": 1}}, [("extract_validate_land", {"source_row_count": 7, "error_object_key": "e"})])
    assert got["status"] == "failed" and got["read_count"] == 7
    assert got["failed_tasks"] == "extract_validate_land, merge_curated, persist_checkpoint_task"
    assert got["error_text"] == "Pipeline failed at stages: " + got["failed_tasks"]
    assert got["validation_error_object_key"] == "e" and got["checkpoint_persisted"] is False


ALL_CDC = {t: {"x": 1} for t in ("fetch_contract", "read_checkpoint", "start_run", "ensure_source_logical_cdc_capture", "persist_checkpoint_task", "ack_replication_slot")}


@pytest.mark.parametrize("events, expected", [(9, 9), (0, 4), (None, 4)])
def test_change_log_counts_source_events_first(spark, events, expected):
    got = outcome(spark, "logical_cdc", "ingest", {**ALL_CDC, "extract_validate_land_wal_delta": {"source_event_count": events}, "apply_delta": {"read_count": 4, "insert_count": "2"}})
    assert (got["status"], got["read_count"], got["insert_count"], got["error_text"]) == ("success", expected, 2, None)


def test_replays_have_their_own_task_and_text(spark):
    got = outcome(spark, "logical_cdc", "replay", {"apply_delta": {"read_count": 3}})
    assert got["error_text"] == "Replay pipeline failed at stages: apply_delta_replay" and got["read_count"] == 0
    assert outcome(spark, "hash_diff", "replay", {"merge_curated_replay": {"read_count": 3}})["read_count"] == 3


def test_empty_result_is_present(spark):
    runs = spark.createDataFrame([("r", "p", "incremental_audit", "replay"), ("q", "p", "other", "ingest")], RUNS)
    results = spark.createDataFrame([("r", "apply_delta_replay", "{}")], "run_id string, task_id string, payload string")
    assert {r["run_id"]: r["missing"] for r in missing_stages(runs, results).collect()} == {"r": [], "q": []}


def test_state_keeps_the_last_success(spark):
    runs = runs_of(spark, run_row("1"), run_row("2", "failed", started="2024-01-02", finished="2024-01-03", error="e"), run_row("3", "running", started="2024-01-05", finished=None, pipeline="q"))
    rows = {r["pipeline_id"]: r for r in pipeline_state(runs).collect()}
    assert str(rows["p"]["last_success_at"]) == "2024-01-01 00:00:10" and rows["p"]["last_error"] == "e"
    assert str(rows["q"]["last_run_at"]) == "2024-01-05 00:00:00" and rows["q"]["last_success_at"] is None
    later = runs_of(spark, run_row("4", started="2024-02-01", finished="2024-02-02"))
    carried = {r["pipeline_id"]: r for r in pipeline_state(later, pipeline_state(runs)).collect()}
    assert str(carried["p"]["last_success_at"]) == "2024-02-02 00:00:00" and carried["p"]["last_error"] is None
    assert carried["q"]["last_status"] == "running"


def test_health_without_runs(spark):
    state = pipeline_state(runs_of(spark, run_row("1")))
    none = runs_of(spark, run_row("1")).limit(0)
    row = pipeline_health(state, none, F.lit("2024-01-01 00:00:20").cast("timestamp")).first()
    assert row["last_run_id"] is None and row["seconds_since_last_run"] == 10.0


def test_views_follow_the_fallback_chains(spark):
    enriched = '{"problem_summary":{"invalid_record_count":0,"quarantined_event_count":4},"invalid_row_count":9}'
    bare = '{"invalid_event_count":2,"source_event_count":5,"error_object_key":""}'
    rows = {r["run_id"]: r for r in run_metrics(runs_of(spark, run_row("1", metrics=enriched), run_row("2", metrics=bare), run_row("3", metrics=None))).collect()}
    assert rows["1"]["invalid_record_count"] == 0 and rows["1"]["quarantined_event_count"] == 4
    assert (rows["2"]["invalid_record_count"], rows["2"]["source_input_count"], rows["2"]["error_artifact_key"]) == (2, 5, "")
    assert rows["3"]["source_input_count"] == 0 and rows["3"]["run_duration_seconds"] == 10.0


def test_bad_integer_text_fails_the_view(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_metrics(runs_of(spark, run_row("1", metrics='{"source_row_count":"x"}'))).collect()


def test_problem_precedence_and_count(spark):
    metrics = '{"invalid_transaction_count":2,"quarantined_event_count":8,"invalid_row_count":3}'
    runs = runs_of(spark, run_row("1", "failed", metrics), run_row("2", metrics=metrics), run_row("3"), run_row("4", "failed"))
    stages = spark.createDataFrame(
        [("2", "s", "failed", "2024-01-01", None, "{}", "e"), ("9", "s", "failed", "2024-01-01", None, "{}", "e")],
        "run_id string, stage_name string, status string, started_at string, finished_at string, metrics_json string, error_text string",
    ).withColumns({c: F.col(c).cast("timestamp") for c in ("started_at", "finished_at")})
    rows = problems(run_metrics(runs), stage_metrics(stages, runs)).collect()
    got = sorted((r["scope"], r["run_id"], r["problem_type"], r["problem_count"]) for r in rows)
    assert got == [("run", "1", "run_failure", 8), ("run", "2", "invalid_transactions", 8), ("run", "4", "run_failure", 1), ("stage", "2", "stage_failure", 1)]


def payloads(spark, *texts):
    return spark.createDataFrame([(i, "hash_diff", "ingest", "p", f"r{i}", t) for i, t in enumerate(texts)], "id int, strategy string, run_mode string, pipeline_id string, run_id string, payload string")


def test_rates_need_positive_inputs(spark):
    df = payloads(spark, '{"source_row_count":10,"source_read_seconds":4,"read_count":"3","total_seconds":"2","insert_count":1,"invalid_row_count":1}', '{"source_row_count":10,"source_read_seconds":0,"read_count":0,"total_seconds":-1}', "{}")
    rows = [tuple(r)[-4:] for r in rate_metrics(df).orderBy("id").collect()]
    assert rows == [(2.5, 1.5, 0.333333, 0.1), (None,) * 4, (None,) * 4]


def test_problem_summary_members(spark):
    df = payloads(spark, '{"failed_tasks":["a"],"error_object_key":"e","validation_error_object_key":" "}', '{"failed_tasks":[]}')
    first, second = [r["problem_summary"].asDict() for r in problem_summary(df).orderBy("id").collect()]
    assert first["has_problems"] and first["failed_task_count"] == 1 and first["error_artifact_key"] == "e"
    assert not second["has_problems"] and second["error_artifact_key"] is None


def test_enriched_payload(spark):
    before = {"run_id": "other", "stage_name": "merge", "nested": {"a": [1, None]}, "text": 'q"', "change_ratio": 9, "source_row_count": "4", "source_read_seconds": 2}
    df = payloads(spark, json.dumps(before), None, "{}").withColumn("total", F.when(F.col("id") == 0, F.lit(12)).cast("bigint"))
    rows = [json.loads(r["payload"]) for r in enrich_metrics(df, artifact_total="total").orderBy("id").collect()]
    first = rows[0]
    assert first["run_id"] == "r0" and first["stage_name"] == "merge" and first["nested"] == {"a": [1, None]} and first["text"] == 'q"'
    assert first["source_records_per_second"] == 2 and first["change_ratio"] == 9 and first["artifact_total_bytes"] == 12
    assert rows[1] == rows[2] | {"run_id": "r1"} and "stage_name" not in rows[1]
    assert rows[1]["problem_summary"] == {"has_problems": False, "invalid_record_count": 0, "invalid_transaction_count": 0, "quarantined_event_count": 0, "quarantined_transaction_count": 0, "failed_task_count": 0, "error_artifact_key": None}


def test_checkpoints(spark):
    rows = [("p", "1", "{}", "2024-01-01 10:00:00"), ("p", "2", '{"a":1}', "2024-01-03 00:00:00.000001"), ("q", "3", "{}", "2024-01-02 00:00:00"), ("p", "0", "{}", "2024-01-01 09:00:00")]
    df = spark.createDataFrame(rows, "pipeline_id string, run_id string, checkpoint_json string, updated_at string").withColumn("updated_at", F.col("updated_at").cast("timestamp"))
    got = {r["pipeline_id"]: (r["run_id"], r["updated_at"]) for r in latest_checkpoint(df).collect()}
    assert got == {"p": ("2", "2024-01-03T00:00:00.000001"), "q": ("3", "2024-01-02T00:00:00.000000")}
    for unit in ("day", "hour", "year"):
        before = {r["run_id"]: r["previous_checkpoint_run_id"] for r in checkpoint_lineage(df, unit).collect()}
        assert before == {"0": None, "1": "0", "2": "1", "3": None}


def test_checkpoint_members(spark):
    runs = spark.range(1).select(F.lit("p").alias("pipeline_id"), F.lit("other").alias("status"), F.lit(5).alias("last_applied_lsn"))
    stored = json.loads(runs.select(checkpoint_payload(runs, "logical_cdc").alias("c")).first()["c"])
    assert list(stored) == list(CHECKPOINT_MEMBERS["logical_cdc"])
    assert stored["status"] == "success" and stored["strategy"] == "logical_cdc" and stored["last_applied_lsn"] == 5 and stored["checksum"] is None
    with pytest.raises(ValueError):
        checkpoint_payload(runs, "nope")


def test_positions(spark):
    feed = spark.createDataFrame([(5, "a"), (9, "a"), (20, "b")], "lsn bigint, source_table string")
    row = lsn_window(feed, F.lit(5), F.lit(10), F.col("source_table") == "a").first().asDict()
    assert row == {"window_start_lsn": "0/5", "window_end_lsn": "0/A", "last_decoded_lsn": "0/9", "last_stream_wal_end_lsn": "0/14", "reached_window_end": True}
    empty = lsn_window(feed.limit(0), F.lit(5), F.lit(10), F.lit(True)).first()
    assert empty["last_decoded_lsn"] is None and empty["reached_window_end"] is False
    runs = spark.createDataFrame([(5, 9, True), (5, 9, False), (9, 5, True), (None, 7, True), (3, None, True), (None, None, True)], "start_lsn bigint, window_end_lsn bigint, applied boolean")
    assert [r["last_flushed_lsn"] for r in resolve_checkpoint_lsn(runs).collect()] == [9, 5, 9, 7, 3, None]


def resolve(spark, request, stages=(), manifests=(), listed=()):
    base = {"request_id": "1", "strategy": "hash_diff", "namespace": "s", "name": "t", "object_key": None, "parent_run_id": None, "contract_version": None, **request}
    requests = spark.createDataFrame([tuple(base.values())], ", ".join(f"{k} string" for k in base))
    stg = spark.createDataFrame(list(stages), "run_id string, stage_name string, status string, metrics_json string")
    man = spark.createDataFrame(list(manifests), "manifest_key string, manifest_json string")
    return resolve_replays(requests, stg, man, spark.createDataFrame([(k,) for k in listed], "artifact_key string")).first()


SNAP = "s/t/run_id=r/accepted/accepted_snapshot.ndjson.gz"
SNAP_MANIFEST = "s/t/run_id=r/accepted/manifest.json"
DELTA, DELTA_MANIFEST = "s/t/run_id=r/delta/accepted_delta.ndjson.gz", "s/t/run_id=r/delta/manifest.json"
STAGE = "extract_validate_land_delta"


def test_snapshot_requests(spark):
    manifest = [(SNAP_MANIFEST, '{"contract_version":" 2.0 "}')]
    for request in ({"object_key": f" {SNAP} "}, {"parent_run_id": "r"}):
        row = resolve(spark, request, manifests=manifest)
        assert (row["artifact_key"], row["manifest_key"], row["contract_version"], row["problem"]) == (SNAP, SNAP_MANIFEST, "2.0", None)
    assert resolve(spark, {"parent_run_id": "r", "contract_version": "3"})["problem"] is None
    assert "exactly one" in resolve(spark, {})["problem"]
    assert "exactly one" in resolve(spark, {"object_key": SNAP, "parent_run_id": "r"})["problem"]
    assert resolve(spark, {"object_key": "odd.gz"})["problem"].startswith("Replay requires contract_version")
    assert "manifest was not found" in resolve(spark, {"parent_run_id": "r"})["problem"]
    for version in ('{"contract_version":7}', '{"contract_version":" "}', "{}"):
        assert resolve(spark, {"parent_run_id": "r"}, manifests=[(SNAP_MANIFEST, version)])["problem"].startswith("Replay requires")


def test_delta_requests(spark):
    ask = {"strategy": "incremental_audit", "parent_run_id": "r"}
    manifest = [(DELTA_MANIFEST, '{"contract_version":"1"}'), ("m", '{"contract_version":"5"}')]
    row = resolve(spark, ask, manifests=manifest, listed=[DELTA])
    assert (row["artifact_key"], row["contract_version"], row["problem"], row["parent_stage_found"]) == (DELTA, "1", None, False)
    stage = ("r", STAGE, "success", '{"delta_object_key":"d","manifest_key":"m"}')
    row = resolve(spark, ask, [stage], manifest, ["d"])
    assert (row["artifact_key"], row["contract_version"], row["problem"], row["parent_stage_found"]) == ("d", "5", None, True)
    assert "without delta_object_key" in resolve(spark, ask, [("r", STAGE, "success", '{"manifest_key":"m"}')], manifest)["problem"]
    assert resolve(spark, ask, [("r", STAGE, "failed", '{"delta_object_key":"d"}')], manifest, [DELTA])["artifact_key"] == DELTA
    assert resolve(spark, ask, [("r", STAGE, "success", "{}")], manifest, [DELTA])["parent_stage_found"] is False
    assert "delta artifact was not found" in resolve(spark, ask, [stage], manifest)["problem"]
    assert "manifest was not found" in resolve(spark, ask, listed=[DELTA])["problem"]
    no_manifest = [("r", STAGE, "success", '{"delta_object_key":"d"}')]
    assert resolve(spark, ask, no_manifest, listed=["d"])["problem"].startswith("Replay requires")
    assert resolve(spark, {**ask, "contract_version": "9"}, no_manifest, listed=["d"])["problem"] is None
    assert "not supported" in resolve(spark, {**ask, "object_key": "d"})["problem"]
    assert "parent_run_id" in resolve(spark, {"strategy": "logical_cdc", "parent_run_id": " "})["problem"]
