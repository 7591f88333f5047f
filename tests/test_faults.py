"""Cases that once lost or overwrote data."""

import json

import pytest
from pyspark.sql import functions as F

from checks.contracts import USERS
from checks.snapshot_queries import _context
from driftline.operators.delta import apply_delta
from driftline.operators.diff import hash_diff
from driftline.operators.ledger import EXPECTED_TASKS, fold_runs, run_outcomes
from driftline.operators.metrics import enrich_metrics, rate_metrics
from driftline.operators.validation import quarantine_counts, quarantine_transactions
from driftline.plans import ingest_change_log
from driftline.plans.snapshot import current_rows
from driftline.shared import claim_text, replace_text
from driftline.sources import curated
from driftline.sources.curated import read_curated, read_pointer, write_curated
from driftline.streaming import drain, stream_deltas

EVENT = "lsn bigint, xid bigint, seq bigint, op string, old_k bigint, k bigint, v double, tx_end boolean"


def rows_of(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def test_the_second_of_two_writers_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    base = write_curated(spark.range(10).withColumnRenamed("id", "k"), root, ["k"], "r0", buckets=2)
    write_curated(spark.range(20).withColumnRenamed("id", "k"), root, ["k"], "first", previous=base)
    with pytest.raises(FileExistsError):
        write_curated(spark.range(30).withColumnRenamed("id", "k"), root, ["k"], "second", previous=base)
    assert read_pointer(spark, root).run_id == "first"
    assert read_curated(spark, root).count() == 20


def test_a_version_claimed_and_never_filled_is_passed_over(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    frame = spark.range(10).withColumnRenamed("id", "k")
    base = write_curated(frame, root, ["k"], "r0", buckets=2)
    claim_text(spark, f"{root}/pointer/v2.json", "")
    assert read_pointer(spark, root) == base
    with pytest.raises(FileExistsError):
        write_curated(frame, root, ["k"], "soon", previous=base)
    monkeypatch.setattr(curated, "_ABANDONED_SECONDS", -1)
    assert write_curated(frame.limit(4), root, ["k"], "later", previous=base).version == 3
    replace_text(spark, f"{root}/pointer/_newest", "")
    assert read_pointer(spark, root).run_id == "later"
    assert read_curated(spark, root).count() == 4


def test_unknown_operations_leave_rows_alone(spark):
    state = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, v double")
    delta = spark.createDataFrame([(1, None, 9.0), (2, "d", 9.0), (3, "T", 9.0), (4, "I", 4.0)], "k bigint, op string, v double")
    assert rows_of(apply_delta(state, delta, ["k"])) == [(1, 1.0), (2, 2.0), (4, 4.0)]


def test_a_contract_of_keys_only_can_be_compared(spark):
    new, old = spark.range(0, 5), spark.range(3, 8)
    counts = hash_diff(new, old, ["id"]).groupBy("action").count().collect()
    assert {r["action"]: r["count"] for r in counts} == {"insert": 3, "unchanged": 2, "delete": 3}


def test_stream_applies_and_lands_events_without_a_transaction(spark, tmp_path):
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))
    events = [(1, None, 1, "I", None, 1, 5.0, None), (2, 7, 2, "I", None, 2, 6.0, False), (3, 7, 3, "U", None, 3, 1.0, True)]
    events += [(4, None, 4, "x", None, 4, 9.0, None), (5, 8, 5, "I", None, 5, 7.0, True)]
    spark.createDataFrame(events, EVENT).write.parquet(f"{tmp_path}/feed")
    query = stream_deltas(ctx, spark.readStream.schema(EVENT).parquet(f"{tmp_path}/feed"), f"{tmp_path}/checkpoint", buckets=2)
    assert drain(query, max_seconds=120).input_rows == 5
    assert rows_of(current_rows(ctx)) == [(1, 5.0), (5, 7.0)]
    landed = f"{tmp_path}/landing/*/*/*/wal_delta"
    assert spark.read.json(f"{landed}/errors.ndjson.gz").count() == 2
    assert [r["k"] for r in spark.read.json(f"{landed}/quarantined.ndjson.gz").collect()] == [2]


def test_events_without_a_transaction_count_one_by_one(spark):
    events = spark.createDataFrame([(None, True), (None, True), (None, False), (1, True), (1, False)], "xid bigint, bad boolean")
    marked = quarantine_transactions(events, F.col("bad"))
    counts = quarantine_counts(marked, F.col("bad")).first()
    assert tuple(counts) == (3, 3, 4, 3)


def test_the_last_payload_by_time_counts(spark):
    runs = spark.createDataFrame([("r", "p", "hash_diff", "ingest")], "run_id string, pipeline_id string, strategy string, run_mode string")
    done = [("r", task, "{}", 0) for task in EXPECTED_TASKS[("hash_diff", "ingest")]]
    merges = [("r", "merge_curated", '{"read_count": 9}', 1), ("r", "merge_curated", '{"read_count": 10}', 2)]
    results = spark.createDataFrame([*merges[::-1], *done], "run_id string, task_id string, payload string, at int")
    stages = spark.createDataFrame([], "run_id string, stage_name string, metrics_json string")
    closed = run_outcomes(runs, results, stages, at="at").first()
    assert (closed["status"], closed["read_count"]) == ("success", 10)


def test_a_tie_of_finish_records_is_settled(spark):
    shape = (
        "run_id string, event string, at timestamp, pipeline_id string, strategy string, run_mode string, contract_id string, "
        "version string, checksum string, read_count bigint, insert_count bigint, update_count bigint, delete_count bigint, "
        "unchanged_count bigint, status string, metrics_json string, error_text string"
    )
    from datetime import datetime

    when = datetime(2024, 1, 1)
    start = ("r", "start", when, "p", "s", "m", "c", "1", "x", *[None] * 8)
    ends = [("r", "finish", when, *[None] * 6, n, 0, 0, 0, 0, status, "{}", None) for n, status in ((1, "failed"), (2, "success"))]
    for order in (ends, ends[::-1]):
        folded = fold_runs(spark.createDataFrame([start, *order], shape)).first()
        assert (folded["status"], folded["read_count"]) == ("success", 2)


def test_payloads_with_repeated_members_and_no_numbers(spark):
    payloads = spark.createDataFrame(
        [("s", "m", "p", "r", '{"a": 1, "b": 2, "a": "x", "read_count": 5, "total_seconds": "nan"}')],
        "strategy string, run_mode string, pipeline_id string, run_id string, payload string",
    )
    members = json.loads(enrich_metrics(payloads, "payload").first()["payload"])
    assert members["a"] == "x" and members["b"] == 2
    assert rate_metrics(payloads).first()["processed_records_per_second"] is None


def test_a_window_that_cuts_a_transaction_leaves_it_whole(spark, tmp_path):
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))
    events = [(1, 1, 1, "I", None, 1, 5.0, True), (2, 2, 2, "I", None, 2, 6.0, False), (3, 3, 3, "I", None, 3, 7.0, True), (4, 2, 4, "I", None, 4, 1.0, True)]
    feed = spark.createDataFrame(events, EVENT)
    first = ingest_change_log(ctx, feed, end_lsn=3, buckets=2, commit="tx_end")
    assert rows_of(current_rows(ctx)) == [(1, 5.0), (3, 7.0)]
    assert ctx.ledger.checkpoint(ctx.pipeline_id)["last_applied_lsn"] == "0/1"
    again = _context(spark, USERS, "logical_cdc", str(tmp_path))
    second = ingest_change_log(again, feed, buckets=2, commit="tx_end")
    assert rows_of(current_rows(again)) == [(1, 5.0), (3, 7.0)]
    told = second["extract_validate_land_wal_delta"]
    assert (told["window_end_lsn"], told["reached_window_end"], told["quarantined_event_count"]) == ("0/4", True, 2)
    assert first["extract_validate_land_wal_delta"]["artifact_total_bytes"] > 0
    run = again.ledger.runs().filter(F.col("run_id") == again.run_id).first()
    metrics = json.loads(run["metrics_json"])
    assert metrics["artifact_total_bytes"] > 0 and metrics["delta_object_key"] == again.keys["accepted_key"]


def test_a_broken_error_artifact_keeps_what_is_stored(spark, tmp_path):
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))
    path = f"{tmp_path}/landing/errors"
    for lines, kept in ((['{"row_number": 1}', '{"row_number": 2}'], 2), (['{"row_number": 3}', "{broken"], 2), (['{"row_number": 4}'], 1)):
        spark.createDataFrame([(x,) for x in lines], "value string").write.mode("overwrite").text(path)
        ctx.record_errors("stage", "errors")
        assert spark.read.parquet(f"{ctx.ledger.root}/validation_errors").count() == kept
    ctx.record_errors("stage", "missing")
    assert spark.read.parquet(f"{ctx.ledger.root}/validation_errors").count() == 1
