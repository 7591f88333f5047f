import json
import os
import time

import pytest
from pyspark.sql import functions as F

from checks.contracts import ORDERS, USERS
from checks.fixtures import frame
from checks.snapshot_queries import _context
from driftline.arguments import RunArguments, jdbc_options
from driftline.contracts import Contract, FieldRule
from driftline.operators.validation import ValidationFailed
from driftline.operators.views import problems, run_metrics, stage_metrics
from driftline.plans import ingest_audit_log, ingest_change_log, ingest_snapshot, replay
from driftline.plans.replay import landed_contract_version
from driftline.plans.snapshot import current_rows
from driftline.sources.curated import read_pointer, write_curated
from driftline.streaming import drain, stream_deltas

STRICT = Contract("orders", "1.0.0", (*ORDERS.fields[:5], FieldRule("o_orderpriority", "string", nullable=False)), ORDERS.keys)


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_snapshot_with_rejected_rows(spark, sf_dir, tmp_path):
    old, new = frame(spark, sf_dir, "cur_orders"), frame(spark, sf_dir, "src_orders")
    ingest_snapshot(_context(spark, STRICT, "hash_diff", str(tmp_path)), old, buckets=4)
    ctx = _context(spark, STRICT, "hash_diff", str(tmp_path))
    results = ingest_snapshot(ctx, new, buckets=4)
    bad = new.filter("o_orderpriority is null")
    kept = old.join(bad.select("o_orderkey"), "o_orderkey", "left_semi")
    assert same(current_rows(ctx), new.filter("o_orderpriority is not null").unionByName(kept))
    assert results["extract_validate_land"]["invalid_row_count"] == bad.count()
    merge = results["merge_curated"]
    assert merge["protected_count"] == kept.count()
    assert merge["delete_count"] == old.join(new, "o_orderkey", "left_anti").count()
    errors = spark.read.parquet(f"{ctx.ledger.root}/validation_errors").filter(F.col("run_id") == ctx.run_id)
    assert errors.count() == bad.count() and errors.select("error_id").distinct().count() == bad.count()
    assert landed_contract_version(ctx, ctx.keys["manifest_key"]) == "1.0.0"
    run = ctx.ledger.runs().filter(F.col("run_id") == ctx.run_id).first()
    summary = json.loads(run["metrics_json"])["problem_summary"]
    assert run["status"] == "success" and summary["error_artifact_key"] == ctx.keys["error_key"]
    # Invalid rows of a snapshot run show at stage scope only.
    assert summary["invalid_record_count"] == 0
    found = problems(run_metrics(ctx.ledger.runs()), stage_metrics(ctx.ledger.stages(), ctx.ledger.runs())).collect()
    assert [(r["scope"], r["problem_type"], r["problem_count"]) for r in found] == [("stage", "invalid_records", bad.count())]


def test_a_new_contract_compares_again(spark, sf_dir, tmp_path):
    rows = frame(spark, sf_dir, "cur_orders")
    ingest_snapshot(_context(spark, ORDERS, "hash_diff", str(tmp_path)), rows, buckets=4)
    wider = Contract("orders", "2.0.0", (*ORDERS.fields, FieldRule("note", "string")), ORDERS.keys)
    noted = rows.withColumn("note", F.when(F.col("o_orderkey") % 2 == 0, "x"))
    merge = ingest_snapshot(_context(spark, wider, "hash_diff", str(tmp_path)), noted, buckets=4)["merge_curated"]
    evens = rows.filter("o_orderkey % 2 = 0").count()
    assert (merge["update_count"], merge["unchanged_count"], merge["insert_count"]) == (evens, rows.count() - evens, 0)


def test_failing_policy_leaves_the_curated_table_alone(spark, sf_dir, tmp_path):
    ingest_snapshot(_context(spark, STRICT, "hash_diff", str(tmp_path)), frame(spark, sf_dir, "cur_orders"), buckets=4)
    ctx = _context(spark, STRICT, "hash_diff", str(tmp_path))
    before = read_pointer(spark, ctx.target_root)
    with pytest.raises(ValidationFailed):
        ingest_snapshot(ctx, frame(spark, sf_dir, "src_orders"), policy="fail", buckets=4)
    assert read_pointer(spark, ctx.target_root) == before
    run = ctx.ledger.runs().filter(F.col("run_id") == ctx.run_id).first()
    assert run["status"] == "failed"
    assert run["error_text"] == "Pipeline failed at stages: extract_validate_land, merge_curated, persist_checkpoint_task"
    metrics = json.loads(run["metrics_json"])
    assert metrics["failed_tasks"] == ["extract_validate_land", "merge_curated", "persist_checkpoint_task"]
    assert metrics["problem_summary"]["error_artifact_key"] == ctx.keys["error_key"]
    assert ctx.ledger.checkpoint(ctx.pipeline_id)["last_completed_run_id"] != ctx.run_id
    stage = ctx.ledger.stages().filter((F.col("run_id") == ctx.run_id) & (F.col("stage_name") == "extract_validate_land")).first()
    assert stage["status"] == "failed" and json.loads(stage["metrics_json"])["exception_class"] == "ValidationFailed"
    assert spark.read.parquet(f"{ctx.ledger.root}/validation_errors").filter(F.col("run_id") == ctx.run_id).count() > 0


def test_empty_audit_window_carries_the_watermark(spark, sf_dir, tmp_path):
    events = frame(spark, sf_dir, "audit_events")
    first = _context(spark, USERS, "incremental_audit", str(tmp_path))
    ingest_audit_log(first, events, buckets=4)
    stored = first.ledger.checkpoint(first.pipeline_id)
    state = current_rows(first).collect()
    second = _context(spark, USERS, "incremental_audit", str(tmp_path))
    results = ingest_audit_log(second, events, buckets=4)
    assert results["extract_validate_land_delta"]["source_event_count"] == 0
    again = second.ledger.checkpoint(second.pipeline_id)
    assert again["last_applied_watermark"] == stored["last_applied_watermark"] and again["window_end"] is None
    assert again["previous_checkpoint_run_id"] == first.run_id
    assert sorted(current_rows(second).collect()) == sorted(state)
    with pytest.raises(ValueError, match="changed"):
        ingest_audit_log(_context(spark, USERS, "incremental_audit", str(tmp_path)), events, "commit_timestamp")


def test_change_log_continues_and_replays(spark, sf_dir, tmp_path):
    feed = frame(spark, sf_dir, "wal_events").select("lsn", "xid", "seq", "op", "old_k", "k", "v")
    whole = _context(spark, USERS, "logical_cdc", str(tmp_path / "whole"))
    ingest_change_log(whole, feed, buckets=4)
    cut = 4294967296 + 64 * 399
    first = _context(spark, USERS, "logical_cdc", str(tmp_path / "parts"))
    ingest_change_log(first, feed, end_lsn=cut, buckets=4)
    assert first.results["extract_validate_land_wal_delta"]["reached_window_end"] is True
    assert first.ledger.checkpoint(first.pipeline_id)["last_applied_lsn"] == "1/63C0"
    second = _context(spark, USERS, "logical_cdc", str(tmp_path / "parts"))
    ingest_change_log(second, feed, buckets=4)
    assert same(current_rows(second), current_rows(whole))
    count = second.results["extract_validate_land_wal_delta"]["source_event_count"]
    assert count == 600 and second.ledger.runs().filter(F.col("run_id") == second.run_id).first()["read_count"] == 600
    # Replaying the older delta rewinds its keys; with the guard it changes nothing.
    state = sorted(current_rows(second).collect())
    guarded = _context(spark, USERS, "logical_cdc", str(tmp_path / "parts"), mode="replay")
    replay(guarded, second.keys["accepted_key"], guard=True)
    assert sorted(current_rows(guarded).collect()) == state
    run = guarded.ledger.runs().filter(F.col("run_id") == guarded.run_id).first()
    assert (run["run_mode"], run["status"]) == ("replay", "success")
    assert guarded.ledger.checkpoint(guarded.pipeline_id)["run_id"] == second.run_id
    with pytest.raises(ValueError, match="replay"):
        replay(second, second.keys["accepted_key"])


def test_snapshot_replay(spark, sf_dir, tmp_path):
    first = _context(spark, ORDERS, "hash_diff", str(tmp_path))
    ingest_snapshot(first, frame(spark, sf_dir, "cur_orders"), buckets=4)
    ingest_snapshot(_context(spark, ORDERS, "hash_diff", str(tmp_path)), frame(spark, sf_dir, "src_orders"), buckets=4)
    again = _context(spark, ORDERS, "hash_diff", str(tmp_path), mode="replay")
    replay(again, first.keys["accepted_key"])
    assert same(current_rows(again), frame(spark, sf_dir, "cur_orders"))


def test_a_batch_run_again_does_nothing(spark, sf_dir, tmp_path):
    feed = frame(spark, sf_dir, "wal_events").select("lsn", "xid", "seq", "op", "old_k", "k", "v", "tx_end")
    feed.filter("seq < 402").coalesce(1).write.parquet(f"{tmp_path}/feed")
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))

    def run():
        source = spark.readStream.schema(feed.schema).parquet(f"{tmp_path}/feed")
        return drain(stream_deltas(ctx, source, f"{tmp_path}/checkpoint", buckets=4), 300)

    report = run()
    assert report.ended and report.reached_window_end is None and report.input_rows == 402
    pointer = read_pointer(spark, ctx.target_root)
    held = spark.read.schema(feed.schema).parquet(f"{tmp_path}/checkpoint/held/batch=0")
    assert sorted(r["seq"] for r in held.collect()) == [400, 401]
    commits = f"{tmp_path}/checkpoint/commits"
    for name in os.listdir(commits):
        os.rename(f"{commits}/{name}", f"{tmp_path}/{name}.old")
    run()
    assert read_pointer(spark, ctx.target_root) == pointer
    feed.filter("seq >= 402").coalesce(1).write.mode("append").parquet(f"{tmp_path}/feed")
    run()
    batch = _context(spark, USERS, "logical_cdc", str(tmp_path / "batch"))
    ingest_change_log(batch, feed, buckets=4)
    assert same(current_rows(ctx), current_rows(batch))


def test_drain_stops_on_time_and_silence(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    source = spark.readStream.schema("id bigint").json(str(tmp_path / "in"))
    for budget, idle, most in ((2, None, 10), (60, 1.0, 30)):
        query = source.writeStream.format("noop").trigger(processingTime="200 milliseconds").start()
        began = time.monotonic()
        report = drain(query, budget, idle)
        assert not report.ended and report.input_rows == 0 and not query.isActive
        assert time.monotonic() - began < most


BASE = {"namespace": "sales", "name": "orders", "target_dsn": "t", "target_table_curated": "c", "landing_s3_bucket": "b"}
SOURCE = {**BASE, "source_dsn": "s", "source_table": "public.orders"}
CDC = {**SOURCE, "source_publication_name": "p", "source_slot_name": "l"}


def test_argument_defaults():
    run = RunArguments.from_conf("hash_diff", "ingest", {**SOURCE, "contract_version": " 1.0 "})
    assert run.pipeline_id == "sales.orders.hash_diff" and run.contract_version == "1.0"
    assert run.source_batch_size == 1000 and run.landing_root == "s3a://b/accepted"
    audit = RunArguments.from_conf("incremental_audit", "ingest", {**SOURCE, "source_audit_table": "a"})
    assert audit.watermark_mode == "auto" and audit.extract_batch_size == 1000
    cdc = RunArguments.from_conf("logical_cdc", "ingest", {**CDC, "change_feed_path": " f ", "not_acted_on": 1})
    assert cdc.change_feed_path == "f" and cdc.output_plugin == "pgoutput" and cdc.source_slot_name == "l"
    with pytest.raises(AttributeError):
        cdc.nothing


@pytest.mark.parametrize(
    "kind, conf, message",
    [
        (("hash_diff", "ingest"), {**SOURCE, "source_table": " ", "name": None}, "name, source_table"),
        (("hash_diff", "ingest"), {**SOURCE, "source_batch_size": 0}, "greater than zero"),
        (("hash_diff", "ingest"), {**SOURCE, "source_batch_size": "x"}, "must be an integer"),
        (("hash_diff", "ingest"), {**SOURCE, "landing_s3_bucket": ""}, "landing_s3_bucket"),
        (("hash_diff", "replay"), BASE, "exactly one"),
        (("hash_diff", "replay"), {**BASE, "accepted_object_key": "a", "parent_run_id": "r"}, "exactly one"),
        (("incremental_audit", "ingest"), SOURCE, "source_audit_table"),
        (("incremental_audit", "ingest"), {**SOURCE, "source_audit_table": "a", "watermark_mode": "x"}, "watermark_mode must be one of"),
        (("incremental_audit", "replay"), {**BASE, "delta_object_key": "d", "parent_run_id": "r"}, "not supported"),
        (("incremental_audit", "replay"), BASE, "parent_run_id"),
        (("logical_cdc", "ingest"), {**CDC, "output_plugin": "wal2json"}, "output_plugin"),
        (("logical_cdc", "ingest"), {**CDC, "source_slot_name": None}, "source_slot_name"),
        (("logical_cdc", "ingest"), {**CDC, "source_num_partitions": "-1"}, "greater than zero"),
        (("other", "ingest"), SOURCE, "no such run kind"),
    ],
)
def test_refused_arguments(kind, conf, message):
    with pytest.raises(ValueError, match=message):
        RunArguments.from_conf(*kind, conf)


def test_jdbc_options():
    options = jdbc_options("postgresql+psycopg2://u:p@h:5433/db")
    assert options == {"url": "jdbc:postgresql://h:5433/db", "user": "u", "password": "p"}
    with pytest.raises(ValueError):
        jdbc_options("mysql://h/db")


def test_seeded_table_keeps_untouched_rows(spark, tmp_path):
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))
    seed = spark.range(100).select(F.col("id").alias("k"), F.lit(5.0).alias("v"), F.lit(0).cast("bigint").alias("_position"))
    write_curated(seed, ctx.target_root, ["k"], "seed", buckets=8)
    feed = spark.createDataFrame([(10, 1, 1, "U", None, 3, 9.0), (11, 1, 2, "D", None, 4, None)], "lsn bigint, xid bigint, seq bigint, op string, old_k bigint, k bigint, v double")
    ingest_change_log(ctx, feed)
    rows = {r["k"]: r["v"] for r in current_rows(ctx).collect()}
    assert len(rows) == 99 and rows[3] == 9.0 and 4 not in rows and rows[50] == 5.0
