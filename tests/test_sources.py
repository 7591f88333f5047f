import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from driftline.contracts import Contract, FieldRule
from driftline.sources.curated import read_curated, read_pointer, touched_buckets, write_curated
from driftline.sources.landing import (
    artifact_keys,
    artifact_listing,
    artifact_sizes,
    artifact_total,
    land_accepted,
    read_landed,
    read_manifest,
    write_manifest,
)
from driftline.operators.replay import manifest_key_of
from driftline.shared import (
    broadcast_limit,
    keyed_join,
    scan_bytes,
    scratch_scope,
    shared_folder,
    staged,
    write_text,
)

ROWS = Contract(
    "r",
    "1",
    (
        FieldRule("k", "bigint"),
        FieldRule("t", "timestamp"),
        FieldRule("n", "timestamp_ntz"),
        FieldRule("d", "double"),
        FieldRule("m", "decimal(12,4)"),
        FieldRule("s", "string"),
        FieldRule("a", "array<int>"),
        FieldRule("day", "date"),
    ),
    ("k",),
)


def test_golden_keys():
    assert artifact_keys("hash_diff", "sales", "orders", "run-1") == {
        "accepted_key": "sales/orders/run_id=run-1/accepted/accepted_snapshot.ndjson.gz",
        "error_key": "sales/orders/run_id=run-1/accepted/errors.ndjson.gz",
        "manifest_key": "sales/orders/run_id=run-1/accepted/manifest.json",
    }
    assert artifact_keys("incremental_audit", "sales", "orders", "r")["accepted_key"] == "sales/orders/run_id=r/delta/accepted_delta.ndjson.gz"
    assert artifact_keys("logical_cdc", "sales", "orders", "r")["error_key"] == "sales/orders/run_id=r/wal_delta/errors.ndjson.gz"
    with pytest.raises(ValueError):
        artifact_keys("other", "a", "b", "c")


def test_manifest_of_a_snapshot(spark):
    cases = {
        "s/o/run_id=1/accepted/accepted_snapshot.ndjson.gz": "s/o/run_id=1/accepted/manifest.json",
        " /s/o/accepted/accepted_snapshot.ndjson.gz/ ": "s/o/accepted/manifest.json",
        "accepted/accepted_snapshot.ndjson.gz": None,
        "s/o/delta/accepted_delta.ndjson.gz": None,
        None: None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "k string")
    assert [r["m"] for r in df.select(manifest_key_of(F.col("k")).alias("m")).collect()] == list(cases.values())


def test_values_survive_landing(spark, tmp_path):
    rows = [
        (1, dt.datetime(2024, 1, 1, 1, 2, 3, 456789), dt.datetime(2024, 1, 1, 0, 0, 0, 1), 1.5, None, 'q"\n', [1, None], dt.date(2024, 2, 29)),
        (2, None, None, float("inf"), None, None, None, None),
        (3, None, None, -0.1, None, "", [], None),
    ]
    df = spark.createDataFrame(rows, ROWS.ddl).withColumn("m", F.lit("12345678.9012").cast("decimal(12,4)"))
    land_accepted(df, str(tmp_path / "x.ndjson.gz"), rows_per_file=1)
    back = read_landed(spark, str(tmp_path / "x.ndjson.gz"), ROWS)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    assert all(n.endswith(".json.gz") for n in os.listdir(tmp_path / "x.ndjson.gz") if n.startswith("part"))


def test_contract_gains_and_loses_columns(spark, tmp_path):
    spark.createDataFrame([(1, "a", 2)], "k bigint, gone string, s int").write.json(str(tmp_path / "j"))
    later = Contract("r", "2", (FieldRule("k", "bigint"), FieldRule("s", "int"), FieldRule("new", "string")), ("k",))
    assert [tuple(r) for r in read_landed(spark, str(tmp_path / "j"), later).collect()] == [(1, 2, None)]


def test_broken_landing_fails(spark, tmp_path):
    write_text(spark, str(tmp_path / "bad.json"), '{"k": 1}\n{"k": oops}\n')
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_landed(spark, str(tmp_path / "bad.json"), ROWS).collect()


def test_manifest(spark, tmp_path):
    write_manifest(spark, str(tmp_path / "manifest.json"), run_id="r", contract_version="1.0", accepted_count=3)
    row = read_manifest(spark, str(tmp_path / "manifest.json")).first()
    assert (row["run_id"], row["contract_version"], row["accepted_count"], row["error_count"]) == ("r", "1.0", 3, None)


def test_sizes_of_landed_artifacts(spark, tmp_path):
    for key, rows in (("s/t/run_id=1/accepted.gz", 10), ("s/t/run_id=1/errors.gz", 5)):
        land_accepted(spark.range(rows).repartition(2), str(tmp_path / key))
    listing = artifact_listing(spark, str(tmp_path))
    real = {
        key: sum(os.path.getsize(tmp_path / key / n) for n in os.listdir(tmp_path / key) if n.startswith("part"))
        for key in ("s/t/run_id=1/accepted.gz", "s/t/run_id=1/errors.gz")
    }
    assert {r["artifact_key"]: r["size_bytes"] for r in listing.collect()} == real
    payload = (
        '{"accepted_object_key":"s/t/run_id=1/accepted.gz","error_object_key":"s/t/run_id=1/errors.gz",'
        '"validation_error_object_key":" s/t/run_id=1/errors.gz ","manifest_key":"s/t/run_id=1/errors.gz",'
        '"delta_object_key":"gone","validation_manifest_key":" "}'
    )
    payloads = spark.createDataFrame([(1, payload), (2, '{"delta_object_key":"gone"}')], "id int, payload string")
    found = {r["metric_key"]: r["size_bytes"] for r in artifact_sizes(payloads, listing, ["id"]).collect()}
    accepted, errors = real.values()
    assert found == {"accepted_object_key": accepted, "error_object_key": errors, "validation_error_object_key": errors}
    assert [tuple(r) for r in artifact_total(payloads, listing, ["id"]).collect()] == [(1, accepted + 2 * errors)]


def test_pointer_moves_last(spark, tmp_path):
    root = str(tmp_path / "c")
    assert read_pointer(spark, root) is None and read_curated(spark, root) is None
    df = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    first = write_curated(df, root, ["k"], "r1", buckets=8)
    with pytest.raises(ValueError, match="expected 7"):
        write_curated(df, root, ["k"], "r2", previous=first, expected_rows=7)
    assert read_pointer(spark, root) == first
    second = write_curated(df.limit(0), root, ["k"], "r3", previous=first)
    assert second.row_count == 0 and read_curated(spark, root).count() == 0
    assert read_curated(spark, root, first).count() == 100
    with pytest.raises(FileExistsError):
        write_curated(df, root, ["k"], "late", previous=first)


def test_only_touched_buckets_are_rewritten(spark, tmp_path):
    root = str(tmp_path / "c")
    df = spark.range(1000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    first = write_curated(df, root, ["k"], "r1", buckets=16)
    delta = spark.createDataFrame([(5,), (6,)], "k bigint")
    touched = touched_buckets(delta, ["k"], 16)
    part = read_curated(spark, root, first, touched).withColumn("v", F.lit("b"))
    second = write_curated(part, root, ["k"], "r2", previous=first, only=touched)
    assert second.row_count == 1000
    assert {v for b, v in enumerate(second.bucket_versions) if b not in touched} == {1}
    assert sorted(n for n in os.listdir(f"{root}/data/{second.bucket_folders[touched[0]]}") if n.startswith("_b")) == sorted(f"_bucket={b}" for b in touched)
    with pytest.raises(ValueError, match="outside"):
        write_curated(df, root, ["k"], "r3", previous=second, only=touched)


def test_a_bucket_emptied_by_deletes_reads_as_empty(spark, tmp_path):
    root = str(tmp_path / "c")
    df = spark.range(50).select(F.col("id").alias("k"))
    first = write_curated(df, root, ["k"], "r1", buckets=4)
    gone = read_curated(spark, root, first, [2])
    second = write_curated(gone.limit(0), root, ["k"], "r2", previous=first, only=[2])
    assert read_curated(spark, root, second).count() == 50 - gone.count() == second.row_count


def test_staged_tables_live_in_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    table = staged(spark.range(10), "t")
    assert table.count() == 10 and shared_folder(spark) in table.inputFiles()[0]
    assert 0 < scan_bytes(table) < broadcast_limit(spark)


def test_a_scope_removes_what_it_staged(spark):
    outside = staged(spark.range(3), "out").inputFiles()[0].removeprefix("file://")
    with scratch_scope(spark):
        inside = staged(spark.range(3), "in").inputFiles()[0].removeprefix("file://")
        assert os.path.exists(inside)
    assert os.path.exists(outside) and not os.path.exists(inside)


@pytest.mark.parametrize("how", ["left", "left_anti", "left_semi", "inner"])
def test_shuffled_join_equals_broadcast_join(spark, how):
    big = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id").repartition(6)
    small = staged(spark.range(0, 500).select(F.col("id").alias("k"), F.lit("x").alias("mark")), "small")
    plain = keyed_join(big, small, ["k"], how)
    shuffled = keyed_join(big, small, ["k"], how, limit_bytes=0)
    assert "SortMergeJoin" in shuffled._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plain._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, plain.collect())) == sorted(map(str, shuffled.collect()))


def test_each_task_writes_one_bucket(spark, tmp_path):
    root = str(tmp_path / "c")
    df = spark.range(4000).select(F.col("id").alias("k"), F.lit("a").alias("v"))
    first = write_curated(df, root, ["k"], "r1", buckets=4)
    folders = [f"{root}/data/{folder}/_bucket={b}" for b, folder in enumerate(first.bucket_folders)]
    files = [n for folder in folders for n in os.listdir(folder) if n.endswith(".parquet")]
    assert len(files) == 4
