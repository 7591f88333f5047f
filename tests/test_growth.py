"""Writes in proportion to change: bucket digests, buckets that split, positions of deleted keys."""

import os

import pytest
from pyspark.sql import functions as F

from checks.contracts import USERS
from checks.snapshot_queries import _context
from driftline.contracts import Contract, FieldRule
from driftline.operators.delta import POSITION_TYPE
from driftline.plans import deltas, ingest_audit_log, ingest_change_log, ingest_snapshot
from driftline.plans.deltas import apply_compacted, refuse_misfits
from driftline.plans.snapshot import current_rows
from driftline.sources import curated
from driftline.sources.curated import bucket_of, read_curated, read_pointer, split_source, with_splits

ITEMS = Contract("items", "1.0.0", (FieldRule("k", "bigint"), FieldRule("v", "double")), ("k",))


def items(spark, count, changed=()):
    value = F.when(F.col("id").isin(list(changed)), F.lit(-1.0)).otherwise(F.col("id") / 2)
    return spark.range(count).select(F.col("id").alias("k"), value.alias("v"))


def test_a_snapshot_rewrites_the_buckets_that_differ(spark, tmp_path):
    root = str(tmp_path)
    ingest_snapshot(_context(spark, ITEMS, "hash_diff", root), items(spark, 4000), buckets=64)
    first = read_pointer(spark, _context(spark, ITEMS, "hash_diff", root).target_root)
    rows = items(spark, 4000).select("k", bucket_of(["k"], 64).alias("b")).collect()
    changed = [next(r.k for r in rows if r.b == b) for b in (5, 40)]
    gone = next(r.k for r in rows if r.b == 40 and r.k not in changed)
    new = items(spark, 4000, changed).filter(F.col("k") != gone)
    ctx = _context(spark, ITEMS, "hash_diff", root)
    merge = ingest_snapshot(ctx, new, buckets=64)["merge_curated"]
    second = read_pointer(spark, ctx.target_root)
    assert [b for b in range(64) if first.bucket_folders[b] != second.bucket_folders[b]] == [5, 40]
    folder = f"{ctx.target_root}/data/{second.bucket_folders[5]}"
    assert sorted(n for n in os.listdir(folder) if n.startswith("_b")) == ["_bucket=40", "_bucket=5"]
    counts = ("read_count", "insert_count", "update_count", "delete_count", "unchanged_count", "processed_batches")
    assert [merge[c] for c in counts] == [3999, 0, 2, 1, 3997, 2]
    assert 0 < merge["written_bytes"] < sum(second.bucket_bytes) / 8
    assert sorted(current_rows(ctx).collect()) == sorted(new.collect())
    # Nothing differs, so nothing is written.
    same = _context(spark, ITEMS, "hash_diff", root)
    merge = ingest_snapshot(same, new, buckets=64)["merge_curated"]
    assert [merge[c] for c in counts] == [3999, 0, 0, 0, 3999, 0] and merge["written_bytes"] == 0
    assert read_pointer(spark, ctx.target_root) == second


def test_linear_hashing_moves_rows_of_split_buckets_only(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    for before, after in ((4, 5), (5, 7), (7, 8), (8, 11), (6, 6)):
        both = keys.select(bucket_of(["k"], before).alias("a"), bucket_of(["k"], after).alias("b")).distinct().collect()
        assert {r.b for r in both} == set(range(after))
        assert all(r.a == r.b or (r.b >= before and split_source(r.b) == r.a) for r in both)
    assert with_splits({1}, 5, 7) == ([1, 2, 5, 6], [1, 2])


def test_a_table_that_grows_splits_its_buckets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(curated, "BUCKET_BYTES", 6000)
    ctx = _context(spark, ITEMS, "incremental_audit", str(tmp_path))
    shares, at = [], 0
    for step in range(14):
        upto = (step + 1) * 1500
        delta = spark.range(at, upto).select(
            F.col("id").alias("k"), F.lit("I").alias("op"), F.rand(step).alias("v"),
            F.struct(F.col("id").alias("major"), F.lit(0).cast("bigint").alias("minor"), F.lit(0).alias("sub")).cast(POSITION_TYPE).alias("_position"),
        )
        before = read_pointer(spark, ctx.target_root)
        apply_compacted(ctx, curated_staged(delta), 2)
        at = upto
        now = read_pointer(spark, ctx.target_root)
        if before:
            assert len(now.bucket_versions) <= len(before.bucket_versions) * 1.25 + 1
        shares.append(len(now.bucket_versions))
    last = read_pointer(spark, ctx.target_root)
    assert last.row_count == read_curated(spark, ctx.target_root).select("k").distinct().count() == at
    assert shares[-1] >= 5 * shares[0] and sum(last.bucket_bytes) / shares[-1] < 6 * 6000
    one = spark.sql(f"SELECT 7L AS k, 'U' AS op, -5D AS v, CAST(named_struct('major', 99999L, 'minor', 0L, 'sub', 0) AS {POSITION_TYPE}) AS _position")
    # With nothing due to be split, a delta of one row rewrites one bucket.
    monkeypatch.setattr(curated, "BUCKET_BYTES", 1 << 30)
    apply_compacted(ctx, curated_staged(one), 2)
    after = read_pointer(spark, ctx.target_root)
    assert sum(a != b for a, b in zip(after.bucket_folders, last.bucket_folders, strict=True)) == 1
    assert read_curated(spark, ctx.target_root).filter("k = 7").first().v == -5.0


def curated_staged(df):
    return deltas.staged(df, "test-delta")


EVENTS = "audit_id bigint, op string, k bigint, v double, commit_timestamp timestamp_ntz, recorded_at timestamp_ntz"


def audit(spark, *rows):
    shaped = [f"({i}, '{op}', {k}, {v}D, NULL, TIMESTAMP_NTZ '2024-01-01 00:{m:02d}:00')" for i, op, k, v, m in rows]
    return spark.sql(f"SELECT * FROM VALUES {', '.join(shaped)} AS t(audit_id, op, k, v, commit_timestamp, recorded_at)").select(
        *[F.col(c.split()[0]).cast(c.split()[1]) for c in EVENTS.split(", ")]
    )


@pytest.mark.parametrize("most", [1, 16])
def test_late_commits_find_their_place(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(deltas, "_MOST_GRAVES", most)
    run = lambda events: ingest_audit_log(
        _context(spark, USERS, "incremental_audit", str(tmp_path)), events, "recorded_at", overlap=F.expr("INTERVAL 1 HOUR"), buckets=2
    )
    seen = [(9, "I", 1, 9.0, 5), (10, "I", 2, 5.0, 6), (11, "D", 2, 5.0, 8), (12, "I", 3, 5.0, 9), (14, "I", 5, 4.0, 9)]
    run(audit(spark, *seen))
    # A lower id at a later time wins; a change older than the delete of its key, or than its row, does not.
    late = [*seen, (8, "U", 1, 8.0, 7), (7, "U", 2, 7.0, 7), (6, "U", 3, 6.0, 8), (13, "D", 5, 0.0, 10)]
    counts = run(audit(spark, *late))["apply_delta"]
    assert (counts["update_count"], counts["insert_count"], counts["delete_count"]) == (1, 0, 1)
    run(audit(spark, *late))
    ctx = _context(spark, USERS, "incremental_audit", str(tmp_path))
    assert sorted((r.k, r.v) for r in current_rows(ctx).collect()) == [(1, 8.0), (3, 5.0)]


def test_an_old_row_without_a_clock_does_not_block_later_runs(spark, tmp_path):
    first = _context(spark, USERS, "incremental_audit", str(tmp_path))
    rows = audit(spark, (3, "I", 1, 3.0, 1))
    ingest_audit_log(first, rows, "recorded_at", buckets=2)
    blank = rows.withColumns({"audit_id": F.lit(2).cast("bigint"), "recorded_at": F.lit(None).cast("timestamp_ntz")})
    late = audit(spark, (4, "I", 2, 4.0, 2))
    ctx = _context(spark, USERS, "incremental_audit", str(tmp_path))
    ingest_audit_log(ctx, rows.unionByName(blank).unionByName(late), "recorded_at", buckets=2)
    assert sorted(r.k for r in current_rows(ctx).collect()) == [1, 2]
    newer = blank.withColumn("audit_id", F.lit(9).cast("bigint"))
    with pytest.raises(ValueError, match="1 events have no recorded_at"):
        ingest_audit_log(_context(spark, USERS, "incremental_audit", str(tmp_path)), rows.unionByName(newer), buckets=2)


def test_values_that_would_be_lost_are_refused(spark):
    state = spark.sql("SELECT * FROM VALUES (1L, 2.0D), (5000000000L, 3.0D) AS t(k, v)")
    narrow = Contract("items", "2.0.0", (FieldRule("k", "int"), FieldRule("v", "double")), ("k",))
    with pytest.raises(ValueError, match="k of bigint into int in 1 rows"):
        refuse_misfits(state, narrow)
    refuse_misfits(state.filter("k = 1"), narrow)
    refuse_misfits(state, narrow, spark.sql("SELECT 1 AS k"))


def test_a_window_end_inside_a_transaction_is_refused_without_the_flag(spark, tmp_path):
    rows = "(1L, 7L, 1L, 'I', NULL, 1L, 3D), (2L, 7L, 2L, 'I', NULL, 2L, 3D)"
    feed = spark.sql(f"SELECT lsn, xid, seq, op, CAST(old_k AS bigint) AS old_k, k, v FROM VALUES {rows} AS t(lsn, xid, seq, op, old_k, k, v)")
    ctx = _context(spark, USERS, "logical_cdc", str(tmp_path))
    with pytest.raises(ValueError, match="cuts 1 transactions"):
        ingest_change_log(ctx, feed, end_lsn=1, buckets=2)
    assert read_pointer(spark, ctx.target_root) is None
