import pytest
from pyspark.sql import functions as F

from checks.fixtures import frame
from driftline.operators.delta import (
    apply_delta,
    classify_delta,
    compact_delta,
    delta_counts,
    expand_key_changes,
    extract_delta,
    resolve_watermark_mode,
    watermark_column,
    window_bounds,
)
from driftline.operators.diff import ROW_HASH, change_counts, hash_diff, merge_counts, merge_snapshot

KEY = ["o_orderkey"]


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return frame(spark, sf_dir, "src_orders"), frame(spark, sf_dir, "cur_orders")


def test_counts_add_up(orders):
    new, old = orders
    c = change_counts(hash_diff(new, old, KEY)).first()
    assert (c["insert_count"], c["update_count"], c["delete_count"], c["unchanged_count"]) == (105, 243, 126, 1015)
    assert c["insert_count"] + c["update_count"] + c["unchanged_count"] == new.count() == c["read_count"]
    assert c["delete_count"] + c["update_count"] + c["unchanged_count"] == old.count()


def test_both_fingerprints_agree(orders):
    new, old = orders
    assert same(hash_diff(new, old, KEY), hash_diff(new, old, KEY, method="sha256"))


def test_merging_again_changes_nothing(orders):
    new, old = orders
    state = merge_snapshot(new, old, KEY, "r1")
    again = merge_snapshot(new, state, KEY, "r2")
    counts = merge_counts(again, state.count()).first().asDict()
    assert counts["unchanged_count"] == new.count() == counts["read_count"]
    assert sum(counts[c] for c in ("insert_count", "update_count", "delete_count", "protected_count")) == 0
    assert {r["_run_id"] for r in again.select("_run_id").distinct().collect()} <= {"r1", None}
    assert same(hash_diff(new, state, KEY).groupBy("action").count(), hash_diff(new, again, KEY).groupBy("action").count())


def test_first_merge_inserts_all(orders):
    state = merge_snapshot(orders[0], None, KEY, "r1")
    assert merge_counts(state, 0).first()["insert_count"] == orders[0].count()


def test_rejected_keys_are_not_deleted(spark, orders):
    new, old = orders
    bad = old.filter("o_orderkey % 11 = 0").select("o_orderkey").union(spark.createDataFrame([(None,), (10**9,)], "o_orderkey bigint"))
    c = hash_diff(new, old, KEY, rejected=bad).groupBy("action").count().collect()
    assert {r["action"] for r in c} == {"insert", "update", "unchanged", "protected"}
    merged = merge_snapshot(new, old, KEY, "r", rejected=bad)
    assert merged.select("o_orderkey").distinct().count() == merged.count() == new.count() + 126
    assert merge_counts(merged, old.count()).first()["delete_count"] == 0


def test_a_rejected_key_that_is_also_accepted_stays_single(spark):
    new = spark.createDataFrame([(1, "a")], "o_orderkey bigint, v string")
    old = spark.createDataFrame([(1, "b"), (2, "c")], "o_orderkey bigint, v string")
    bad = spark.createDataFrame([(1,), (2,)], "o_orderkey bigint")
    rows = {r["o_orderkey"]: r["action"] for r in hash_diff(new, old, KEY, rejected=bad).collect()}
    assert rows == {1: "update", 2: "protected"}
    merged = merge_snapshot(new, old, KEY, "r", rejected=bad).drop(ROW_HASH)
    assert sorted((r["o_orderkey"], r["v"], r["_change"]) for r in merged.collect()) == [(1, "a", "update"), (2, "c", "protected")]


def test_null_and_empty_are_different(spark):
    new = spark.createDataFrame([(1, None, "x"), (2, "", None)], "k int, a string, b string")
    old = spark.createDataFrame([(1, "x", None), (2, None, "")], "k int, a string, b string")
    assert [r["action"] for r in hash_diff(new, old, ["k"]).collect()] == ["update", "update"]


DELTA = "k bigint, op string, v double, audit_id bigint"


def test_compact_apply_and_counts(spark):
    curated = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (5, None)], "k bigint, v double")
    events = spark.createDataFrame(
        [(1, "U", 9.0, 1), (1, "U", 1.0, 2), (2, "D", None, 3), (4, "I", 4.0, 4), (6, "I", 6.0, 5), (6, "D", None, 6), (3, "U", 8.0, 7), (5, "U", None, 8)],
        DELTA,
    )
    delta = compact_delta(events, ["k"], ["audit_id"]).drop("audit_id")
    once = apply_delta(curated, delta, ["k"])
    assert sorted((r["k"], r["v"]) for r in once.collect()) == [(1, 1.0), (3, 8.0), (4, 4.0), (5, None)]
    assert same(apply_delta(once, delta, ["k"]), once)
    counts = delta_counts(curated, delta, ["k"]).first().asDict()
    assert counts == {"read_count": 6, "insert_count": 1, "update_count": 1, "delete_count": 1, "unchanged_count": 2, "noop_delete_count": 1}
    kinds = {r["k"]: r["action"] for r in classify_delta(curated, delta, ["k"]).collect()}
    assert kinds == {1: "unchanged", 2: "delete", 3: "update", 4: "insert", 5: "unchanged", 6: "noop_delete"}


def test_empty_delta(spark):
    curated = spark.createDataFrame([(1, 1.0)], "k bigint, v double")
    empty = spark.createDataFrame([], "k bigint, op string, v double")
    assert same(apply_delta(curated, empty, ["k"]), curated)
    assert set(delta_counts(curated, empty, ["k"]).first().asDict().values()) == {0}


def test_guard_ignores_older_events(spark):
    curated = spark.createDataFrame([(1, 1.0, 10), (2, 2.0, 10)], "k bigint, v double, _position bigint")
    delta = spark.createDataFrame([(1, "U", 5.0, 9), (2, "U", 6.0, 11), (3, "I", 7.0, 1)], "k bigint, op string, v double, _position bigint")
    rows = sorted((r["k"], r["v"]) for r in apply_delta(curated, delta, ["k"], guard=True).collect())
    assert rows == [(1, 1.0), (2, 6.0), (3, 7.0)]
    assert sorted(r["v"] for r in apply_delta(curated, delta, ["k"]).collect()) == [5.0, 6.0, 7.0]


def test_key_changes(spark):
    events = spark.createDataFrame([(1, 7, "U", None), (2, 8, "U", 1), (3, 3, "U", 3), (4, 5, "D", None)], "lsn bigint, k bigint, op string, old_k bigint")
    rows = sorted((r["lsn"], r["_sub"], r["k"], r["op"]) for r in expand_key_changes(events, ["k"], ["old_k"]).collect())
    assert rows == [(1, 1, 7, "U"), (2, 0, 1, "D"), (2, 1, 8, "U"), (3, 1, 3, "U"), (4, 1, 5, "D")]


def test_composite_key_change(spark):
    events = spark.createDataFrame([(1, "a", 2, "a", "U"), (1, "a", 1, "a", "U"), (1, "a", None, "a", "U")], "k int, j string, old_k int, old_j string, op string")
    rows = expand_key_changes(events, ["k", "j"], ["old_k", "old_j"]).filter("_sub = 0").collect()
    assert [(r["k"], r["j"], r["op"]) for r in rows] == [(2, "a", "D")]


def test_swapped_keys_keep_both_rows(spark):
    """Two rows exchange keys in one window: the later event decides each key."""
    curated = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k bigint, v double")
    events = spark.createDataFrame([(10, "U", 3, 1, 1.0), (11, "U", 1, 2, 2.0), (12, "U", 2, 3, 1.0)], "lsn bigint, op string, k bigint, old_k bigint, v double")
    halves = expand_key_changes(events, ["k"], ["old_k"])
    delta = compact_delta(halves, ["k"], ["lsn", "_sub"]).select("k", "op", "v")
    assert sorted((r["k"], r["v"]) for r in apply_delta(curated, delta, ["k"]).collect()) == [(1, 2.0), (2, 1.0)]


def test_watermark_modes(spark, sf_dir):
    events = frame(spark, sf_dir, "audit_events")
    assert resolve_watermark_mode(events, "auto") == "recorded_at"
    assert resolve_watermark_mode(events.dropna(subset=["commit_timestamp"]), "auto") == "commit_timestamp"
    complete = events.dropna(subset=["commit_timestamp"])
    assert resolve_watermark_mode(complete, "auto", stored="commit_timestamp") == "commit_timestamp"
    for mode, stored in (("auto", "commit_timestamp"), ("commit_timestamp", None)):
        with pytest.raises(ValueError, match="events have no commit_timestamp"):
            resolve_watermark_mode(events, mode, stored=stored)
    with pytest.raises(ValueError, match="changed"):
        resolve_watermark_mode(events, "recorded_at", stored="commit_timestamp")
    with pytest.raises(ValueError, match="must be one of: auto, commit_timestamp, recorded_at"):
        watermark_column(events, "latest")
    complete = watermark_column(events.dropna(subset=["commit_timestamp"]), "auto")
    assert complete.filter("_watermark <> commit_timestamp").count() == 0


def test_windows_neither_lose_nor_repeat_ties(spark, sf_dir):
    events = frame(spark, sf_dir, "audit_events").withColumn("_watermark", F.col("hour_at"))
    busy = events.groupBy("hour_at").agg(F.count("*").alias("n"), F.min("audit_id").alias("i")).orderBy(F.desc("n")).first()
    cut = (F.lit(str(busy["hour_at"])).cast("timestamp_ntz"), busy["i"])
    early, late = extract_delta(events, end=cut), extract_delta(events, start=cut)
    assert early.count() + late.count() == events.count()
    assert early.join(late, "audit_id").count() == 0
    overlap = extract_delta(events, start=cut, overlap=F.expr("interval 2 hours"))
    assert overlap.count() > late.count()
    last, first = window_bounds(early).first(), window_bounds(late).first()
    assert (last["window_end"], last["window_end_id"]) == (busy["hour_at"], busy["i"])
    assert first["window_start"] == busy["hour_at"] and first["window_start_id"] > busy["i"]


def test_watermark_bound_reaches_the_scan(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    cut = (F.lit("2024-01-10 00:00:00").cast("timestamp_ntz"), 5)
    plan = extract_delta(events, start=cut, watermark="ts", tie_break="event_id")._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts" in plan


def test_diff_reads_only_keys_and_stored_fingerprints(spark, orders, tmp_path):
    state = merge_snapshot(orders[0], None, KEY, "r1")
    state.write.parquet(str(tmp_path / "state"))
    stored = spark.read.parquet(str(tmp_path / "state"))
    plan = hash_diff(orders[0], stored, KEY)._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "_row_hash" in line]
    assert len(scans) == 1 and "o_totalprice" not in scans[0]


def test_small_delta_does_not_shuffle_the_curated_table(spark, orders):
    delta = orders[0].limit(5).withColumn("op", F.lit("U"))
    plan = apply_delta(orders[1], delta, KEY)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
