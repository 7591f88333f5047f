import pytest
from pyspark.sql import functions as F

from checks.contracts import ORDERS, USERS
from checks.fixtures import frame
from driftline.arguments import RunArguments
from driftline.plans import submit
from driftline.plans.snapshot import current_rows
from driftline.plans.submit import source_of


def conf_of(tmp_path, **more):
    return {
        "namespace": "sales",
        "name": "t",
        "source_dsn": str(tmp_path / "src"),
        "source_table": "rows",
        "target_dsn": str(tmp_path / "curated"),
        "target_table_curated": "t",
        "landing_s3_bucket": str(tmp_path / "landing"),
        **more,
    }


def same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_snapshot_ingest_then_replay(spark, sf_dir, tmp_path):
    asked = []

    def contracts(namespace, name, version):
        asked.append((namespace, name, version))
        return ORDERS

    ledger = str(tmp_path / "ledger")
    first_rows = frame(spark, sf_dir, "cur_orders")
    first_rows.write.parquet(str(tmp_path / "src" / "rows"))
    first = submit(spark, "hash_diff", "ingest", conf_of(tmp_path), contracts, ledger, buckets=4)
    frame(spark, sf_dir, "src_orders").write.parquet(str(tmp_path / "src2" / "rows"))
    submit(spark, "hash_diff", "ingest", conf_of(tmp_path, source_dsn=str(tmp_path / "src2")), contracts, ledger)
    for request in ({"parent_run_id": first.run_id}, {"accepted_object_key": first.keys["accepted_key"]}):
        again = submit(spark, "hash_diff", "replay", conf_of(tmp_path, **request), contracts, ledger)
        assert same(current_rows(again), first_rows)
    assert asked == [("sales", "t", None)] * 2 + [("sales", "t", "1.0.0")] * 2
    assert {r["status"] for r in first.ledger.runs().collect()} == {"success"}
    with pytest.raises(ValueError, match="manifest was not found"):
        submit(spark, "hash_diff", "replay", conf_of(tmp_path, parent_run_id="none"), contracts, ledger)


def test_delta_runs(spark, sf_dir, tmp_path):
    contracts = lambda *_: USERS
    ledger = str(tmp_path / "ledger")
    events = frame(spark, sf_dir, "audit_events")
    events.write.parquet(str(tmp_path / "src" / "audit"))
    conf = conf_of(tmp_path, source_audit_table="audit")
    log = submit(spark, "incremental_audit", "ingest", conf, contracts, ledger, buckets=4)
    state = sorted(current_rows(log).collect())
    again = submit(spark, "incremental_audit", "replay", conf_of(tmp_path, parent_run_id=log.run_id), contracts, ledger)
    assert sorted(current_rows(again).collect()) == state and state

    feed = frame(spark, sf_dir, "wal_events").select("lsn", "xid", "seq", "op", "old_k", "k", "v", "source_table")
    feed.withColumn("source_table", F.lit("rows")).write.parquet(str(tmp_path / "feed"))
    cdc = conf_of(
        tmp_path,
        target_table_curated="u",
        source_replication_dsn="postgresql://h/d",
        source_publication_name="p",
        source_slot_name="s",
    )
    with pytest.raises(ValueError, match="change_feed_path"):
        submit(spark, "logical_cdc", "ingest", cdc, contracts, ledger)
    cdc["change_feed_path"] = str(tmp_path / "feed")
    run = submit(spark, "logical_cdc", "ingest", cdc, contracts, ledger, buckets=4)
    assert run.results["extract_validate_land_wal_delta"]["source_event_count"] == feed.count()
    with pytest.raises(ValueError, match="delta artifact was not found"):
        missing = conf_of(tmp_path, parent_run_id="none", contract_version="1")
        submit(spark, "logical_cdc", "replay", missing, contracts, ledger)


def test_jdbc_source(tmp_path):
    conf = conf_of(tmp_path, source_dsn="postgresql+psycopg2://u:p@h/db", source_partition_column="id", source_lower_bound="1", source_upper_bound="9", source_num_partitions="4")
    source = source_of(RunArguments.from_conf("hash_diff", "ingest", conf))
    assert (source.format, source.url, source.options) == ("jdbc", "jdbc:postgresql://h:5432/db", {"user": "u", "password": "p"})
    assert (source.partition_column, source.num_partitions, source.fetch_size) == ("id", 4, 1000)
