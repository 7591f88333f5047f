"""One run from its arguments: the six kinds of runs behind one call."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Row, SparkSession

from driftline.arguments import RunArguments, jdbc_options
from driftline.contracts import Contract
from driftline.operators.replay import resolve_replays
from driftline.plans.audit_log import ingest_audit_log
from driftline.plans.change_log import ingest_change_log
from driftline.plans.replay import replay
from driftline.plans.run import Ledger, RunContext
from driftline.plans.snapshot import ingest_snapshot
from driftline.shared import list_names
from driftline.sources.scan import Source, audit_log_scan, read_table, snapshot_scan

# Finds a contract by namespace, name and version; no version asks for the newest.
Contracts = Callable[[str, str, str | None], Contract]


def submit(
    spark: SparkSession,
    strategy: str,
    run_mode: str,
    conf: Mapping[str, Any],
    contracts: Contracts,
    ledger_root: str,
    **options: Any,
) -> RunContext:
    """Runs one ingest or replay and returns its context with the stage results.

    ``source_dsn`` is a ``postgresql://`` address or a folder of parquet tables;
    ``target_dsn`` is the folder of curated tables. ``options`` go to the run itself.
    """
    args = RunArguments.from_conf(strategy, run_mode, conf)
    ledger = Ledger(spark, ledger_root)
    version = args.contract_version
    resolved = None
    if run_mode == "replay":
        resolved = resolve_request(spark, args, ledger)
        if resolved["problem"]:
            raise ValueError(resolved["problem"])
        version = resolved["contract_version"]
    contract = contracts(args.namespace, args.name, version)
    ctx = RunContext(
        spark,
        contract,
        strategy,
        args.namespace,
        args.name,
        args.landing_root,
        f"{args.target_dsn.rstrip('/')}/{args.target_table_curated}",
        ledger,
        run_mode=run_mode,
    )
    if resolved is not None:
        parent, reason = args.values.get("parent_run_id"), args.replay_reason
        replay(ctx, resolved["artifact_key"], parent_run_id=parent, reason=reason, **options)
    elif strategy == "hash_diff":
        rows = snapshot_scan(spark, source_of(args), args.source_table, contract)
        ingest_snapshot(ctx, rows, source_table=args.source_table, **options)
    elif strategy == "incremental_audit":
        log = audit_log_scan(spark, source_of(args), args.source_audit_table, contract)
        ingest_audit_log(
            ctx,
            log,
            args.watermark_mode,
            source_table=args.source_table,
            source_audit_table=args.source_audit_table,
            **options,
        )
    else:
        if not args.change_feed_path:
            raise ValueError("a change-log run needs change_feed_path")
        feed = read_table(spark, Source(path=args.change_feed_path), "")
        table = args.source_table if "source_table" in feed.columns else None
        # Whole transactions only, wherever the feed says where they end.
        options.setdefault("commit", "tx_end" if "tx_end" in feed.columns else None)
        ingest_change_log(
            ctx,
            feed,
            table=table,
            source_table=args.source_table,
            publication=args.source_publication_name,
            slot=args.source_slot_name,
            **options,
        )
    return ctx


def source_of(args: RunArguments) -> Source:
    if not args.source_dsn.startswith("postgresql"):
        return Source(path=args.source_dsn.rstrip("/"))
    options = jdbc_options(args.source_dsn)
    return Source(
        format="jdbc",
        url=options.pop("url"),
        options=options,
        partition_column=args.source_partition_column,
        lower_bound=args.source_lower_bound,
        upper_bound=args.source_upper_bound,
        num_partitions=int(args.source_num_partitions or 1),
        fetch_size=args.values.get("source_batch_size") or args.values.get("extract_batch_size") or 1000,
    )


def resolve_request(spark: SparkSession, args: RunArguments, ledger: Ledger) -> Row:
    """The replay request of one run, resolved against the ledger and the landing folder."""
    request = spark.createDataFrame(
        [
            (
                "1",
                args.strategy,
                args.namespace,
                args.name,
                args.values.get("accepted_object_key"),
                args.parent_run_id,
                args.contract_version,
            )
        ],
        "request_id string, strategy string, namespace string, name string, object_key string, "
        "parent_run_id string, contract_version string",
    )
    stages = ledger.stages()
    no_manifest = spark.createDataFrame([], "manifest_key string, manifest_json string")
    no_artifact = spark.createDataFrame([], "artifact_key string")
    located = resolve_replays(request, stages, no_manifest, no_artifact).first()
    manifests, listing = no_manifest, no_artifact
    key, artifact = located["manifest_key"], located["artifact_key"]
    if key and _exists(spark, args, key):
        text = spark.read.text(f"{args.landing_root}/{key}", wholetext=True).first()["value"]
        manifests = spark.createDataFrame([(key, text)], no_manifest.schema)
    if artifact and _exists(spark, args, artifact):
        listing = spark.createDataFrame([(artifact,)], no_artifact.schema)
    return resolve_replays(request, stages, manifests, listing).first()


def _exists(spark: SparkSession, args: RunArguments, key: str) -> bool:
    folder, _, name = f"{args.landing_root}/{key.strip('/')}".rpartition("/")
    return name in list_names(spark, folder)
