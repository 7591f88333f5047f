"""The six runs: ingest and replay for each of the three strategies."""

from driftline.plans.audit_log import ingest_audit_log
from driftline.plans.change_log import ingest_change_log
from driftline.plans.replay import replay
from driftline.plans.run import Ledger, RunContext
from driftline.plans.snapshot import ingest_snapshot
from driftline.plans.submit import submit

__all__ = [
    "Ledger",
    "RunContext",
    "ingest_audit_log",
    "ingest_change_log",
    "ingest_snapshot",
    "replay",
    "submit",
]
