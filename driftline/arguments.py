"""Run arguments: which table to ingest, from where, to where.

Arguments come as one mapping, as a job submission would carry them. Each run kind
lists what it requires; everything else has a default.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import urlsplit

from driftline.operators.delta import WATERMARK_MODES


def whole_number(text: str) -> int:
    """A count of at least one."""
    if not text.lstrip("+-").isdigit():
        raise ValueError("must be an integer")
    if int(text) < 1:
        raise ValueError("must be greater than zero")
    return int(text)


def one_of(*allowed: str) -> Callable[[str], str]:
    def choose(text: str) -> str:
        if text not in allowed:
            raise ValueError(f"must be one of: {', '.join(sorted(allowed))}")
        return text

    return choose


@dataclass(frozen=True)
class Setting:
    """One argument: how its text becomes a value, and what stands in for it."""

    name: str
    convert: Callable[[str], Any] = str
    default: Any = None
    required: bool = False

    def text(self, conf: Mapping[str, Any]) -> str | None:
        given = conf.get(self.name)
        return None if given is None else str(given).strip() or None

    def value(self, conf: Mapping[str, Any]) -> Any:
        text = self.text(conf)
        if text is None:
            return self.default
        try:
            return self.convert(text)
        except ValueError as exc:
            raise ValueError(f"{self.name} {exc}") from exc


def _needed(*names: str) -> tuple[Setting, ...]:
    return tuple(Setting(name, required=True) for name in names)


# Argument names and defaults per run kind. Only arguments that a run acts
# on are listed; others in a submitted mapping are passed over.
_EVERY = (
    *_needed("namespace", "name", "target_dsn", "target_table_curated", "landing_s3_bucket"),
    Setting("landing_s3_prefix", default="accepted"),
    Setting("contract_version"),
)
_READ = (
    *_needed("source_dsn", "source_table"),
    Setting("source_partition_column"),
    Setting("source_lower_bound"),
    Setting("source_upper_bound"),
    Setting("source_num_partitions", whole_number),
)
_REPLAY = (*_EVERY, Setting("replay_reason"))
KINDS: dict[tuple[str, str], tuple[Setting, ...]] = {
    ("hash_diff", "ingest"): (*_EVERY, *_READ, Setting("source_batch_size", whole_number, 1000)),
    ("hash_diff", "replay"): (*_REPLAY, Setting("accepted_object_key"), Setting("parent_run_id")),
    ("incremental_audit", "ingest"): (
        *_EVERY,
        *_READ,
        *_needed("source_audit_table"),
        Setting("extract_batch_size", whole_number, 1000),
        Setting("watermark_mode", one_of(*WATERMARK_MODES), "auto"),
    ),
    ("incremental_audit", "replay"): (*_REPLAY, *_needed("parent_run_id")),
    ("logical_cdc", "ingest"): (
        *_EVERY,
        *_READ,
        *_needed("source_publication_name", "source_slot_name"),
        Setting("change_feed_path"),
        Setting("output_plugin", one_of("pgoutput"), "pgoutput"),
    ),
    ("logical_cdc", "replay"): (*_REPLAY, *_needed("parent_run_id")),
}


@dataclass(frozen=True)
class RunArguments:
    """Checked arguments of one run. Kind-specific ones are read as attributes."""

    strategy: str
    run_mode: str
    namespace: str
    name: str
    contract_version: str | None
    landing_root: str
    values: Mapping[str, Any] = field(default_factory=dict)

    def __getattr__(self, item: str) -> Any:
        values = object.__getattribute__(self, "values")
        if item in values:
            return values[item]
        raise AttributeError(item)

    @property
    def pipeline_id(self) -> str:
        return f"{self.namespace}.{self.name}.{self.strategy}"

    @classmethod
    def from_conf(cls, strategy: str, run_mode: str, conf: Mapping[str, Any]) -> "RunArguments":
        settings = KINDS.get((strategy, run_mode))
        if settings is None:
            raise ValueError(f"no such run kind: {strategy} {run_mode}")
        if run_mode == "replay" and strategy != "hash_diff" and Setting("delta_object_key").text(conf):
            raise ValueError("delta_object_key is not supported; use parent_run_id")
        missing = sorted(s.name for s in settings if s.required and s.text(conf) is None)
        if missing:
            raise ValueError(f"run arguments without a value: {', '.join(missing)}")
        values = {s.name: s.value(conf) for s in settings}
        if (strategy, run_mode) == ("hash_diff", "replay"):
            if (values["accepted_object_key"] is None) == (values["parent_run_id"] is None):
                raise ValueError("a replay takes exactly one of accepted_object_key and parent_run_id")
        bucket = values.pop("landing_s3_bucket")
        scheme = "" if "://" in bucket or bucket.startswith("/") else "s3a://"
        root = f"{scheme}{bucket}/{values.pop('landing_s3_prefix')}"
        own = [values.pop(name) for name in ("namespace", "name", "contract_version")]
        return cls(strategy, run_mode, *own, root, values)


def jdbc_options(dsn: str) -> dict[str, str]:
    """JDBC url and credentials of a ``postgresql://`` address."""
    parts = urlsplit(dsn)
    if not parts.scheme.startswith("postgresql"):
        raise ValueError("only postgresql addresses are known")
    options = {"url": f"jdbc:postgresql://{parts.hostname}:{parts.port or 5432}{parts.path}"}
    if parts.username:
        options["user"] = parts.username
    if parts.password:
        options["password"] = parts.password
    return options
