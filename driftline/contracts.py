"""Data contracts: the declared columns, keys and rules of one ingested table."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping
from dataclasses import asdict, dataclass, field
from typing import Any


@dataclass(frozen=True)
class FieldRule:
    """One contract column. ``type`` is a Spark DDL type such as ``bigint``."""

    name: str
    type: str
    nullable: bool = True
    minimum: float | int | None = None
    maximum: float | int | None = None
    min_length: int | None = None
    max_length: int | None = None
    pattern: str | None = None
    allowed: tuple[Any, ...] | None = None


@dataclass(frozen=True)
class Contract:
    contract_id: str
    version: str
    fields: tuple[FieldRule, ...]
    keys: tuple[str, ...]
    checksum: str = field(default="")

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if not self.keys:
            raise ValueError("a contract needs at least one key column")
        unknown = [k for k in self.keys if k not in names]
        if unknown:
            raise ValueError(f"key columns are not declared: {', '.join(unknown)}")
        if len(set(names)) != len(names):
            raise ValueError("contract columns must be unique")
        if not self.checksum:
            object.__setattr__(self, "checksum", self._digest())

    def _digest(self) -> str:
        body = {"fields": [asdict(f) for f in self.fields], "keys": list(self.keys)}
        text = json.dumps(body, sort_keys=True, default=list)
        return hashlib.sha256(text.encode()).hexdigest()

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def value_columns(self) -> list[str]:
        return [f.name for f in self.fields if f.name not in self.keys]

    @property
    def ddl(self) -> str:
        """Schema text for explicit reads; nothing is ever inferred."""
        return ", ".join(f"`{f.name}` {f.type}" for f in self.fields)

    @classmethod
    def from_dict(cls, payload: Mapping[str, Any]) -> "Contract":
        fields = tuple(
            FieldRule(**{**f, "allowed": tuple(f["allowed"]) if f.get("allowed") is not None else None})
            for f in payload["fields"]
        )
        return cls(
            contract_id=str(payload["contract_id"]),
            version=str(payload["version"]),
            fields=fields,
            keys=tuple(payload["keys"]),
            checksum=str(payload.get("checksum") or ""),
        )

    def to_dict(self) -> dict[str, Any]:
        return {
            "contract_id": self.contract_id,
            "version": self.version,
            "checksum": self.checksum,
            "keys": list(self.keys),
            "fields": [asdict(f) for f in self.fields],
        }
