"""Contracts of the checked tables."""

from __future__ import annotations

from driftline.contracts import Contract, FieldRule

ORDERS = Contract(
    "orders",
    "1.0.0",
    (
        FieldRule("o_orderkey", "bigint"),
        FieldRule("o_custkey", "bigint"),
        FieldRule("o_orderstatus", "string"),
        FieldRule("o_totalprice", "double"),
        FieldRule("o_orderdate", "timestamp_ntz"),
        FieldRule("o_orderpriority", "string"),
    ),
    ("o_orderkey",),
)

DIRTY_LINES = Contract(
    "lines",
    "1.0.0",
    (
        FieldRule("id", "bigint"),
        FieldRule("qty", "int", nullable=False, minimum=2, maximum=45),
        FieldRule("price", "double", nullable=False),
        FieldRule("flag", "string", allowed=("A", "N")),
        FieldRule("state", "string", max_length=1, pattern="^[FO]"),
    ),
    ("id",),
)

USERS = Contract("users", "1.0.0", (FieldRule("k", "bigint"), FieldRule("v", "double", minimum=2.0)), ("k",))

EVENTS = Contract(
    "events", "1.0.0", (FieldRule("user_id", "bigint"), FieldRule("value", "double")), ("user_id",)
)
