"""Runs a query and its SQL side by side and compares all rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when names, types and rows agree, else what differs."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    types = {d[0]: str(d[1]) for d in expected.description}
    rows = expected.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = [(c, t, types[c]) for c, t in df.dtypes if t not in _EQUAL.get(types[c], (t,))]
    if wrong:
        return f"types differ: {wrong}"
    order = sorted(names)
    theirs = Counter(tuple(row[names.index(c)] for c in order) for row in rows)
    ours = Counter(tuple(row[c] for c in order) for row in df.collect())
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return (
        f"rows {sum(ours.values())} != {sum(theirs.values())}; columns {order}; "
        f"only spark ({sum(more.values())}): {list(more)[:3]}; only oracle ({sum(less.values())}): {list(less)[:3]}"
    )


_EQUAL = {
    "BIGINT": ("bigint",),
    "INTEGER": ("int",),
    "DOUBLE": ("double",),
    "VARCHAR": ("string",),
    "BOOLEAN": ("boolean",),
    "TIMESTAMP": ("timestamp_ntz", "timestamp"),
    "HUGEINT": (),
    "DECIMAL": (),
}
