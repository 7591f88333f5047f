"""Every registered query against its SQL, over whole tables."""

import pytest

import __spark_entry__ as entry_point
from checks.compare import compare

QUERIES = {name: run for name, (run, _) in entry_point.ENGINE.items()}
SQL = {name: sql for name, (_, sql) in entry_point.ENGINE.items() if sql}


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, con, name):
    assert compare(QUERIES[name](spark, sf_dir), con, SQL[name]) is None


def test_entry_counts(spark):
    counts = {r["action"]: r["n"] for r in entry_point.entry(spark).collect()}
    assert counts == {"insert": 105, "update": 243, "delete": 126, "unchanged": 1015}
