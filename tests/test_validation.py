import pytest
from pyspark.sql import functions as F

from driftline.contracts import Contract, FieldRule
from driftline.operators.validation import (
    ValidationFailed,
    explode_errors,
    number_rows,
    quarantine_counts,
    quarantine_transactions,
    split_accepted,
    validate,
    validation_counts,
    validation_gate,
)

CONTRACT = Contract(
    "c",
    "1",
    (
        FieldRule("k", "bigint"),
        FieldRule("n", "int", nullable=False, minimum=0, maximum=9),
        FieldRule("s", "string", min_length=1, max_length=3, pattern="^[a-z]*$", allowed=("a", "bb")),
    ),
    ("k",),
)


def codes(df):
    rows = explode_errors(df).collect()
    return sorted((r["row_number"], r["field"], r["code"]) for r in rows)


def test_rules(spark):
    rows = [(1, "5", "a", 1), (2, "x", "a", 2), (3, None, "a", 3), (4, "10", "bb", 4), (5, "-1", "", 5), (6, "1", "ABCD", 6), (None, "1", "a", 7)]
    df = spark.createDataFrame(rows, "k bigint, n string, s string, at bigint")
    out = validate(df, CONTRACT, row_number=F.col("at"))
    assert codes(out) == [
        (2, "n", "type"),
        (3, "n", "not_null"),
        (4, "n", "range"),
        (5, "n", "range"),
        (5, "s", "allowed"),
        (5, "s", "length"),
        (6, "s", "allowed"),
        (6, "s", "length"),
        (6, "s", "pattern"),
        (7, "k", "null_key"),
    ]
    accepted, rejected = split_accepted(out)
    assert [r["k"] for r in accepted.collect()] == [1]
    assert dict(accepted.dtypes)["n"] == "int"
    counts = validation_counts(out).first().asDict()
    assert counts == {"source_row_count": 7, "invalid_row_count": 6, "accepted_row_count": 1, "error_count": 10}
    assert rejected.count() == 6


def test_every_copy_of_a_key_is_rejected(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "a"), (2, 1, "a"), (None, 1, "a"), (None, 1, "a")], "k bigint, n int, s string")
    out = validate(df, CONTRACT)
    assert [r["k"] for r in split_accepted(out)[0].collect()] == [2]
    found = [r["code"] for r in explode_errors(out).collect()]
    assert sorted(found) == ["duplicate_key", "duplicate_key", "null_key", "null_key"]


def test_keys_are_compared_as_typed(spark):
    df = spark.createDataFrame([("1", 1, "a"), ("01", 1, "a"), ("2", 1, "a"), ("x", 1, "a")], "k string, n int, s string")
    out = validate(df, CONTRACT)
    assert [r["k"] for r in split_accepted(out)[0].collect()] == [2]
    assert sorted(r["code"] for r in explode_errors(out).collect()) == ["duplicate_key", "duplicate_key", "type"]


def test_rules_when_spares_deletes(spark):
    df = spark.createDataFrame([(1, None, None, "D"), (2, None, "a", "U")], "k bigint, n int, s string, op string")
    out = validate(df, CONTRACT, unique_keys=False, rules_when=F.col("op") != "D")
    assert [r["k"] for r in split_accepted(out)[0].collect()] == [1]


def test_row_numbers_default_to_distinct_positions(spark):
    df = spark.range(100).select(F.col("id").alias("k"), F.lit(99).alias("n"), F.lit("a").alias("s"))
    numbers = [r["row_number"] for r in explode_errors(validate(df, CONTRACT, unique_keys=False)).collect()]
    assert len(set(numbers)) == 100


def test_empty_frame(spark):
    df = spark.createDataFrame([], "k bigint, n int, s string")
    counts = validation_counts(validate(df, CONTRACT)).first().asDict()
    assert set(counts.values()) == {0}


def test_missing_column_and_bad_contract(spark):
    with pytest.raises(ValueError, match="lacks"):
        validate(spark.range(1), CONTRACT)
    with pytest.raises(ValueError, match="key"):
        Contract("c", "1", (FieldRule("a", "int"),), ())
    with pytest.raises(ValueError, match="not declared"):
        Contract("c", "1", (FieldRule("a", "int"),), ("b",))
    with pytest.raises(ValueError, match="unique"):
        Contract("c", "1", (FieldRule("a", "int"), FieldRule("a", "int")), ("a",))
    assert Contract.from_dict(CONTRACT.to_dict()) == CONTRACT


def test_hot_key_is_marked_on_the_salted_path(spark, monkeypatch):
    import driftline.operators.validation as validation
    from driftline.shared import keyed_join

    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 10).alias("k"), F.lit(1).alias("n"), F.lit("a").alias("s")
    )
    plain = validation_counts(validate(df, CONTRACT)).first()
    monkeypatch.setattr(
        validation, "keyed_join", lambda big, small, keys, how: keyed_join(big, small, keys, how, limit_bytes=0)
    )
    assert validation_counts(validate(df, CONTRACT)).first() == plain
    assert plain["invalid_row_count"] == 1000


def test_transactions_are_held_whole(spark):
    df = spark.createDataFrame([(1, 0), (1, 1), (1, 0), (2, 0), (None, 1), (None, 0)], "xid bigint, bad int")
    invalid = F.col("bad") == 1
    marked = quarantine_transactions(df, invalid)
    held = sorted((str(r["xid"]), r["bad"], r["_quarantined"]) for r in marked.collect())
    assert held == [("1", 0, True), ("1", 0, True), ("1", 1, True), ("2", 0, False), ("None", 0, False), ("None", 1, True)]
    counts = quarantine_counts(marked.filter("xid is not null"), invalid).first().asDict()
    assert counts == {
        "invalid_event_count": 1,
        "invalid_transaction_count": 1,
        "quarantined_event_count": 3,
        "quarantined_transaction_count": 1,
    }


def test_numbers_are_consecutive(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    rows = number_rows(df, ["v"], partitions=5).collect()
    assert sorted((r["v"], r["_row_number"]) for r in rows) == [(i, i + 1) for i in range(1000)]


def test_gate():
    validation_gate(5, "quarantine")
    validation_gate(0, "fail")
    with pytest.raises(ValidationFailed) as failed:
        validation_gate(5, "fail", error_object_key="e", manifest_key="m", delta_object_key="d", invalid_event_count=5)
    assert failed.value.context() == {
        "validation_error_object_key": "e",
        "error_object_key": "e",
        "validation_manifest_key": "m",
        "manifest_key": "m",
        "delta_object_key": "d",
        "invalid_event_count": 5,
    }
    with pytest.raises(ValueError):
        validation_gate(0, "ignore")
