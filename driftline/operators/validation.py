"""Contract validation, quarantine and the validation gate.

Rules compile to built-in column expressions. A row carries an array of
violations; an accepted row carries an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from driftline.contracts import Contract, FieldRule
from driftline.shared import keyed_join, staged
from driftline.sources.landing import ERROR_DDL

# Insert, update, delete.
OPERATIONS = ("I", "U", "D")

VIOLATIONS = "_violations"
REJECTED = "_rejected"
_VIOLATION_TYPE = f"array<struct<{ERROR_DDL.replace(' bigint', ':bigint').replace(' string', ':string')}>>"


def validate(
    df: DataFrame,
    contract: Contract,
    row_number: Column | None = None,
    unique_keys: bool = True,
    rules_when: Column | None = None,
    op: str | None = None,
) -> DataFrame:
    """Casts the contract's columns to their types and adds ``_rejected`` and ``_violations``.

    ``row_number`` names the row in its violations: an audit id or sequence where
    the source has one, else the scan position. ``rules_when`` limits the rules of
    non-key columns, for example to events that carry values. Other columns pass
    through unchanged. ``op`` names an operation code that must be one of ``OPERATIONS``.
    Violations are built for rejected rows only.
    """
    number = (F.monotonically_increasing_id() + 1) if row_number is None else row_number
    missing = [c for c in contract.columns if c not in df.columns]
    if missing:
        raise ValueError(f"source lacks contract columns: {', '.join(missing)}")
    rows = df.withColumn("_row_number", number.cast("bigint"))
    types = dict(df.dtypes)
    rules: list[_Rule] = []
    for field in contract.fields:
        scope = None if field.name in contract.keys else rules_when
        rules += _field_rules(field, types[field.name], field.name in contract.keys, scope)
    if unique_keys:
        # Keys are compared as typed: the texts "1" and "01" are one bigint.
        typed = {f"_key_{f.name}": _typed(f, types[f.name]) for f in contract.fields if f.name in contract.keys}
        rows = rows.withColumns(typed)
        keys = df.select(*[value.alias(name) for name, value in typed.items()])
        rows = keyed_join(rows, duplicate_keys(keys), list(typed), "left")
        copies = F.col("_copies")
        rules.append(
            _Rule(
                copies.isNotNull(),
                "$",
                "duplicate_key",
                "key occurs more than once",
                "unique=" + ",".join(contract.keys),
                copies.cast("string"),
            )
        )
    if op is not None:
        unknown = ~F.coalesce(F.col(op).isin(*OPERATIONS), F.lit(False))
        rules.append(
            _Rule(
                unknown, op, "operation", "operation is not known", f"allowed={','.join(OPERATIONS)}", F.col(op)
            )
        )
    rejected = F.lit(False)
    for rule in rules:
        rejected = rejected | F.coalesce(rule.broken, F.lit(False))
    found = F.array_compact(F.array(*[rule.violation() for rule in rules]))
    none = F.array().cast(_VIOLATION_TYPE)
    kept = [c for c in df.columns if c not in contract.columns]
    return rows.select(
        *[_typed(f, types[f.name]).alias(f.name) for f in contract.fields],
        *kept,
        "_row_number",
        rejected.alias(REJECTED),
        F.when(rejected, found).otherwise(none).alias(VIOLATIONS),
    )


def duplicate_keys(keys: DataFrame) -> DataFrame:
    """Keys that occur more than once, with their count, written to the shared folder.

    Copies are counted before the shuffle, so a key holding a third of the rows
    costs one partial count per task.
    """
    counted = keys.dropna("any").groupBy(*keys.columns).agg(F.count("*").alias("_copies"))
    return staged(counted.filter("_copies > 1"), "duplicate-keys")


@dataclass(frozen=True)
class _Rule:
    broken: Column
    field: str
    code: str
    message: str
    constraint: str
    actual: Column

    def violation(self) -> Column:
        return F.when(
            self.broken,
            F.struct(
                F.col("_row_number").alias("row_number"),
                F.lit(self.field).alias("field"),
                F.lit(self.code).alias("code"),
                F.lit(self.message).alias("message"),
                F.lit(self.constraint).alias("constraint"),
                self.actual.alias("actual_value"),
            ),
        )


def _typed(rule: FieldRule, source_type: str) -> Column:
    raw = F.col(f"`{rule.name}`")
    return raw if source_type == rule.type else raw.try_cast(rule.type)


def _field_rules(rule: FieldRule, source_type: str, is_key: bool, scope: Column | None) -> list[_Rule]:
    raw = F.col(f"`{rule.name}`")
    value = _typed(rule, source_type)
    text = raw.cast("string")
    checks: list[tuple[Column, str, str, str]] = []
    if source_type != rule.type:
        unread = raw.isNotNull() & value.isNull()
        checks.append((unread, "type", f"value is not a {rule.type}", f"type={rule.type}"))
    if is_key:
        checks.append((raw.isNull(), "null_key", "key is missing", "key"))
    elif not rule.nullable:
        checks.append((raw.isNull(), "not_null", "value is missing", "not_null"))
    if rule.minimum is not None:
        checks.append((value < F.lit(rule.minimum), "range", "value is too small", f"min={rule.minimum}"))
    if rule.maximum is not None:
        checks.append((value > F.lit(rule.maximum), "range", "value is too large", f"max={rule.maximum}"))
    if rule.min_length is not None:
        short = F.char_length(text) < rule.min_length
        checks.append((short, "length", "text is too short", f"min_length={rule.min_length}"))
    if rule.max_length is not None:
        long = F.char_length(text) > rule.max_length
        checks.append((long, "length", "text is too long", f"max_length={rule.max_length}"))
    if rule.pattern is not None:
        checks.append((~text.rlike(rule.pattern), "pattern", "text does not match", f"pattern={rule.pattern}"))
    if rule.allowed is not None:
        listed = ",".join(str(a) for a in rule.allowed)
        checks.append((~value.isin(*rule.allowed), "allowed", "value is not allowed", f"allowed={listed}"))
    if scope is not None:
        checks = [(scope & broken, *rest) for broken, *rest in checks]
    return [_Rule(broken, rule.name, code, message, bound, text) for broken, code, message, bound in checks]


def split_accepted(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Accepted and rejected halves of a validated frame."""
    return df.filter(~F.col(REJECTED)), df.filter(REJECTED)


def explode_errors(df: DataFrame, *keep: str) -> DataFrame:
    """One row per violation."""
    # A rejected row has a violation, so the outer form adds no rows. It also spares
    # the size check that the plain form would evaluate the whole array for.
    return df.filter(REJECTED).select(*keep, F.inline_outer(VIOLATIONS))


def validation_counts(df: DataFrame, unit: str = "row") -> DataFrame:
    """Source, invalid and accepted counts in one pass; ``unit`` is ``row`` or ``event``."""
    if unit not in ("row", "event"):
        raise ValueError("unit must be one of: row, event")
    invalid = F.col(REJECTED)
    return df.agg(
        F.count("*").alias(f"source_{unit}_count"),
        F.count_if(invalid).alias(f"invalid_{unit}_count"),
        F.count_if(~invalid).alias(f"accepted_{unit}_count"),
        F.coalesce(F.sum(F.size(VIOLATIONS)), F.lit(0)).cast("bigint").alias("error_count"),
    )


def quarantine_transactions(events: DataFrame, invalid: Column, xid: str = "xid") -> DataFrame:
    """Adds ``_quarantined``: true for every event of a transaction with an invalid event.

    The ids of bad transactions are few next to the events. They are gathered once
    and joined back, so a transaction of any size stays spread over the tasks that
    read it.
    """
    bad = staged(
        events.filter(invalid).select(xid).dropna().distinct().withColumn("_bad", F.lit(True)),
        "bad-transactions",
    )
    marked = keyed_join(events, bad, [xid], "left")
    return marked.withColumn(
        "_quarantined", F.coalesce(F.col("_bad"), F.coalesce(invalid, F.lit(False)) & F.col(xid).isNull())
    ).drop("_bad")


def quarantine_counts(marked: DataFrame, invalid: Column, xid: str = "xid") -> DataFrame:
    """The four quarantine counts. Rows collapse to one per transaction before the
    distinct count, so no transaction is gathered whole."""
    per_xid = marked.groupBy(xid).agg(
        F.count_if(invalid).alias("bad"), F.count_if(F.col("_quarantined")).alias("held")
    )

    def transactions(count: str) -> Column:
        # Without an id, every event is a transaction of its own.
        known = F.when(F.col(xid).isNull(), F.col(count)).otherwise((F.col(count) > 0).cast("bigint"))
        return F.coalesce(F.sum(known), F.lit(0)).cast("bigint")

    return per_xid.agg(
        F.coalesce(F.sum("bad"), F.lit(0)).cast("bigint").alias("invalid_event_count"),
        transactions("bad").alias("invalid_transaction_count"),
        F.coalesce(F.sum("held"), F.lit(0)).cast("bigint").alias("quarantined_event_count"),
        transactions("held").alias("quarantined_transaction_count"),
    )


def number_rows(df: DataFrame, order_by: list[str], partitions: int | None = None) -> DataFrame:
    """Adds ``_row_number``, consecutive from 1 in the given order, without gathering rows.

    ``order_by`` must order the rows totally, best by a key. Rows are range-partitioned and staged once; each part is numbered on its own
    and shifted by the size of the parts before it. The only single-task step is a
    running sum over one row per part.
    """
    spark = df.sparkSession
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    low_bits = F.lit((1 << 33) - 1)
    local = (
        df.repartitionByRange(parts, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_id", F.monotonically_increasing_id())
        .select(
            "*",
            F.shiftright("_id", 33).alias("_part"),
            (F.col("_id").bitwiseAND(low_bits) + 1).alias("_place"),
        )
        .drop("_id")
    )
    fixed = staged(local, "numbered")
    sizes = fixed.groupBy("_part").agg(F.count("*").alias("n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_offset"))
    # One row per part, so the broadcast side is bounded by the partition count.
    return (
        fixed.join(F.broadcast(offsets), "_part")
        .withColumn("_row_number", F.col("_offset") + F.col("_place"))
        .drop("_part", "_place", "_offset")
    )


# The members under which a failed stage publishes each field.
PUBLISHED = {
    "error_object_key": ("validation_error_object_key", "error_object_key"),
    "manifest_key": ("validation_manifest_key", "manifest_key"),
    "accepted_object_key": ("accepted_object_key",),
    "delta_object_key": ("delta_object_key",),
    "invalid_row_count": ("invalid_row_count",),
    "invalid_event_count": ("invalid_event_count",),
    "invalid_transaction_count": ("invalid_transaction_count",),
    "quarantined_event_count": ("quarantined_event_count",),
    "quarantined_transaction_count": ("quarantined_transaction_count",),
}


@dataclass
class ValidationFailed(Exception):
    """Raised by the gate after everything has landed; carries keys and counts."""

    message: str
    error_object_key: str | None = None
    manifest_key: str | None = None
    accepted_object_key: str | None = None
    delta_object_key: str | None = None
    invalid_row_count: int | None = None
    invalid_event_count: int | None = None
    invalid_transaction_count: int | None = None
    quarantined_event_count: int | None = None
    quarantined_transaction_count: int | None = None

    def __str__(self) -> str:
        return self.message

    def context(self) -> dict[str, object]:
        """What a failed stage publishes: every known field under its published names."""
        return {
            name: value
            for own, names in PUBLISHED.items()
            for name in names
            if (value := getattr(self, own)) not in (None, "")
        }


def validation_gate(invalid_count: int, policy: str = "quarantine", **context: object) -> None:
    """Lets a stage pass with rejected data, or fails it, once all has landed."""
    if policy not in ("fail", "quarantine"):
        raise ValueError("policy must be one of: fail, quarantine")
    if policy == "fail" and invalid_count > 0:
        raise ValidationFailed(f"{invalid_count} records break the contract", **context)


def gate_decisions(counts: DataFrame, invalid: str, policy: str = "policy") -> DataFrame:
    """The gate over many stages at once: adds ``passed``."""
    return counts.withColumn(
        "passed", ~((F.col(policy) == "fail") & (F.coalesce(F.col(invalid), F.lit(0)) > 0))
    )
