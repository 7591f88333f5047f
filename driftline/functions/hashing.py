"""Row fingerprints that tell any two different rows apart.

Two traps are closed here. Hash functions skip NULL arguments, so ``(NULL, 1)`` and
``(1, NULL)`` collide: a bit mask of the NULL positions is hashed along. Joining
values with a separator is ambiguous: the text form prefixes each value with its
length instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

METHODS = ("xxh128", "sha256")
_MASK_BITS = 60


def _normal(df: DataFrame, name: str) -> Column:
    """Value form in which equal values have equal bytes."""
    kind = df.schema[name].dataType
    col = F.col(f"`{name}`")
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return col + F.lit(0.0).cast(kind)
    if isinstance(kind, T.MapType):
        return F.to_json(F.array_sort(F.map_entries(col)), {"ignoreNullFields": "false"})
    if isinstance(kind, (T.StructType, T.ArrayType)):
        return F.to_json(col, {"ignoreNullFields": "false"})
    return col


def _text(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    value = _normal(df, name)
    if isinstance(kind, T.TimestampType):
        value = F.unix_micros(value)
    return value.cast("string")


def row_hash(df: DataFrame, columns: list[str], method: str = "xxh128") -> Column:
    """Fingerprint of ``columns``; compare for equality only.

    ``xxh128`` is a pair of 64-bit hashes and stays in generated code; ``sha256`` is
    the collision-resistant text form, about ten times slower.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of: {', '.join(METHODS)}")
    if not columns:
        raise ValueError("row_hash needs at least one column")
    if method == "sha256":
        parts = []
        for name in columns:
            text = _text(df, name)
            framed = F.concat(F.char_length(text).cast("string"), F.lit(":"), text)
            parts.append(F.when(text.isNull(), F.lit("~")).otherwise(framed))
        return F.sha2(F.concat(*parts), 256)
    masks = []
    for start in range(0, len(columns), _MASK_BITS):
        mask = F.lit(0).cast("bigint")
        for bit, name in enumerate(columns[start : start + _MASK_BITS]):
            is_null = F.col(f"`{name}`").isNull()
            mask = mask + F.when(is_null, F.lit(1 << bit)).otherwise(F.lit(0)).cast("bigint")
        masks.append(mask)
    values = [_normal(df, name) for name in columns]
    return F.struct(
        F.xxhash64(F.lit(1), *masks, *values).alias("a"),
        F.xxhash64(F.lit(2), *masks, *values).alias("b"),
    )
