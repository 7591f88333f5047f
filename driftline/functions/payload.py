"""Reading metric payloads: JSON objects whose values may be numbers or text.

A payload is parsed once, into a struct of the wanted members. Each member keeps its
JSON type, so text and numbers can be told apart where that matters.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_BLANKS = " \t\n\r\x0b\x0c"


def members(payload: Column, names: tuple[str, ...]) -> Column:
    """The named top-level members of a JSON object as a struct of variants."""
    return F.from_json(payload, ", ".join(f"`{name}` variant" for name in names))


def member_int(member: Column) -> Column:
    """Integer of a member: whole-number text as is, numbers cut toward zero, else NULL."""
    return F.try_variant_get(member, "$", "bigint")


def first_int(parsed: str, *names: str) -> Column:
    """First of the members that reads as an integer; unreadable ones are passed over."""
    return F.coalesce(*[member_int(F.col(f"{parsed}.{name}")) for name in names])


def number_or_null(member: Column) -> Column:
    number = F.try_variant_get(member, "$", "double")
    return F.when(~F.isnan(number), number)


def member_text(member: Column) -> Column:
    """Text of a member: strings as they are, anything else as JSON."""
    return F.try_variant_get(member, "$", "string")


def strip(value: Column) -> Column:
    return F.btrim(value, F.lit(_BLANKS))


def text_or_null(value: Column) -> Column:
    """Trimmed text, with blanks as NULL."""
    return F.nullif(strip(value), F.lit(""))
