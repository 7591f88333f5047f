"""Log positions as text ``X/Y`` (two hexadecimal halves) and as ordered numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_HALF = 4294967296


def parse_lsn(position: Column) -> Column:
    """64-bit number of a text position; NULL when the text is not a position."""
    text = F.trim(position)
    well_formed = text.rlike("^[0-9A-Fa-f]{1,8}/[0-9A-Fa-f]{1,8}$")
    high = F.conv(F.split_part(text, F.lit("/"), F.lit(1)), 16, 10).cast("bigint")
    low = F.conv(F.split_part(text, F.lit("/"), F.lit(2)), 16, 10).cast("bigint")
    return F.when(well_formed, F.shiftleft(high, 32) + low)


def format_lsn(position: Column) -> Column:
    """Text form of a numeric position."""
    number = position.cast("bigint")
    return F.concat(
        F.hex(F.shiftrightunsigned(number, 32)), F.lit("/"), F.hex(number.bitwiseAND(F.lit(_HALF - 1)))
    )


def lsn_text(position: int) -> str:
    return f"{position >> 32:X}/{position & (_HALF - 1):X}"


def lsn_number(position: str) -> int:
    high, low = position.strip().split("/")
    return (int(high, 16) << 32) + int(low, 16)
