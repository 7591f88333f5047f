"""Column functions shared by the operators."""

from driftline.functions.hashing import row_hash
from driftline.functions.lsn import format_lsn, parse_lsn
from driftline.functions.payload import first_int, member_int, member_text, members, number_or_null, text_or_null
from driftline.functions.timing import seconds_between

__all__ = [
    "first_int",
    "format_lsn",
    "member_int",
    "member_text",
    "members",
    "number_or_null",
    "parse_lsn",
    "row_hash",
    "seconds_between",
    "text_or_null",
]
