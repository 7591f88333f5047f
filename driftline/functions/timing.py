"""Durations between timestamps of either kind (with or without a zone)."""

from __future__ import annotations

from pyspark.sql import Column


def seconds_between(start: Column, end: Column) -> Column:
    """Seconds from start to end as a double; NULL when either side is NULL.

    Times without a zone are subtracted as they stand, whatever the session zone.
    """
    span = (end - start).cast("interval second")
    return span.cast("decimal(20,6)").cast("double")
