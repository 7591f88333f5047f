"""Change deltas: watermark windows, compaction, key changes and applying them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftline.operators.diff import META

# The watermark modes.
WATERMARK_MODES = ("auto", "commit_timestamp", "recorded_at")

WATERMARK = "_watermark"
SUB_ORDER = "_sub"
POSITION = "_position"
#: Where an event stands among all events of a table: clock or log position, id or sequence, half of a key change.
POSITION_TYPE = "struct<major:bigint,minor:bigint,sub:int>"


def position(major: Column, minor: Column, sub: Column | int = 0) -> Column:
    """The full order of an event in one comparable value."""
    sub = F.lit(sub) if isinstance(sub, int) else sub
    return F.struct(major.cast("bigint").alias("major"), minor.cast("bigint").alias("minor"), sub.cast("int").alias("sub"))


def clock_micros(clock: Column, kind: str) -> Column:
    """Microseconds of a clock, the same in any session zone; a zoneless clock counts as UTC."""
    if kind == "timestamp":
        return F.unix_micros(clock)
    return F.unix_micros(F.concat(clock.cast("string"), F.lit("Z")).cast("timestamp"))


def _check_mode(mode: str) -> None:
    if mode not in WATERMARK_MODES:
        raise ValueError(f"watermark_mode must be one of: {', '.join(sorted(WATERMARK_MODES))}")


def resolve_watermark_mode(events: DataFrame, mode: str, stored: str | None = None) -> str:
    """The clock a run uses. ``auto`` takes the commit time if every row of the window
    has one. A clock other than the ``stored`` one is refused, because the two clocks'
    watermarks cannot be compared."""
    _check_mode(mode)
    if mode == "auto" and stored is not None:
        mode = stored
    if mode == "auto":
        unknown = events.filter(F.col("commit_timestamp").isNull()).limit(1).count()
        mode = "recorded_at" if unknown else "commit_timestamp"
    if stored is not None and mode != stored:
        raise ValueError(f"watermark_mode changed from {stored} to {mode}; start a new checkpoint instead")
    # A row without the run's clock lies in no window, and would be passed over for ever.
    without = events.filter(F.col(mode).isNull()).count()
    if without:
        raise ValueError(f"{without} events have no {mode}; mend them or choose another watermark_mode")
    return mode


def watermark_column(events: DataFrame, mode: str = "auto") -> DataFrame:
    """Adds ``_watermark``: the commit time, the recorded time, or for ``auto`` the
    commit time if present in every row of the frame, else the recorded time."""
    _check_mode(mode)
    if mode != "auto":
        return events.withColumn(WATERMARK, F.col(mode))
    complete = events.agg(F.count_if(F.col("commit_timestamp").isNull()) == 0).scalar()
    return events.withColumn(
        WATERMARK, F.when(complete, F.col("commit_timestamp")).otherwise(F.col("recorded_at"))
    )


def extract_delta(
    events: DataFrame,
    start: tuple[object, object] | None = None,
    end: tuple[object, object] | None = None,
    watermark: str = WATERMARK,
    tie_break: str = "audit_id",
    overlap: Column | None = None,
) -> DataFrame:
    """Rows after ``start`` up to and including ``end``, both (watermark, id) pairs.

    The id orders rows of equal watermark, so none is lost or read twice. A plain
    bound on the watermark stands beside the pair comparison and is what a source
    can push down. ``overlap`` re-reads that much before the start, for rows that
    became visible late; pair it with the position guard of ``apply_delta``.
    """
    clock, ident = F.col(watermark), F.col(tie_break)
    rows = events
    if start is not None and overlap is not None:
        rows = rows.filter(clock > F.lit(start[0]) - overlap)
    elif start is not None:
        at, last = F.lit(start[0]), F.lit(start[1])
        rows = rows.filter(clock >= at).filter((clock > at) | (ident > last))
    if end is not None:
        at, last = F.lit(end[0]), F.lit(end[1])
        rows = rows.filter(clock <= at).filter((clock < at) | (ident <= last))
    return rows


def window_bounds(
    delta: DataFrame, watermark: str = WATERMARK, tie_break: str = "audit_id"
) -> DataFrame:
    """First and last (watermark, id) of a delta; all NULL for an empty one."""
    pair = F.when(F.col(watermark).isNotNull(), F.struct(F.col(watermark).alias("w"), F.col(tie_break).alias("i")))
    return delta.agg(F.min(pair).alias("lo"), F.max(pair).alias("hi")).select(
        F.col("lo.w").alias("window_start"),
        F.col("lo.i").alias("window_start_id"),
        F.col("hi.w").alias("window_end"),
        F.col("hi.i").alias("window_end_id"),
    )


def expand_key_changes(
    events: DataFrame, keys: list[str], old_keys: list[str], op: str = "op"
) -> DataFrame:
    """Splits an update that moved its key into a delete of the old key and the event
    itself, ordered by ``_sub``. ``old_keys`` hold the key before the update."""
    moved = F.lit(False)
    present = F.lit(True)
    for key, old in zip(keys, old_keys, strict=True):
        present = present & F.col(old).isNotNull()
        moved = moved | (F.col(old) != F.col(key))
    both = F.array(F.lit(0), F.lit(1))
    halves = F.when(present & F.coalesce(moved, F.lit(False)), both).otherwise(F.array(F.lit(1)))
    rows = events.withColumn(SUB_ORDER, F.explode(halves))
    first = F.col(SUB_ORDER) == 0
    columns = []
    for name in events.columns:
        col = F.col(f"`{name}`")
        if name in keys:
            col = F.when(first, F.col(old_keys[keys.index(name)])).otherwise(col)
        elif name == op:
            col = F.when(first, F.lit("D")).otherwise(col)
        columns.append(col.alias(name))
    return rows.select(*columns, SUB_ORDER)


def compact_delta(events: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """Last event of each key. ``order_by`` must order the events of a key totally.

    The maximum combines before the shuffle, so a hot key costs one row per task.
    """
    rest = [c for c in events.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.struct(*order_by))
    return events.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def apply_delta(
    curated: DataFrame,
    delta: DataFrame,
    keys: list[str],
    op: str = "op",
    guard: bool = False,
    columns: list[str] | None = None,
) -> DataFrame:
    """Curated state after a compacted delta: ``I`` and ``U`` upsert, ``D`` removes.

    ``columns`` are those of the result, by default the curated ones; columns that only
    one side has are NULL in rows of the other.

    Curated rows whose key the delta names drop out and the upserts take their
    place; a small delta is broadcast, so the curated table is not shuffled. Deleting
    an absent key does nothing, and applying a delta twice changes nothing. The
    delta is read more than once, so pass a landed or staged one. With ``guard`` an
    event no newer than the row's ``_position`` is ignored.
    """
    if guard:
        delta = newer_events(curated, delta, keys)
    # Codes other than these three change nothing: neither do they remove a row.
    delta = delta.filter(F.col(op).isin("I", "U", "D"))
    kept = curated.join(delta.select(*keys), keys, "left_anti")
    columns = columns or curated.columns
    upserts = delta.filter(F.col(op).isin("I", "U")).select(*[c for c in delta.columns if c in columns])
    return kept.unionByName(upserts, allowMissingColumns=True).select(*columns)


def newer_events(known: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Events of a compacted delta that are newer than what is known of their key.

    ``known`` has the keys and ``_position`` of curated rows and of deleted ones, in any number per key.
    """
    seen = known.select(*keys, F.col(POSITION).alias("_seen"))
    passed = seen.join(delta.select(*keys, POSITION), keys, "inner").filter(F.col("_seen") >= F.col(POSITION))
    return delta.join(passed.select(*keys).distinct(), keys, "left_anti")


def classify_delta(
    curated: DataFrame, delta: DataFrame, keys: list[str], op: str = "op", columns: list[str] | None = None
) -> DataFrame:
    """Effect of each compacted event: ``insert``, ``update``, ``delete``, ``unchanged``
    or ``noop_delete``."""
    columns = _compared(curated, delta, keys, op, columns)
    old = curated.select(*keys, F.struct(*columns).alias("_old"))
    new = delta.select(*keys, op, F.struct(*columns).alias("_new"))
    known = F.col("_old").isNotNull()
    action = (
        F.when((F.col(op) == "D") & known, "delete")
        .when(F.col(op) == "D", "noop_delete")
        .when(~known, "insert")
        .when(F.col("_new").eqNullSafe(F.col("_old")), "unchanged")
        .otherwise("update")
    )
    return new.join(old, keys, "left").select(*keys, action.alias("action"))


def delta_counts(
    curated: DataFrame, delta: DataFrame, keys: list[str], op: str = "op", columns: list[str] | None = None
) -> DataFrame:
    """Counts of applying a compacted delta.

    The delta's own totals and its matches in the curated table are counted apart
    and added up, so the join is an inner one that can broadcast the delta.
    """
    columns = _compared(curated, delta, keys, op, columns)
    zero = F.lit(0).cast("bigint")
    totals = delta.agg(
        F.count("*").alias("events"),
        F.count_if(F.col(op) != "D").alias("upserts"),
        zero.alias("updates"),
        zero.alias("same"),
        zero.alias("deletes"),
    )
    old = curated.select(*keys, F.struct(*columns).alias("_old"))
    new = delta.select(*keys, op, F.struct(*columns).alias("_new"))
    upsert = F.col(op) != "D"
    equal = F.col("_new").eqNullSafe(F.col("_old"))
    matches = old.join(new, keys, "inner").agg(
        zero.alias("events"),
        zero.alias("upserts"),
        F.count_if(upsert & ~equal).alias("updates"),
        F.count_if(upsert & equal).alias("same"),
        F.count_if(~upsert).alias("deletes"),
    )
    summed = totals.unionByName(matches).agg(
        *[F.sum(c).alias(c) for c in ("events", "upserts", "updates", "same", "deletes")]
    )
    return summed.select(
        F.col("events").alias("read_count"),
        (F.col("upserts") - F.col("updates") - F.col("same")).alias("insert_count"),
        F.col("updates").alias("update_count"),
        F.col("deletes").alias("delete_count"),
        F.col("same").alias("unchanged_count"),
        (F.col("events") - F.col("upserts") - F.col("deletes")).alias("noop_delete_count"),
    )


def _compared(
    curated: DataFrame, delta: DataFrame, keys: list[str], op: str, columns: list[str] | None
) -> list[str]:
    if columns is not None:
        return columns
    skipped = {*keys, op, POSITION, *META}
    return [c for c in curated.columns if c in delta.columns and c not in skipped]
