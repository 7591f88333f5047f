"""Open transactions of a stream: appended segments, looked up by transaction id.

A micro-batch writes the events of the transactions it leaves open once, as a segment of
its own, ``held/batch=N``. When a later batch ends a transaction, its earlier events are
read from the segments whose range of ids meets the ids that end, and the batch notes
which (transaction, segment) pairs are done with. A segment without open transactions is
removed. Eight segments of one level are folded into one of the next, so an event is
written again at most once per level, however long its transaction stays open.

``state/N.json`` names the live segments after batch N. Batch N reads only what batch N-1
left and overwrites only what it wrote itself, so it can be run again after a failure.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StringType, StructType

from driftline.shared import file_exists, keyed_join, list_names, read_text, remove_path, replace_text, staged

#: Segments of one level that are folded into one of the next.
FAN = 8

GIVEN_UP = "_given_up"


@dataclass(frozen=True)
class Segment:
    """Events of open transactions: where they are, their range of ids, and what is noted about them."""

    name: str
    level: int
    low: Any
    high: Any
    first_lsn: int
    first_batch: int
    open: int
    notes: tuple[str, ...] = ()


@dataclass(frozen=True)
class Closed:
    """Events of the transactions a batch ends, the highest position it read, a position at or
    before the first of any transaction still open, and in how many pieces (pairs of a
    transaction and a segment) those are held."""

    events: DataFrame
    highest: int | None
    first_open: int | None
    pieces: int
    given_up: int


def all_closed(batch: DataFrame) -> Closed:
    """A batch that holds whole transactions only."""
    known = staged(batch.withColumn(GIVEN_UP, F.lit(False)), "stream-batch")
    return Closed(known, known.agg(F.max("lsn")).first()[0], None, 0, 0)


class OpenTransactions:
    """The segments under ``root`` for a stream of events with the given schema.

    With ``patience`` a transaction that has been open for more batches than that is given
    up: its events, and any that follow until it ends, come back marked ``_given_up``.
    """

    def __init__(self, spark: SparkSession, root: str, schema: StructType, commit: str, patience: int | None = None):
        self.spark, self.root, self.commit, self.patience = spark, root, commit, patience
        self.schema = schema
        self.stored = StructType([*schema.fields]).add("_batch", LongType()).add("_segment", StringType())
        self.pairs = StructType([schema["xid"]]).add("_segment", StringType())

    def advance(self, batch: DataFrame, batch_id: int) -> Closed:
        """Takes in a micro-batch; returns what it ends. Events without an id are returned at once."""
        state = self._state(batch_id - 1)
        for name in state["dropped"]:
            remove_path(self.spark, f"{self.root}/{name}")
        segments = [Segment(**{**s, "notes": tuple(s["notes"])}) for s in state["segments"]]
        known = staged(batch.select(*self.schema.names), "stream-batch")
        alone, grouped = known.filter("xid IS NULL"), known.filter("xid IS NOT NULL")
        ended, given_up, lost = self._ended(grouped, segments, state["given_up"], batch_id)
        dropped = [state["given_up"]] if state["given_up"] and state["given_up"] != given_up else []

        closing = self._closing(segments, ended, f"notes/batch={batch_id}")
        if closing is not None:
            segments, closing_rows = closing
        if self.patience is not None:
            segments = [replace(s, first_batch=max(s.first_batch, batch_id - self.patience + 1)) for s in segments]
        fresh = keyed_join(grouped, ended, ["xid"], "left_anti").withColumn("_batch", F.lit(batch_id).cast("bigint"))
        segments += self._written(fresh, f"held/batch={batch_id}", 0)
        segments = self._folded(segments, batch_id)

        live = [s for s in segments if s.open > 0]
        before = {s["name"] for s in state["segments"]} | {n for s in state["segments"] for n in s["notes"]}
        before |= {s.name for s in segments} | {n for s in segments for n in s.notes}
        kept = {s.name for s in live} | {n for s in live for n in s.notes}
        dropped += sorted(before - kept)
        after = {"segments": [asdict(s) for s in live], "dropped": dropped, "given_up": given_up}
        replace_text(self.spark, f"{self.root}/state/{batch_id}.json", json.dumps(after))
        remove_path(self.spark, f"{self.root}/state/{batch_id - 2}.json")

        events = keyed_join(grouped, ended, ["xid"], "inner")
        if closing is not None:
            events = events.unionByName(closing_rows.select(*events.columns))
        events = events.unionByName(alone.withColumn(GIVEN_UP, F.lit(False)))
        first = min((s.first_lsn for s in live), default=None)
        highest = known.agg(F.max("lsn")).first()[0]
        return Closed(events, highest, first, sum(s.open for s in live), lost)

    def _state(self, batch_id: int) -> dict[str, Any]:
        path = f"{self.root}/state/{batch_id}.json"
        if file_exists(self.spark, path):
            return json.loads(read_text(self.spark, path))
        if batch_id >= 0 and list_names(self.spark, f"{self.root}/held"):
            raise FileNotFoundError(f"{path}: open transactions of earlier batches cannot be told without it")
        return {"segments": [], "dropped": [], "given_up": None}

    def _open_rows(self, segments: list[Segment]) -> DataFrame:
        """Events of transactions that are still open in the segments."""
        rows = self.spark.read.schema(self.stored).parquet(*[f"{self.root}/{s.name}" for s in segments])
        notes = sorted({n for s in segments for n in s.notes})
        if not notes:
            return rows
        done = self.spark.read.schema(self.pairs).parquet(*[f"{self.root}/{n}" for n in notes])
        return keyed_join(rows, done, ["xid", "_segment"], "left_anti")

    def _ended(
        self, grouped: DataFrame, segments: list[Segment], known: str | None, batch_id: int
    ) -> tuple[DataFrame, str | None, int]:
        """Ids of the transactions that this batch is done with, and whether each was given up."""
        commits = grouped.filter(F.col(self.commit)).select("xid").distinct()
        if self.patience is None:
            return staged(commits.withColumn(GIVEN_UP, F.lit(False)), "stream-ended"), None, 0
        commits = staged(commits, "stream-commits")
        ids = StructType([self.schema["xid"]])
        lost = self.spark.createDataFrame([], ids)
        late = [s for s in segments if s.first_batch <= batch_id - self.patience]
        if late:
            overdue = self._open_rows(late).filter(F.col("_batch") <= batch_id - self.patience)
            lost = keyed_join(overdue.select("xid").distinct(), commits, ["xid"], "left_anti")
        lost = staged(lost, "stream-overdue")
        count = lost.count()
        before = self.spark.read.schema(ids).parquet(f"{self.root}/{known}") if known else None
        marked = commits.withColumn(GIVEN_UP, F.lit(False)).unionByName(lost.withColumn(GIVEN_UP, F.lit(True)))
        if before is not None:
            back = keyed_join(grouped.select("xid").distinct(), before, ["xid"], "left_semi")
            marked = marked.unionByName(back.withColumn(GIVEN_UP, F.lit(True)))
        ended = staged(marked.groupBy("xid").agg(F.max(GIVEN_UP).alias(GIVEN_UP)), "stream-ended")
        if before is None and not count:
            return ended, None, 0
        after = lost if before is None else lost.unionByName(keyed_join(before, commits, ["xid"], "left_anti")).distinct()
        name = f"given_up/batch={batch_id}"
        after.write.mode("overwrite").parquet(f"{self.root}/{name}")
        return ended, name, count

    def _closing(
        self, segments: list[Segment], ended: DataFrame, notes: str
    ) -> tuple[list[Segment], DataFrame] | None:
        """Earlier events of the transactions that end, and the segments with them noted."""
        low, high = ended.agg(F.min("xid"), F.max("xid")).first()
        hit = [s for s in segments if low is not None and s.low <= high and s.high >= low]
        if not hit:
            return None
        near = self._open_rows(hit).filter(F.col("xid").between(low, high))
        rows = staged(keyed_join(near, ended, ["xid"], "inner"), "stream-closing")
        rows.select("xid", "_segment").distinct().write.mode("overwrite").parquet(f"{self.root}/{notes}")
        done = self.spark.read.schema(self.pairs).parquet(f"{self.root}/{notes}")
        # One small row per live segment.
        gone = {r["_segment"]: r["count"] for r in done.groupBy("_segment").count().collect()}
        noted = [
            replace(s, open=s.open - gone[s.name], notes=(*s.notes, notes)) if s.name in gone else s for s in segments
        ]
        return noted, rows

    def _written(self, rows: DataFrame, name: str, level: int) -> list[Segment]:
        path = f"{self.root}/{name}"
        rows.withColumn("_segment", F.lit(name)).select(*self.stored.names).write.mode("overwrite").parquet(path)
        found = self.spark.read.schema(self.stored).parquet(path).agg(
            F.min("xid"), F.max("xid"), F.min("lsn"), F.min("_batch"), F.count_distinct("xid")
        ).first()
        return [Segment(name, level, *found)]

    def _folded(self, segments: list[Segment], batch_id: int) -> list[Segment]:
        """Segments after eight of one level, where there are so many, became one of the next."""
        level = 0
        while level <= max((s.level for s in segments), default=-1):
            same = [s for s in segments if s.level == level and s.open > 0]
            if len(same) >= FAN:
                whole = self._written(self._open_rows(same), f"held/fold={batch_id}-{level + 1}", level + 1)
                segments = [replace(s, open=0) if s in same else s for s in segments] + whole
            level += 1
        return segments
