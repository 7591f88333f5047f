"""Open transactions of a stream against a plain bookkeeping of the same batches."""

import random

import pytest
from pyspark.sql.types import StructType

from driftline.shared import list_names, stored_bytes
from driftline.streaming import open_transactions
from driftline.streaming.open_transactions import GIVEN_UP, OpenTransactions

SCHEMA = StructType().add("lsn", "long").add("xid", "long").add("seq", "long").add("tx_end", "boolean")


class Book:
    """What each batch returns: rows of ended transactions, and whether they were given up."""

    def __init__(self, patience):
        self.open, self.lost, self.patience = {}, set(), patience

    def advance(self, rows, number):
        commits = {x for _, x, _, end in rows if end and x is not None}
        out = [(seq, False) for _, x, seq, _ in rows if x is None]
        for _, x, seq, _ in rows:
            if x is not None:
                self.open.setdefault(x, []).append((number, seq))
        overdue = set()
        if self.patience is not None:
            overdue = {x for x, held in self.open.items() if x not in commits and held[0][0] <= number - self.patience}
        for x in list(self.open):
            if x in commits or x in overdue or x in self.lost:
                out += [(seq, x in overdue or x in self.lost) for _, seq in self.open.pop(x)]
        self.lost = (self.lost | overdue) - commits
        return sorted(out)


def batches_of(count, seed):
    """Transactions of one to three batches, some without an end, ids that come back, rows without an id."""
    dice, seq, out, running = random.Random(seed), 0, [], {}
    for number in range(count):
        rows = []
        running.update({number * 2 + i: dice.choice([0, 1, 2, 99]) for i in range(2)})
        if number == 7:
            running[1] = 1
        for x in list(running):
            ends = running[x] == 0
            rows.append((seq * 8, x, seq, ends))
            seq += 1
            running[x] -= 1
            # Every other transaction without an end falls silent.
            if ends or (running[x] > 50 and x % 2):
                del running[x]
        rows.append((seq * 8, None, seq, None))
        seq += 1
        out.append([] if number == 4 else rows)
    return out


@pytest.mark.parametrize("patience", [None, 3])
def test_segments_return_what_a_plain_bookkeeping_does(spark, tmp_path, monkeypatch, patience):
    monkeypatch.setattr(open_transactions, "FAN", 3)
    held = OpenTransactions(spark, str(tmp_path), SCHEMA, "tx_end", patience)
    book, seen = Book(patience), []
    for number, rows in enumerate(batches_of(11, 3)):
        batch = spark.createDataFrame(rows, SCHEMA).coalesce(1)
        for _ in range(2 if number == 5 else 1):
            closed = held.advance(batch, number)
        assert sorted((r["seq"], r[GIVEN_UP]) for r in closed.events.collect()) == book.advance(rows, number)
        waiting = [seq * 8 for rows_of in book.open.values() for _, seq in rows_of]
        assert (closed.pieces > 0) == bool(waiting)
        assert not waiting or closed.first_open <= min(waiting)
        seen.append(stored_bytes(spark, f"{tmp_path}/held/batch={number}"))
    # A batch writes its own open events only, however many are open; of the state two files stay.
    assert max(seen) < 3 * sorted(seen)[len(seen) // 2]
    assert len([n for n in list_names(spark, f"{tmp_path}/state") if n.endswith(".json")]) == 2


def test_a_stream_without_its_state_is_refused(spark, tmp_path):
    held = OpenTransactions(spark, str(tmp_path), SCHEMA, "tx_end")
    held.advance(spark.createDataFrame([(8, 1, 1, False)], SCHEMA), 0)
    with pytest.raises(FileNotFoundError):
        held.advance(spark.createDataFrame([(16, 1, 2, True)], SCHEMA), 5)
