"""Repeats in range-partitioned, sorted occurrences.

An occurrence is (high, low, doc, pos): a 128- or 96-bit fingerprint and where
it stands. The rows are range-partitioned and sorted by all four columns, so a
fingerprint that holds a third of all rows spreads over many partitions, and
each partition is read as a stream: memory holds one Arrow batch and the open
run, never a whole group.

A run that ends inside its partition is decided on the spot, and so are most
rows of the runs that touch a partition's border. What is left open there, the
run's head or a run too short to tell, is kept as pending; the fingerprints, at
most two a partition, are summed up afterwards, so the table that is broadcast
has a proven bound. The stream's output is written to the shared folder once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nimbusmart.llm.tables import materialise

KEY = ["high", "low"]
DDL = "high long, low long, doc long, pos long, state int"
SURE, PENDING, RESOLVED = 1, 0, 2
_SCHEMA = pa.schema([*[(c, pa.int64()) for c in ("high", "low", "doc", "pos")], ("state", pa.int32())])


def _block(rows: np.ndarray, state: int) -> pa.RecordBatch:
    """Rows of one state; those that are sure need no fingerprint any more."""
    key = [np.zeros(len(rows), dtype=np.int64)] * 2 if state == SURE else [rows[:, 0], rows[:, 1]]
    arrays = [*key, rows[:, 2], rows[:, 3], np.full(len(rows), state, dtype=np.int32)]
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], schema=_SCHEMA)


def _spared(rows: np.ndarray, head: np.ndarray, spare: str) -> np.ndarray:
    """Rows that stay for being the run's head: its document, or its place."""
    if spare == "doc":
        return rows[:, 2] == head[..., 2]
    if spare == "place":
        return (rows[:, 2] == head[..., 2]) & (rows[:, 3] == head[..., 3])
    return np.zeros(len(rows), dtype=bool)


class _Stream:
    """Decides the runs of one sorted partition.

    The partition's first run may have begun in an earlier one. If it is long
    enough here, its rows come out all the same; only whether its head here is
    the head of the whole run is open, so the head's rows are pending.
    """

    def __init__(self, at_least: int, unit: str, spare: str):
        self.at_least, self.unit, self.spare = at_least, unit, spare
        self.open: np.ndarray | None = None  # undecided rows of the open run
        self.head: np.ndarray | None = None  # head of the open run, once it is decided
        self.first: np.ndarray | None = None  # a row of the partition's first run

    def _units(self, rows: np.ndarray) -> np.ndarray:
        """1 where a row counts as one more document or place than the row before."""
        new = np.ones(len(rows), dtype=np.int64)
        cols = [0, 1, 2] if self.unit == "doc" else [0, 1, 2, 3]
        new[1:] = (rows[1:][:, cols] != rows[:-1][:, cols]).any(axis=1)
        return new

    def _is_first(self, row: np.ndarray) -> bool:
        return bool((row[:2] == self.first[:2]).all())

    def _out(self, rows: np.ndarray, head: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Rows of one decided run."""
        saved = _spared(rows, head, self.spare)
        if not saved.all():
            yield _block(rows[~saved], SURE)
        if saved.any() and self._is_first(head):
            yield _block(rows[saved], PENDING)

    def _close_run(self) -> Iterator[pa.RecordBatch]:
        """The open run ends here; said only where a border is near."""
        if self.head is not None:
            yield _block(self.head[None, :], RESOLVED)
        elif self.open is not None:
            yield _block(self.open, PENDING)
        self.head = self.open = None

    def feed(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        if self.first is None:
            self.first = rows[0].copy()
        if self.head is not None:  # a decided run goes on
            same = (rows[:, :2] == self.head[:2]).all(axis=1)
            n = len(rows) if same.all() else int(np.argmin(same))
            if n:
                yield from self._out(rows[:n], self.head)
                rows = rows[n:]
            if not len(rows):
                return
            if self._is_first(self.head):
                yield from self._close_run()
            self.head = None
        if self.open is not None:
            rows = np.concatenate([self.open, rows])
            self.open = None
        starts = np.concatenate([[0], np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1])
        if len(starts) > 1 and self._is_first(rows[0]):  # the first run ends here
            yield from self._last(rows[: starts[1]])
            yield from self._close_run()
            rows, starts = rows[starts[1] :], starts[1:] - starts[1]
        last = starts[-1]
        if last:  # whole runs inside the partition
            sums = np.concatenate([[0], np.cumsum(self._units(rows[:last]))])
            ends = starts[1:]
            big = (sums[ends] - sums[starts[:-1]]) >= self.at_least
            run = np.repeat(np.arange(len(ends)), ends - starts[:-1])
            part = rows[:last]
            out = part[big[run] & ~_spared(part, part[starts[run]], self.spare)]
            if len(out):
                yield _block(out, SURE)
        yield from self._last(rows[last:])

    def _last(self, rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        """The run that goes on behind these rows, perhaps."""
        if self._units(rows).sum() >= self.at_least:
            self.head = rows[0].copy()
            yield from self._out(rows, self.head)
        else:
            self.open = rows.copy()

    def close(self) -> Iterator[pa.RecordBatch]:
        yield from self._close_run()


def repeats(occurrences: DataFrame, at_least: int, unit: str, spare: str, name: str) -> DataFrame:
    """(doc, pos) of the occurrences whose fingerprint is found in ``at_least``
    different units ("doc" or "place"), without those that ``spare`` saves:
    "doc", the rows of the first document; "place", the first place; "none".
    Order is by doc and pos, ascending. Equal rows count once but all come out.
    """
    order = [*KEY, "doc", "pos"]
    source = occurrences.select(*[F.col(c).cast("long").alias(c) for c in order])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = _Stream(at_least, unit, spare)
        for b in batches:
            if b.num_rows:
                rows = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)], axis=1)
                yield from stream.feed(rows)
        yield from stream.close()

    n = int(source.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = source.repartitionByRange(n, *order).sortWithinPartitions(*order)
    found = materialise(ranged.mapInArrow(run, DDL), name)

    border = found.where(F.col("state") != SURE)
    pending = border.where(F.col("state") == PENDING)
    units = ["doc"] if unit == "doc" else ["doc", "pos"]
    heads = border.groupBy(*KEY).agg(
        F.max("state").alias("most"),
        F.min(F.struct("doc", "pos")).alias("head"),
        F.count_distinct(*[F.when(F.col("state") == PENDING, F.col(c)) for c in units]).alias("n"),
    )
    heads = heads.where((F.col("n") >= at_least) | (F.col("most") == RESOLVED)).select(*KEY, "head")
    late = pending.join(F.broadcast(heads), KEY)
    if spare == "doc":
        late = late.where(F.col("doc") != F.col("head.doc"))
    elif spare == "place":
        late = late.where((F.col("doc") != F.col("head.doc")) | (F.col("pos") != F.col("head.pos")))
    return found.where(F.col("state") == SURE).select("doc", "pos").unionAll(late.select("doc", "pos"))
