"""State per key that outlives a batch: counts that start from given ones, sessions that expire.

Both run as stateful processors over a RocksDB store, so state is not held on the heap. Rows are
combined within each Arrow batch before they are shuffled: a processor receives a few rows per
key, also where one key has most of the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

SPAN_SCHEMA = "session_id STRING, first_ms BIGINT, last_ms BIGINT, n BIGINT"
SESSION_SCHEMA = "session_id STRING, first_ms BIGINT, last_ms BIGINT, num_events BIGINT, expired BOOLEAN"
_MERGE_AT = 1_000  # spans of a key that are held before they are merged


class _Counts(StatefulProcessor):
    """Running count of a key; the initial count is taken over once, in the first batch."""

    def init(self, handle):
        self._n = handle.getValueState("n", "n BIGINT")

    def _add(self, more: int) -> int:
        total = (self._n.get()[0] if self._n.exists() else 0) + more
        self._n.update((total,))
        return total

    def handleInitialState(self, key, initialState, timerValues):
        self._add(initialState["n"])

    def handleInputRows(self, key, rows, timerValues):
        total = self._add(sum(r["n"] for r in rows))
        yield Row(key=key[0], n=total)

    def close(self):
        pass


def counts_from(df: DataFrame, key: str, initial: DataFrame) -> DataFrame:
    """Stream ``(key, n)`` of running counts on top of the initial ``(key, n)``, in update mode.

    Each batch gives one row for every key it contains. The initial counts become the state of the
    first batch; a restart takes the state from the checkpoint instead.
    """
    kind = df.schema[key].dataType.simpleString()

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by("key").aggregate([([], "count_all")])
            yield from found.select(["key", "count_all"]).rename_columns(["key", "n"]).to_batches()

    partial = df.select(F.col(key).alias("key")).mapInArrow(combine, f"key {kind}, n BIGINT")
    start = initial.select(F.col(key).cast(kind).alias("key"), F.col("n").cast("bigint").alias("n"))
    counted = partial.groupBy("key").transformWithState(
        _Counts(), f"key {kind}, n BIGINT", "Update", "None", start.groupBy("key")
    )
    return counted.select(F.col("key").alias(key), "n")


def merged(spans: list[tuple[int, int, int]], gap_ms: int) -> list[tuple[int, int, int]]:
    """Spans (first, last, n) in order, those at most ``gap_ms`` apart made one."""
    out: list[tuple[int, int, int]] = []
    for first, last, n in sorted(spans):
        if out and first - out[-1][1] <= gap_ms:
            start, end, count = out[-1]
            out[-1] = start, max(end, last), count + n
        else:
            out.append((first, last, n))
    return out


class _Sessions(StatefulProcessor):
    """Open sessions of a key, and one event-time timer where the first of them ends."""

    def __init__(self, gap_ms: int):
        self._gap_ms = gap_ms

    def init(self, handle):
        self._handle = handle
        self._open = handle.getListState("open", "first BIGINT, last BIGINT, n BIGINT")

    def _held(self) -> list[tuple[int, int, int]]:
        return [tuple(s) for s in self._open.get()] if self._open.exists() else []

    def _end(self, spans) -> int | None:
        """End of the first of these sessions, which the timer waits for."""
        return min((last for _, last, _ in spans), default=None)

    def _settle(self, key, spans: list[tuple[int, int, int]], now: int, before: set, set_at: int | None) -> Iterator[Row]:
        """Rows of sessions that changed or ended; the others stay. ``set_at``: end the timer is set to."""
        still = [s for s in spans if s[1] + self._gap_ms >= now]
        if still:
            self._open.put(still)
        else:
            self._open.clear()
        end = self._end(still)
        if end != set_at:
            if set_at is not None:
                self._handle.deleteTimer(set_at + self._gap_ms + 1)
            if end is not None:
                self._handle.registerTimer(end + self._gap_ms + 1)
        for span in spans:
            ended = span[1] + self._gap_ms < now
            if ended or span not in before:
                first, last, n = span
                yield Row(session_id=key[0], first_ms=first, last_ms=last, num_events=n, expired=ended)

    def handleInputRows(self, key, rows, timerValues):
        spans = self._held()
        before = set(spans)
        for r in rows:
            spans.append((r["first_ms"], r["last_ms"], r["n"]))
            if len(spans) % _MERGE_AT == 0:
                spans = merged(spans, self._gap_ms)
        now = timerValues.getCurrentWatermarkInMs()
        yield from self._settle(key, merged(spans, self._gap_ms), now, before, self._end(before))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        spans = self._held()
        yield from self._settle(key, spans, timerValues.getCurrentWatermarkInMs(), set(spans), None)

    def close(self):
        pass


def _spans(gap_ms: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            batch = batch.take(pc.sort_indices(batch, [("session_id", "ascending"), ("at_ms", "ascending")]))
            ids, at = batch.column("session_id"), batch.column("at_ms").to_numpy()
            code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
            opens = np.concatenate(([True], (np.diff(code) != 0) | (np.diff(at) > gap_ms)))
            first = np.flatnonzero(opens)
            end = np.append(first[1:], len(at))
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(first)), *map(pa.array, (at[first], at[end - 1], end - first))],
                names=["session_id", "first_ms", "last_ms", "n"],
            )

    return run


def expiring_sessions(events: DataFrame, session: str, time: str, gap_ms: int, watermark: str) -> DataFrame:
    """Sessions of events at most ``gap_ms`` apart, in update mode: open ones, then closed ones.

    A session gives a row when a batch adds to it, and a last one with ``expired`` set once the
    watermark has passed its end by more than the gap; its state then goes. Events may come out of
    order: one that lies between two sessions makes them one, named by the earlier beginning.
    Events later than that open (and close) a session of their own. Events without a time are
    left out; a null session is a session.
    """
    timed = events.withWatermark(time, watermark)
    at_ms = F.unix_millis(F.col(time)).alias("at_ms")
    keyed = timed.select(F.col(session).cast("string").alias("session_id"), at_ms).where("at_ms IS NOT NULL")
    return (
        keyed.mapInArrow(_spans(gap_ms), SPAN_SCHEMA)
        .groupBy("session_id")
        .transformWithState(_Sessions(gap_ms), SESSION_SCHEMA, "Update", "EventTime")
    )
