"""Sessions over streams."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

UPDATE_SCHEMA = "session_id STRING, duration_ms BIGINT, num_events BIGINT, expired BOOLEAN"
_STATE_SCHEMA = "num_events BIGINT, start_ms BIGINT, end_ms BIGINT"
_PARTIAL_SCHEMA = "session_id STRING, n BIGINT, first_ms BIGINT, last_ms BIGINT"


def _combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Count, first and last time per session within each Arrow batch."""
    for batch in batches:
        if batch.num_rows:
            grouped = pa.Table.from_batches([batch]).group_by("session_id").aggregate(
                [("at_ms", "count"), ("at_ms", "min"), ("at_ms", "max")]
            )
            columns = ["session_id", "at_ms_count", "at_ms_min", "at_ms_max"]
            renamed = grouped.select(columns).rename_columns(["session_id", "n", "first_ms", "last_ms"])
            renamed = renamed.set_column(1, "n", pc.cast(renamed["n"], pa.int64()))
            yield from renamed.to_batches()


def _advance(timeout_ms: int):
    def run(key, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            events, first, last = state.get
            state.remove()
            expired = True
        else:
            events, first, last = state.get if state.exists else (0, None, None)
            for part in parts:
                low, high = int(part["first_ms"].min()), int(part["last_ms"].max())
                events += int(part["n"].sum())
                first = low if first is None else min(first, low)
                last = high if last is None else max(last, high)
            state.update((events, first, last))
            state.setTimeoutDuration(timeout_ms)
            expired = False
        yield pd.DataFrame(
            {
                "session_id": [key[0]],
                "duration_ms": [last - first],
                "num_events": [events],
                "expired": [expired],
            }
        )

    return run


def session_updates(
    events: DataFrame, session: str, time: str, timeout_ms: int = 10_000
) -> DataFrame:
    """Events and duration of each session, one row per session and batch, in update mode.

    The session of a key ends when no event of it has been processed for ``timeout_ms``; its last
    row has ``expired`` set. The duration spans all its events, also when they arrive out of order.
    Built-in session windows close on event time only, so this one keeps
    its state in a Python function. Events are first combined batch by batch: the function
    receives a few rows per key even when one key has most of the events.
    """
    at_ms = F.unix_millis(F.col(time).cast("timestamp")).alias("at_ms")
    keyed = events.select(F.col(session).cast("string").alias("session_id"), at_ms)
    partial = keyed.where("at_ms IS NOT NULL").mapInArrow(_combine, _PARTIAL_SCHEMA)
    return partial.groupBy("session_id").applyInPandasWithState(
        _advance(timeout_ms), UPDATE_SCHEMA, _STATE_SCHEMA, "update", GroupStateTimeout.ProcessingTimeTimeout
    )


def gap_sessions(
    events: DataFrame, session: str, time: str, gap: str, watermark: str | None = None
) -> DataFrame:
    """Sessions closed by more than a gap in event time: count, first and last event."""
    if watermark:
        events = events.withWatermark(time, watermark)
    return (
        events.groupBy(F.session_window(time, gap).alias("session"), session)
        .agg(
            F.count(F.lit(1)).alias("num_events"),
            F.min(time).alias("first_at"),
            F.max(time).alias("last_at"),
        )
        .drop("session")
    )
