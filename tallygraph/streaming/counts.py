"""Counts over streams: running, windowed, per batch and with an initial state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import words
from tallygraph.streaming.keyed_state import counts_from
from tallygraph.streaming.runner import run_batches


def stream_words(lines: DataFrame, text: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """Words of streamed lines, with further columns kept."""
    return lines.select(*keep, F.explode(words(F.col(text))).alias("word"))


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per key. On a stream this is the running count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _seconds(interval: str) -> float:
    number, unit = interval.split()
    scale = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
    return float(number) * scale[unit.rstrip("s")]


def windowed(
    df: DataFrame,
    time: str,
    keys: list[str],
    size: str,
    slide: str | None = None,
    watermark: str | None = None,
    **aggregates: Column,
) -> DataFrame:
    """Aggregates per window of event time and key; the slide is the size unless given.

    Counts rows as ``n`` if no aggregate is named. With a watermark the state of closed windows
    is dropped and late rows are ignored; without one all windows are kept.
    """
    slide = slide or size
    if _seconds(slide) > _seconds(size):
        raise ValueError("the slide of a window must not be longer than the window")
    aggregates = aggregates or {"n": F.count(F.lit(1))}
    if watermark:
        df = df.withWatermark(time, watermark)
    return df.groupBy(F.window(time, size, slide).alias("window"), *keys).agg(
        *[e.alias(n) for n, e in aggregates.items()]
    )


def stateful_count(df: DataFrame, key: str, initial: DataFrame, **place: str) -> DataFrame:
    """Running count per key on top of initial counts ``(key, n)``, as ``(key, n, batch_id)``.

    Every batch gives one row for each key it contains. The initial counts are handed to the state
    once; with the ``path`` and ``checkpoint_location`` of an earlier run, that run's counts go on.
    """
    return run_batches(counts_from(df, key, initial), lambda batch: batch, mode="update", processors=True, **place)


def split_by_list(df: DataFrame, key: str, listed: DataFrame) -> DataFrame:
    """Mark rows whose key is listed: column ``listed``. The list is joined to every batch.

    A short list is broadcast by the planner; a long one is joined by shuffle.
    """
    marked = listed.select(key).distinct().withColumn("_hit", F.lit(True))
    return df.join(marked, key, "left").select(*df.columns, F.coalesce("_hit", F.lit(False)).alias("listed"))
