"""Metrics over a stream of page views ``(url, status, zipCode, userID, ts)``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallygraph.sources.files import fields
from tallygraph.streaming.counts import count_by, windowed
from tallygraph.streaming.runner import run_batches, run_complete

# Fields of a tab-separated page view.
PAGE_VIEW = [("url", "string"), ("status", "int"), ("zipCode", "int"), ("userID", "int")]


def page_views(lines: DataFrame, keep: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Page views of tab-separated lines, next to the columns that are kept."""
    return lines.select(*keep, *fields(F.col("value"), PAGE_VIEW, "\t"))


def page_counts(views: DataFrame) -> DataFrame:
    """Views per page within each batch."""
    return run_batches(views.select("url"), lambda batch: count_by(batch, "url"))


def sliding_page_counts(
    views: DataFrame, size: str = "10 seconds", slide: str = "2 seconds", watermark: str | None = None
) -> DataFrame:
    """Views per page in sliding windows."""
    return windowed(views, "ts", ["url"], size, slide, watermark)


def error_rate_per_zip(
    views: DataFrame,
    size: str = "30 seconds",
    slide: str = "2 seconds",
    threshold: float = 0.05,
    watermark: str | None = None,
) -> DataFrame:
    """Share of views that failed per zip code, and whether it is above the threshold."""
    rates = windowed(
        views,
        "ts",
        ["zipCode"],
        size,
        slide,
        watermark,
        views=F.count(F.lit(1)),
        errors=F.count_if(~F.col("status").eqNullSafe(200)),
    )
    ratio = F.col("errors") / F.col("views")
    return rates.withColumn("ratio", ratio).withColumn("alert", ratio > threshold)


def active_users(views: DataFrame, size: str = "15 seconds", slide: str = "2 seconds") -> DataFrame:
    """Distinct users per sliding window.

    The stream keeps one row per (window, user); users are counted per window as rows leave it,
    so no window gathers its users in one cell.
    """
    seen = windowed(views, "ts", ["userID"], size, slide)
    return run_complete(
        seen, lambda batch: batch.groupBy("window").agg(F.count(F.lit(1)).alias("users"))
    )


def active_users_closed(
    views: DataFrame, size: str = "15 seconds", slide: str = "2 seconds", watermark: str = "15 seconds"
) -> DataFrame:
    """Distinct users of every sliding window that has closed, as a stream in append mode.

    A (window, user) is remembered once and forgotten when its window closes; what is new is
    counted as it comes, so no window is ever counted again. Windows close when the latest view is
    later than their end by the watermark; views that come later still are ignored.
    """
    windows = views.withWatermark("ts", watermark).select(F.window("ts", size, slide).alias("window"), "userID")
    first = windows.where("userID IS NOT NULL").dropDuplicates(["window", "userID"])
    return first.groupBy("window").agg(F.count(F.lit(1)).alias("users"))


def popular_users_seen(views: DataFrame, users: DataFrame, n: int = 10) -> DataFrame:
    """First n listed users ``(userID, name)`` that each batch has seen, in order of their id."""

    def seen(batch: DataFrame) -> DataFrame:
        present = users.join(batch.select("userID").distinct(), "userID", "left_semi")
        return present.orderBy("userID").limit(n)

    return run_batches(views, seen)
