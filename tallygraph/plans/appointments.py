"""Appointment metrics: log lines to a table partitioned by day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import appointment_status, between_markers

BODY = (
    "condition STRUCT<userGuid: STRING, bikeNo: STRING, distance: STRING, lat: STRING, lng: STRING>, "
    "entityMata STRUCT<metric: STRING>"
)


def appointments(lines: DataFrame, as_of: str | Column, days: int = 2, column: str = "value") -> DataFrame:
    """Appointment rows of log lines whose day lies within ``as_of`` +/- ``days``, all strings.

    Lines without a time, with malformed JSON or with another metric are dropped. ``as_of`` is a
    date: the bounds are its midnight plus and minus the days.
    """
    as_of = F.lit(as_of).cast("date") if isinstance(as_of, str) else as_of
    time = F.trim(between_markers(F.col(column), r",([\d-]*?\s[\d:.]*?),"))
    body = F.from_json(between_markers(F.col(column), r'(?s)(\{"condition".+\})'), BODY)
    rows = lines.select(time.alias("create_time"), body.alias("body"))
    pt = F.regexp_replace(F.substring_index("create_time", " ", 1), "-", "")
    rows = rows.select(
        "create_time", pt.alias("pt"), "body", appointment_status(F.col("body.entityMata.metric")).alias("status")
    )
    day = F.to_date(F.try_to_timestamp("pt", F.lit("yyyyMMdd")))
    in_range = (F.length("pt") == 8) & day.between(F.date_sub(as_of, days), F.date_add(as_of, days))
    return rows.where(in_range & F.col("status").isNotNull()).select(
        F.col("body.condition.userGuid").alias("user_guid"),
        F.col("body.condition.bikeNo").alias("bike_no"),
        F.col("body.condition.distance").alias("distance"),
        F.col("body.condition.lat").alias("lat"),
        F.col("body.condition.lng").alias("lng"),
        "status",
        "create_time",
        "pt",
    )


def append_appointments(rows: DataFrame, path: str) -> None:
    """Append to a Parquet table partitioned by day.

    Rows are rebalanced by day: small days share a task and a large one is split over several.
    """
    rows.hint("rebalance", "pt").write.mode("append").partitionBy("pt").parquet(path)
