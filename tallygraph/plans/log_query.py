"""Requests and bytes per client, user and query of web server logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: pattern of a combined-format log line.
LOG_LINE = (
    r'^([\d.]+) (\S+) (\S+) \[([\w\d:/]+\s[+\-]\d{4})\] "(.+?)" (\d{3}) ([\d\-]+) "([^"]+)" "([^"]+)".*'
)

# The nine fields of the pattern, in order.
LOG_FIELDS = ("ip", "identity", "user", "time", "query", "status", "bytes", "referer", "agent")


def log_fields(lines: DataFrame, column: str = "value") -> DataFrame:
    """The nine fields of every line as columns, all null for a line the pattern does not match."""
    matches = F.col(column).rlike(LOG_LINE)
    return lines.select(
        *[
            F.when(matches, F.regexp_extract(column, LOG_LINE, i)).alias(name)
            for i, name in enumerate(LOG_FIELDS, start=1)
        ]
    )


def log_query(lines: DataFrame, column: str = "value") -> DataFrame:
    """Lines ``n`` and ``bytes`` per (ip, user, query).

    Lines that do not match, and those of the anonymous user ``"-"``, share the key of nulls.
    A line that does not match adds no bytes, nor does a missing size.
    """
    fields = log_fields(lines, column)
    known = F.col("user") != '"-"'
    return (
        fields.select(
            *[F.when(known, F.col(c)).alias(c) for c in ("ip", "user", "query")],
            F.coalesce(F.col("bytes").try_cast("bigint"), F.lit(0)).alias("bytes"),
        )
        .groupBy("ip", "user", "query")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes"))
    )
