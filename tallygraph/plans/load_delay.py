"""Start-up time of app sessions from their log lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallygraph.functions.scalar import network_label

CONDITION = (
    "condition STRUCT<progressKey: STRING, actionName: STRING, status: STRING, "
    "appversion: STRING, network: STRING, ostype: STRING>"
)

# The two steps between which an advertisement is shown.
CONFIG_STEP = ("client.init.getConfigData", "2")
RIDE_STEP = ("client.init.getRideConfig", "1")

# Duration classes of one second each, the last one open.
DURATION_COLUMNS = (
    "du1sLow", "du1To2s", "du2To3s", "du3To4s", "du4To5s", "du5To6s",
    "du6To7s", "du7To8s", "du8To9s", "du9To10s", "du10Over",
)


def _line(column: str) -> Column:
    """``at`` between the first two commas, not counting one at the very start; ``c`` from the first ``,{``."""
    value = F.col(column)
    rest = F.substring(value, F.lit(2), F.length(value))
    at = F.try_to_timestamp(F.get(F.split(rest, ",", 3), F.lit(1)), F.lit("yyyy-MM-dd HH:mm:ss.SSS"))
    start = F.instr(value, ",{")
    body = F.from_json(F.when(start > 0, F.substring(value, start + 1, F.length(value))), CONDITION)
    return F.struct(at.alias("at"), body["condition"].alias("c"), (start > 0).alias("has_text"), value.alias("line"))


def parse_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Log time and condition fields of every line; malformed lines are dropped.

    The time stands between the first two commas, not counting one at the very start; the JSON text
    starts at the first ``,{``. :func:`judge_lines` keeps what is dropped here.
    """
    # Filtered inside an array: a filter on the columns would be pushed below and parse a line twice.
    usable = F.filter(F.array(_line(column)), lambda x: x["at"].isNotNull() & x["c"]["progressKey"].isNotNull())
    return lines.select(F.inline(usable)).select("at", "c.*")


def judge_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """Fields of every line as :func:`parse_lines` has them, and in ``reason`` why it is dropped there.

    A line lacks a ``time``, a JSON ``text``, or a ``session`` in it, in this order; the reason of a
    kept line is null. Kept and rejected lines come from one pass; rejected ones carry ``line``.
    """
    judged = F.transform(
        F.array(_line(column)),
        lambda x: F.struct(
            x["at"].alias("at"),
            x["c"].alias("c"),
            F.when(x["at"].isNull(), "time")
            .when(~F.coalesce(x["has_text"], F.lit(False)), "text")
            .when(x["c"]["progressKey"].isNull(), "session")
            .alias("reason"),
            x["line"].alias("line"),
        ),
    )
    rejected = F.when(F.col("reason").isNotNull(), F.col("line")).alias("line")
    return lines.select(F.inline(judged)).select("at", "c.*", "reason", rejected)


def count_reasons(judged: DataFrame) -> DataFrame:
    """Number of lines per reason; kept lines have reason ``kept``."""
    return judged.groupBy(F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def _step(name: tuple[str, str]) -> Column:
    action, status = name
    reached = (F.col("actionName") == action) & (F.col("status") == status)
    return F.max(F.when(reached, F.unix_millis("at")))


def session_durations(parsed: DataFrame, window: str = "5 minutes") -> DataFrame:
    """Duration of every session in a window of arrival, without its advertisement.

    A session that lacks either step has no duration. Fields are those of the latest line. On a
    stream ``closed_at`` is the event time of what leaves a window.
    """
    latest = F.max(F.struct("at", "actionName", "status", "appversion", "network", "ostype"))
    sessions = parsed.groupBy(F.window("at", window).alias("window"), "progressKey").agg(
        latest.alias("latest"),
        (F.unix_millis(F.max("at")) - F.unix_millis(F.min("at"))).alias("span"),
        _step(CONFIG_STEP).alias("config"),
        _step(RIDE_STEP).alias("ride"),
    )
    return sessions.select(
        F.col("window.start").alias("point_time"),
        *([F.window_time("window").alias("closed_at")] if parsed.isStreaming else []),
        "progressKey",
        F.col("latest.appversion").alias("version"),
        F.lower("latest.network").alias("network"),
        F.lower("latest.ostype").alias("os"),
        (F.col("span") - F.abs(F.col("config") - F.col("ride"))).alias("duration"),
    )


def delay_histogram(durations: DataFrame, *time: str | Column) -> DataFrame:
    """Mean and one-second classes of the durations per window, version, network and system.

    Only durations above 0 and below one minute of fully described sessions count.
    """
    usable = (F.col("duration") > 0) & (F.col("duration") < 60000)
    for name in ("version", "network", "os"):
        usable = usable & F.col(name).isNotNull() & (F.col(name) != "")
    time = time or ("point_time",)
    kept = durations.where(usable).withColumn("network", network_label(F.col("network")))
    second = F.least(F.floor(F.col("duration") / 1000), F.lit(len(DURATION_COLUMNS) - 1))
    return kept.groupBy(*time, "version", "network", "os").agg(
        F.expr("sum(duration) div count(1)").alias("averageTimeByMinute"),
        F.count(F.lit(1)).alias("sessions"),
        *[F.count_if(second == i).alias(name) for i, name in enumerate(DURATION_COLUMNS)],
    )


def load_delay(lines: DataFrame, window: str = "5 minutes", column: str = "value") -> DataFrame:
    """Start-up histogram of raw log lines."""
    return delay_histogram(session_durations(parse_lines(lines, column), window))


def load_delay_stream(
    lines: DataFrame, window: str = "5 minutes", watermark: str = "10 minutes", column: str = "value"
) -> DataFrame:
    """:func:`load_delay` of a stream of log lines, as a stream in append mode.

    The steps of a session may come in different batches: they wait in the state until their window
    is older than the latest line by the watermark. Then its sessions go on to the histogram, which
    is complete and leaves at once, and the state of the window is dropped; lines that come later
    still are ignored.
    """
    parsed = parse_lines(lines, column).withWatermark("at", watermark)
    found = delay_histogram(session_durations(parsed, window), F.window("closed_at", window).alias("window"))
    numbers = [c for c in found.columns if c != "window"]
    return found.select(F.col("window.start").alias("point_time"), *numbers)


def as_content(histogram: DataFrame) -> DataFrame:
    """Histogram rows with their numbers packed into one JSON text."""
    numbers = F.to_json(F.struct("averageTimeByMinute", "point_time", *DURATION_COLUMNS))
    return histogram.select("point_time", "version", "network", "os", numbers.alias("content"))
