"""Streaming queries over the tables read as file streams, collected as tables."""

from __future__ import annotations

import uuid

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tallygraph.plans.appointments import appointments
from tallygraph.plans.load_delay import load_delay, load_delay_stream
from tallygraph.queries.logs import APPOINTMENTS_SQL, AS_OF, LOAD_DELAY_SQL, app_log_lines, metric_lines
from tallygraph.queries.registry import query
from tallygraph.session import stream_table, table
from tallygraph.sources.streams import replay, union_streams
from tallygraph.storage import scratch_path
from tallygraph.streaming import clickstream, counts, keyed_state, sessions
from tallygraph.streaming.runner import run_append, run_batches, run_complete, run_update

BATCHES = 4


def event_stream(spark, folder):
    """Events as a stream with a time the engine can put watermarks on."""
    return stream_table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def page_view_stream(spark, folder):
    """Events as tab-separated page views, parsed back."""
    text = F.concat_ws(
        "\t",
        F.col("event_type"),
        F.when(F.col("event_type") == "error", "500").otherwise("200"),
        (F.col("user_id") % 10).cast("string"),
        F.col("user_id").cast("string"),
    )
    return clickstream.page_views(event_stream(spark, folder).select("ts", text.alias("value")))


def _window_text(df):
    return df.withColumn("start", F.date_format("window.start", "yyyy-MM-dd HH:mm:ss")).drop("window")


def _sliding_sql(select: str, group: str) -> str:
    """Rows of the events in every 6-hour window that slides by one hour."""
    return f"""
    WITH slid AS (
      SELECT *, unnest(range(0, 6)) AS back FROM events),
    windows AS (SELECT *, strftime(date_trunc('hour', ts) - INTERVAL 1 HOUR * back, '%Y-%m-%d %H:%M:%S') AS start FROM slid)
    SELECT start, {select} FROM windows GROUP BY start{group}"""


SIZE, SLIDE = "6 hours", "1 hour"


@query(
    "SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \t]')) AS word FROM conversations) "
    "WHERE length(word) > 0 GROUP BY word"
)
def stream_running_count(spark, folder):
    lines = stream_table(spark, folder, "conversations")
    return run_complete(counts.count_by(counts.stream_words(lines, "text"), "word"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_update_count(spark, folder):
    """Running count in update mode over several batches."""
    stream = replay(table(spark, folder, "events").select("ts", "event_type"), "ts", BATCHES)
    return run_update(counts.count_by(stream, "event_type"), ["event_type"])


@query(
    "SELECT strftime(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS start, "
    "event_type, count(*) AS n FROM events GROUP BY 1, 2"
)
def stream_tumbling_count(spark, folder):
    stream = counts.windowed(event_stream(spark, folder), "ts", ["event_type"], SIZE)
    return run_complete(stream, lambda batch: _window_text(batch.orderBy("window")))


@query(_sliding_sql("event_type, count(*) AS n", ", event_type"))
def stream_sliding_count(spark, folder):
    stream = counts.windowed(event_stream(spark, folder), "ts", ["event_type"], SIZE, SLIDE)
    return run_complete(stream, lambda batch: _window_text(batch.orderBy("window")))


@query(
    """
    WITH marked AS (
      SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 10 MINUTE THEN 1 ELSE 0 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM marked)
    SELECT user_id, count(*) AS num_events, epoch_us(min(ts)) AS first_at, epoch_us(max(ts)) AS last_at
    FROM numbered GROUP BY user_id, s
    """
)
def stream_sessions(spark, folder):
    found = run_complete(sessions.gap_sessions(event_stream(spark, folder), "user_id", "ts", "10 minutes"))
    return found.withColumn("first_at", F.unix_micros("first_at")).withColumn("last_at", F.unix_micros("last_at"))


@query(
    "SELECT CAST(user_id AS VARCHAR) AS session_id, epoch_us(max(ts)) // 1000 - epoch_us(min(ts)) // 1000 AS duration_ms, "
    "count(*) AS num_events, false AS expired FROM events GROUP BY user_id"
)
def stream_session_updates(spark, folder):
    """Custom session state over several batches; the timeout is far longer than the run."""
    stream = replay(table(spark, folder, "events").select("ts", "user_id"), "ts", BATCHES)
    updates = sessions.session_updates(stream, "user_id", "ts", timeout_ms=86_400_000)
    return run_update(updates, ["session_id"], timers=True)


@query("SELECT event_type AS url, count(*) AS n FROM events GROUP BY event_type")
def clicks_page_counts(spark, folder):
    per_batch = clickstream.page_counts(page_view_stream(spark, folder))
    return per_batch.groupBy("url").agg(F.sum("n").alias("n"))


@query(_sliding_sql("event_type AS url, count(*) AS n", ", event_type"))
def clicks_sliding_pages(spark, folder):
    return run_complete(clickstream.sliding_page_counts(page_view_stream(spark, folder), SIZE, SLIDE), _window_text)


@query(
    _sliding_sql(
        "CAST(user_id % 10 AS INTEGER) AS \"zipCode\", count(*) AS views, count(*) FILTER (WHERE event_type = 'error') AS errors, "
        "CAST(floor(count(*) FILTER (WHERE event_type = 'error') / count(*) * 1e4 + 0.5) AS BIGINT) AS ratio, "
        "count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.05 AS alert",
        ", user_id % 10",
    )
)
def clicks_error_rate(spark, folder):
    stream = clickstream.error_rate_per_zip(page_view_stream(spark, folder), SIZE, SLIDE)
    rates = run_complete(stream, _window_text)
    return rates.withColumn("ratio", F.floor(F.col("ratio") * 10000 + 0.5).cast("bigint"))


@query(_sliding_sql("count(DISTINCT user_id) AS users", ""))
def clicks_active_users(spark, folder):
    return _window_text(clickstream.active_users(page_view_stream(spark, folder), SIZE, SLIDE))


@query(
    'SELECT c_custkey AS "userID", c_name AS name FROM customer WHERE c_custkey IN (SELECT user_id FROM events) '
    "ORDER BY c_custkey LIMIT 10"
)
def stream_popular_users(spark, folder):
    users = table(spark, folder, "customer").select(F.col("c_custkey").cast("int").alias("userID"), F.col("c_name").alias("name"))
    return clickstream.popular_users_seen(page_view_stream(spark, folder), users).drop("batch_id")


@query(
    "SELECT word, word IN ('a', 'b', 'c', 'the', 'The') AS listed, count(*) AS n FROM "
    "(SELECT unnest(string_split_regex(text, '[ \t]')) AS word FROM conversations) WHERE length(word) > 0 GROUP BY 1, 2"
)
def stream_blacklist_count(spark, folder):
    """Words counted, those on a list marked as dropped."""
    listed = spark.createDataFrame([(w,) for w in ("a", "b", "c", "the", "The")], "word STRING")
    words = counts.stream_words(stream_table(spark, folder, "conversations"), "text")
    return run_complete(counts.count_by(counts.split_by_list(words, "word", listed), "word", "listed"))


@query("SELECT word, count(*) AS n FROM (SELECT unnest(string_split_regex(text, '[ \t]')) AS word FROM conversations) WHERE length(word) > 0 GROUP BY word")
def stream_batch_counts(spark, folder):
    """Words counted within each batch; the counts of all batches add up."""
    stream = replay(table(spark, folder, "conversations"), "conv_id", BATCHES)
    per_batch = run_batches(counts.stream_words(stream, "text"), lambda batch: counts.count_by(batch, "word"))
    return per_batch.groupBy("word").agg(F.sum("n").alias("n"))


@query(
    "SELECT count(*) AS n FROM (SELECT text FROM documents UNION ALL SELECT text FROM conversations) WHERE contains(text, 'the')"
)
def stream_union_grep(spark, folder):
    streams = [stream_table(spark, folder, name).select("text") for name in ("documents", "conversations")]
    hits = union_streams(streams).where(F.col("text").contains("the"))
    per_batch = run_batches(hits, lambda batch: batch.agg(F.count(F.lit(1)).alias("n")))
    return per_batch.agg(F.sum("n").alias("n"))


@query("SELECT user_id % 10 AS digit, count(*) AS n FROM events GROUP BY 1")
def stream_mod10_count(spark, folder):
    stream = replay(table(spark, folder, "events").select("event_id", "user_id"), "event_id", BATCHES)
    digit = (F.col("user_id") % 10).alias("digit")
    per_batch = run_batches(stream.select(digit), lambda batch: counts.count_by(batch, "digit"))
    return per_batch.groupBy("digit").agg(F.sum("n").alias("n"))


@query(
    "SELECT event_type, count(*) + CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS n FROM events GROUP BY event_type"
)
def stream_stateful_count(spark, folder):
    initial = spark.createDataFrame([("click", 1), ("view", 1), ("never seen", 5)], "event_type STRING, n BIGINT")
    stream = replay(table(spark, folder, "events").select("ts", "event_type"), "ts", BATCHES)
    updates = counts.stateful_count(stream.select("event_type"), "event_type", initial)
    return updates.groupBy("event_type").agg(F.max_by("n", "batch_id").alias("n"))


@query("SELECT role, count(*) AS total FROM conversations GROUP BY role")
def stream_sql_batch(spark, folder):
    """SQL on a temporary view of every batch."""
    view = f"batch_{uuid.uuid4().hex}"

    def by_sql(batch):
        batch.createOrReplaceTempView(view)
        return batch.sparkSession.sql(f"SELECT role, count(*) AS total FROM {view} GROUP BY role")

    stream = replay(table(spark, folder, "conversations").select("conv_id", "role"), "conv_id", BATCHES)
    return run_batches(stream, by_sql).groupBy("role").agg(F.sum("total").alias("total"))


@query(APPOINTMENTS_SQL)
def stream_appointments(spark, folder):
    lines = metric_lines(stream_table(spark, folder, "events"))
    return run_append(appointments(lines, AS_OF), partition_by="pt")


@query(LOAD_DELAY_SQL)
def stream_load_delay(spark, folder):
    """Start-up histogram of every batch of log lines; here one batch holds all lines."""
    per_batch = run_batches(app_log_lines(stream_table(spark, folder, "events")), load_delay)
    return per_batch.drop("batch_id").withColumn("point_time", F.date_format("point_time", "yyyy-MM-dd HH:mm:ss"))


# Windows that close: rows leave once the latest event is later by the watermark, in append mode.
LATE = "3 hours"
_CLOSED_SQL = """SELECT * FROM ({windows}) WHERE CAST(start AS TIMESTAMP) + INTERVAL 6 HOUR
    <= (SELECT max(ts) FROM events) - INTERVAL 3 HOUR"""


@query(_CLOSED_SQL.format(windows=_sliding_sql("event_type, count(*) AS n", ", event_type")))
def stream_closed_windows(spark, folder):
    return _window_text(run_append(counts.windowed(event_stream(spark, folder), "ts", ["event_type"], SIZE, SLIDE, LATE)))


@query(_CLOSED_SQL.format(windows=_sliding_sql("event_type AS url, count(*) AS n", ", event_type")))
def clicks_closed_pages(spark, folder):
    return _window_text(run_append(clickstream.sliding_page_counts(page_view_stream(spark, folder), SIZE, SLIDE, LATE)))


@query(
    _CLOSED_SQL.format(
        windows=_sliding_sql(
            "CAST(user_id % 10 AS INTEGER) AS \"zipCode\", count(*) AS views, count(*) FILTER (WHERE event_type = 'error') AS errors, "
            "count(*) FILTER (WHERE event_type = 'error') / count(*) > 0.2 AS alert",
            ", user_id % 10",
        )
    )
)
def clicks_closed_error_rate(spark, folder):
    stream = clickstream.error_rate_per_zip(page_view_stream(spark, folder), SIZE, SLIDE, 0.2, LATE)
    return _window_text(run_append(stream.drop("ratio")))


@query(_CLOSED_SQL.format(windows=_sliding_sql("count(DISTINCT user_id) AS users", "")))
def clicks_closed_active_users(spark, folder):
    return _window_text(run_append(clickstream.active_users_closed(page_view_stream(spark, folder), SIZE, SLIDE, LATE)))


@query(
    f"""
    WITH last AS (SELECT max(epoch_us(ts) // 1000 + 200 + CAST(floor(value * 100) AS BIGINT)) AS t FROM events)
    SELECT h.* FROM ({LOAD_DELAY_SQL}) h, last
    WHERE epoch_us(CAST(point_time AS TIMESTAMP)) // 1000 + 300000 <= last.t - 600000"""
)
def stream_load_delay_windows(spark, folder):
    """Start-up histogram of the windows that have closed; their sessions may span batches."""
    closed = run_append(load_delay_stream(app_log_lines(stream_table(spark, folder, "events"))))
    return closed.withColumn("point_time", F.date_format("point_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    """
    WITH marked AS (
      SELECT user_id, epoch_us(ts) // 1000 AS ms,
             CASE WHEN epoch_us(ts) // 1000 - lag(epoch_us(ts) // 1000) OVER w > 21600000 THEN 1 ELSE 0 END AS opens
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    numbered AS (SELECT user_id, ms, sum(opens) OVER (PARTITION BY user_id ORDER BY ms ROWS UNBOUNDED PRECEDING) AS s FROM marked)
    SELECT CAST(user_id AS VARCHAR) AS session_id, min(ms) AS first_ms, max(ms) AS last_ms, count(*) AS num_events,
           max(ms) + 21600000 < (SELECT max(epoch_us(ts)) // 1000 FROM events) - 10800000 AS expired
    FROM numbered GROUP BY user_id, s"""
)
def stream_expiring_sessions(spark, folder):
    """Sessions of events at most 6 hours apart; those the watermark has passed are expired."""
    found = keyed_state.expiring_sessions(event_stream(spark, folder), "user_id", "ts", 21_600_000, LATE)
    return run_update(found, ["session_id", "first_ms"], processors=True)


@query("SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def stream_recovered_count(spark, folder):
    """A count whose sink fails once: the next run on its checkpoint repeats the batch, a third finds no more."""
    place = {"path": scratch_path(spark, "recovered"), "checkpoint_location": scratch_path(spark, "progress")}
    failed = []

    def write(batch):
        if not failed:
            failed.append(batch.count())
            raise ConnectionError("the sink is away")
        return batch

    def run():
        counted = counts.count_by(event_stream(spark, folder), "event_type")
        return run_batches(counted, write, mode="update", **place)

    try:
        run()
    except StreamingQueryException:
        run()
    return run().groupBy("event_type").agg(F.max_by("n", "batch_id").alias("n"))
