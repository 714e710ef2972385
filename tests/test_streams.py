"""Streams of files: windows and late rows, restart, initial state, sessions and their timeout."""

import time
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tallygraph.plans.load_delay import DURATION_COLUMNS, count_reasons, judge_lines, load_delay, load_delay_stream, parse_lines
from tallygraph.sources.streams import read_new_lines, union_streams
from tallygraph.streaming import clickstream, counts, keyed_state, sessions
from tallygraph.streaming.runner import run_append, run_batches, run_complete, run_update, start


class Feed:
    """A folder that gets one Parquet file per call; each is one micro-batch."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema
        self.add()

    def add(self, *rows):
        if rows:
            frame = self.spark.createDataFrame(list(rows), self.schema)
            frame.coalesce(1).write.mode("append").parquet(self.path)
            time.sleep(0.02)  # files are taken in the order of their times

    def stream(self):
        return self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def make(schema, *batches):
        made = Feed(spark, tmp_path / "in", schema)
        for batch in batches:
            made.add(*batch)
        return made

    return make


WORDS = "ts STRING, word STRING"


def timed(feed):
    return feed.stream().withColumn("ts", F.col("ts").cast("timestamp"))


def test_running_count_modes(feed, rows):
    words = feed(WORDS, [("2024-01-01", "a"), ("2024-01-01", "b")], [("2024-01-01", "a")])
    assert rows(run_complete(counts.count_by(words.stream(), "word"))) == [("a", 2), ("b", 1)]
    assert rows(run_update(counts.count_by(words.stream(), "word"), ["word"])) == [("a", 2), ("b", 1)]


def test_batches_carry_no_state(feed, rows):
    words = feed(WORDS, [("2024-01-01", "a"), ("2024-01-01", "a")], [("2024-01-01", "a")])
    got = run_batches(words.stream(), lambda b: counts.count_by(b, "word"))
    assert rows(got, "batch_id", "n") == [(0, 2), (1, 1)]


def test_initial_state(spark, feed, rows):
    initial = spark.createDataFrame([("hello", 1), ("world", 1)], "word STRING, n BIGINT")
    words = feed(WORDS, [("2024-01-01", "hello"), ("2024-01-01", "new")], [("2024-01-01", "hello")])
    got = counts.stateful_count(words.stream(), "word", initial)
    assert rows(got, "batch_id", "word", "n") == [(0, "hello", 2), (0, "new", 1), (1, "hello", 3)]


def test_sliding_window(feed, rows):
    words = feed(WORDS, [("2024-01-01 00:00:07", "a")])
    got = run_complete(counts.windowed(timed(words), "ts", ["word"], "10 seconds", "5 seconds"))
    assert [r[0] for r in rows(got.select(F.date_format("window.start", "HH:mm:ss")))] == ["00:00:00", "00:00:05"]


def test_slide_longer_than_size_is_refused(feed):
    with pytest.raises(ValueError):
        counts.windowed(timed(feed(WORDS)), "ts", ["word"], "10 seconds", "11 seconds")


def test_late_rows_are_dropped_in_append_mode(feed, rows):
    words = feed(
        WORDS,
        [("2024-01-01 00:00:01", "a"), ("2024-01-01 00:00:30", "a")],
        [("2024-01-01 00:01:30", "a")],
        [("2024-01-01 00:01:20", "a")],  # rows count as late one batch after the watermark moved
        [("2024-01-01 00:00:02", "late"), ("2024-01-01 00:01:25", "a")],
        [("2024-01-01 00:05:00", "a")],
    )
    stream = counts.windowed(timed(words), "ts", ["word"], "1 minute", watermark="20 seconds")
    got = run_append(stream.select(F.date_format("window.start", "HH:mm").alias("start"), "word", "n"))
    assert rows(got) == [("00:00", "a", 2), ("00:01", "a", 3)]


def test_restart_goes_on_from_the_checkpoint(spark, feed, tmp_path, rows):
    words = feed(WORDS, [("2024-01-01", "a"), ("2024-01-01", "stop")])
    place = dict(path=f"{tmp_path}/out", checkpoint_location=f"{tmp_path}/progress", mode="update")
    listed = spark.createDataFrame([("stop",)], "word STRING")

    def query():
        return counts.count_by(counts.split_by_list(words.stream(), "word", listed), "word", "listed")

    run_batches(query(), lambda b: b, **place)
    words.add(("2024-01-02", "a"), ("2024-01-02", "stop"), ("2024-01-02", "stop"))
    got = run_batches(query(), lambda b: b, **place)
    latest = got.groupBy("word", "listed").agg(F.max_by("n", "batch_id"))
    assert rows(latest) == [("a", False, 2), ("stop", True, 3)]
    assert got.select("batch_id").distinct().count() == 2


def test_repeated_batch_replaces_its_output(spark, tmp_path, rows):
    """A batch that runs again after a failure must not count twice."""
    path = f"{tmp_path}/out/batch_id=0"
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(path)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


def test_union_and_text_source(spark, tmp_path, rows):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "f.txt").write_text(f"the {name}\nmore\n")
    stream = union_streams([read_new_lines(spark, f"{tmp_path}/{n}") for n in ("a", "b")])
    got = run_batches(stream.where(F.col("value").contains("the")), lambda b: b.agg(F.count(F.lit(1)).alias("n")))
    assert sum(r["n"] for r in got.collect()) == 2


def test_stream_words(spark, tmp_path, rows):
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "f.txt").write_text("a  b\tb\n")
    got = run_complete(counts.count_by(counts.stream_words(read_new_lines(spark, f"{tmp_path}/t")), "word"))
    assert rows(got) == [("a", 1), ("b", 2)]


VIEWS = "ts STRING, value STRING"


def views(feed):
    return clickstream.page_views(timed(feed))


def view(second, url="p", status=200, zip_code=1, user=1):
    return (f"2024-01-01 00:00:{second:02d}", f"{url}\t{status}\t{zip_code}\t{user}")


def test_clickstream(spark, feed, rows):
    made = feed(VIEWS, [view(1, user=1), view(1, user=1), view(1, status=404, user=2, zip_code=2)], [view(3, "q", user=3)])
    assert rows(clickstream.page_counts(views(made)), "batch_id", "url", "n") == [(0, "p", 3), (1, "q", 1)]
    users = clickstream.active_users(views(made), "10 seconds", "10 seconds")
    assert rows(users, "users") == [(3,)]
    rates = run_complete(clickstream.error_rate_per_zip(views(made), "10 seconds", "10 seconds"))
    assert rows(rates, "zipCode", "ratio", "alert") == [(1, 0.0, False), (2, 1.0, True)]
    names = spark.createDataFrame([(i, f"n{i}") for i in range(9)], "userID INT, name STRING")
    assert rows(clickstream.popular_users_seen(views(made), names, 1), "batch_id", "name") == [(0, "n1"), (1, "n3")]


def test_error_rate_threshold(feed, rows):
    """Exactly 5 of 100 is not above 0.05, 6 of 100 is."""
    batch = [view(1, status=500 if i < bad else 200, zip_code=z) for z, bad in ((1, 5), (2, 6)) for i in range(100)]
    rates = run_complete(clickstream.error_rate_per_zip(views(feed(VIEWS, batch)), "10 seconds", "10 seconds"))
    assert rows(rates, "zipCode", "alert") == [(1, False), (2, True)]


def test_gap_sessions(feed, rows):
    words = feed(WORDS, [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:09", "a"), ("2024-01-01 00:00:20", "a")])
    got = run_complete(sessions.gap_sessions(timed(words), "word", "ts", "10 seconds"))
    assert rows(got, "num_events") == [(1,), (2,)]


def test_session_updates_and_timeout(spark, feed, tmp_path):
    words = feed(WORDS, [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:05", "a"), ("2024-01-01 00:00:00", "b")])
    seen = []

    def sink(batch, _):
        seen.extend(tuple(r) for r in batch.collect())

    stream = sessions.session_updates(timed(words), "word", "ts", timeout_ms=1500)
    query = start(stream, sink, "update", interval="0 seconds")
    try:
        deadline = time.time() + 60
        while time.time() < deadline and sum(r[3] for r in seen) < 2:
            time.sleep(0.2)
        words.add(("2024-01-01 00:01:00", "a"))
        while time.time() < deadline and not any(r[0] == "a" and r[2] == 1 for r in seen):
            time.sleep(0.2)
    finally:
        query.stop()
    assert ("a", 5000, 2, False) in seen and ("a", 5000, 2, True) in seen
    assert ("b", 0, 1, True) in seen
    assert ("a", 0, 1, False) in seen  # the old session is gone, a new one has begun


# Windows that close --------------------------------------------------------------------------------


def state_rows(stream, mode="append", **how):
    """Rows of the state after each batch, by operator."""
    query = start(stream, lambda batch, _: batch.count(), mode, **how)
    query.awaitTermination()
    return [[o["numRowsTotal"] for o in p["stateOperators"]] for p in query.recentProgress]


def test_active_users_close_once(feed, rows):
    made = feed(
        VIEWS,
        [view(1, user=1), view(2, user=1), view(4, user=2), view(11, user=1)],
        [view(3, user=3), view(8, user=1), view(12, user=4)],  # out of order, not too late
        [view(40, user=5)],
        [view(41, user=5)],
        [view(5, user=6), view(41, user=5)],  # too late for its window, two batches after it closed
        [("2024-01-01 00:02:00", "p\t200\t1\t7")],
    )
    closed = run_append(clickstream.active_users_closed(views(made), "10 seconds", "5 seconds", "10 seconds"))
    got = {r[0]: r[1] for r in rows(closed.select(F.date_format("window.start", "mm:ss"), "users"))}
    assert got == {"59:55": 3, "00:00": 3, "00:05": 2, "00:10": 2, "00:35": 1, "00:40": 1}
    sizes = state_rows(clickstream.active_users_closed(views(made), "10 seconds", "5 seconds", "10 seconds"))
    assert max(map(max, sizes)) > 2 and max(sizes[-1]) <= 2  # only the windows of the last view are open


def test_closed_windows_of_many_batches(feed, rows):
    """One row per batch gives what one batch gives, and the state stays small."""
    words = [(f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", "ab"[i % 2]) for i in range(40)]
    one = feed(WORDS, words)
    whole = rows(run_append(counts.windowed(timed(one), "ts", ["word"], "5 minutes", watermark="1 minute")))
    many = Feed(one.spark, one.path + "-many", WORDS)
    Path(many.path).mkdir()
    for i in range(0, 40, 4):
        many.add(*words[i : i + 4])
    stream = counts.windowed(timed(many), "ts", ["word"], "5 minutes", watermark="1 minute")
    assert rows(run_append(stream)) == whole and len(whole) == 14
    assert max(map(max, state_rows(stream))) <= 6


def log_line(ms, session, action, status, network="4G"):
    body = f'{{"condition":{{"progressKey":"{session}","actionName":"{action}","status":"{status}","appversion":"5.1","network":"{network}","ostype":"iOS"}}}}'
    return (f"x,2024-01-01 00:{ms // 60000:02d}:{ms // 1000 % 60:02d}.{ms % 1000:03d},info,{body}",)


def session_lines(start_ms, session, length):
    steps = [(0, "client.init.start", "1"), (50, "client.init.getConfigData", "2"), (90, "client.init.getRideConfig", "1"), (length, "client.init.done", "1")]
    return [log_line(start_ms + at, session, action, status) for at, action, status in steps]


@pytest.mark.parametrize("per_batch", [100, 5, 3])
def test_load_delay_over_batches(spark, feed, rows, per_batch):
    """Sessions are cut by batch borders; the closed windows are those of the batch job."""
    lines = [x for i in range(12) for x in session_lines(i * 50_000, f"s{i}", 1000 + 700 * i)]
    lines += [("broken",), log_line(1_700_000, "end", "client.init.start", "1")]
    made = feed("value STRING", *[lines[i : i + per_batch] for i in range(0, len(lines), per_batch)])
    got = run_append(load_delay_stream(made.stream(), watermark="1 minute"))
    batch = load_delay(spark.createDataFrame(lines, "value STRING"))
    assert got.columns == batch.columns
    assert rows(got) == rows(batch) and got.agg(F.sum("sessions")).first()[0] == 12
    assert got.select(sum(F.col(c) for c in DURATION_COLUMNS) == F.col("sessions")).distinct().collect() == [(True,)]


def test_load_delay_drops_late_lines_and_state(feed, rows):
    made = feed(
        "value STRING",
        session_lines(10_000, "a", 2000),
        [log_line(900_000, "x", "client.init.start", "1")],
        [log_line(900_500, "x", "client.init.start", "1")],
        session_lines(20_000, "late", 2000),
        [log_line(1_800_000, "y", "client.init.start", "1")],
    )
    stream = load_delay_stream(made.stream(), watermark="1 minute")
    assert rows(run_append(stream), "sessions") == [(1,)]
    assert sum(state_rows(stream)[-1]) == 1  # the last window only


def test_judged_lines(spark, rows):
    good = session_lines(0, "s", 900)
    bad = [("x,no time,info,{}",), ("x,2024-01-01 00:00:00.000,info",), ("x,2024-01-01 00:00:00.000,info,{\"condition\":{",), (None,), ("",)]
    lines = spark.createDataFrame(good + bad, "value STRING")
    judged = judge_lines(lines)
    assert rows(count_reasons(judged)) == [("kept", 4), ("session", 1), ("text", 1), ("time", 3)]
    kept = judged.where("reason IS NULL")
    assert kept.where("line IS NOT NULL").isEmpty()
    assert rows(kept.drop("reason", "line")) == rows(parse_lines(lines))
    assert rows(judged.where("reason = 'text'"), "line") == [bad[1]]


# State per key -------------------------------------------------------------------------------------


def test_initial_counts_survive_a_restart(spark, feed, tmp_path, rows):
    initial = spark.createDataFrame([("hello", 10), ("hello", 5), ("unseen", 7)], "word STRING, n BIGINT")
    words = feed(WORDS, [("2024-01-01", "hello"), ("2024-01-01", "new"), ("2024-01-01", None)])
    place = dict(path=f"{tmp_path}/out", checkpoint_location=f"{tmp_path}/progress")
    counts.stateful_count(words.stream(), "word", initial, **place)
    words.add(("2024-01-02", "hello"), ("2024-01-02", "unseen"), ("2024-01-02", None))
    got = counts.stateful_count(words.stream(), "word", initial, **place)
    assert rows(got, "batch_id", "word", "n") == sorted(
        [(0, "hello", 16), (0, "new", 1), (0, None, 1), (1, "hello", 17), (1, "unseen", 8), (1, None, 2)], key=repr
    )
    again = counts.stateful_count(words.stream(), "word", initial, **place)  # nothing new to count
    assert rows(again, "batch_id", "word", "n") == rows(got, "batch_id", "word", "n")


def test_sink_that_fails_once(feed, tmp_path, rows):
    words = feed(WORDS, [("2024-01-01", "a"), ("2024-01-01", "b")], [("2024-01-01", "a")])
    place = dict(path=f"{tmp_path}/out", checkpoint_location=f"{tmp_path}/progress", mode="update")
    seen = []

    def write(batch):
        seen.append(batch.count())
        if len(seen) == 2:
            raise ConnectionError("away")
        return batch

    with pytest.raises(Exception, match="away"):
        run_batches(counts.count_by(words.stream(), "word"), write, **place)
    got = run_batches(counts.count_by(words.stream(), "word"), write, **place)
    assert rows(got, "batch_id", "word", "n") == [(0, "a", 1), (0, "b", 1), (1, "a", 2)]
    assert len(seen) == 3  # the first batch is not run again


def test_expiring_sessions(feed, rows):
    words = feed(
        WORDS,
        [("2024-01-01 00:00:00", "a"), ("2024-01-01 00:00:05", "a"), ("2024-01-01 00:00:40", "a"), ("2024-01-01 00:00:01", "b")],
        [("2024-01-01 00:00:12", "a"), ("2024-01-01 00:00:20", "b"), ("2024-01-01 00:00:11", "b"), (None, "b")],
        [("2024-01-01 00:05:00", "c"), ("2024-01-01 00:05:00", None)],
        [("2024-01-01 00:05:01", "c")],
    )
    stream = keyed_state.expiring_sessions(timed(words), "word", "ts", 10_000, "20 seconds")
    base = 1704067200000
    got = rows(run_update(stream, ["session_id", "first_ms"], processors=True))
    assert [(r[0], r[1] - base, r[2] - base, *r[3:]) for r in got] == sorted(
        [
            ("a", 0, 12_000, 3, True), ("a", 40_000, 40_000, 1, True), ("b", 1_000, 20_000, 3, True),
            ("c", 300_000, 301_000, 2, False), (None, 300_000, 300_000, 1, False),
        ],
        key=repr,
    )


def test_expired_sessions_leave_no_state(feed):
    words = feed(WORDS, *[[(f"2024-01-01 {h:02d}:00:00", w) for w in "abc"] for h in range(6)])
    stream = keyed_state.expiring_sessions(timed(words), "word", "ts", 1_000, "1 minute")
    sizes = [max(s) for s in state_rows(stream, "update", processors=True) if s]
    assert sizes[-1] <= max(sizes) and max(sizes) <= 40


class _Handle:
    """State and timers of one key, with every call that sets or drops a timer."""

    def __init__(self):
        self.timers, self.calls, self._rows = set(), 0, []

    def getListState(self, name, schema):
        return self

    def exists(self):
        return bool(self._rows)

    def get(self):
        return iter(self._rows)

    def put(self, held):
        self._rows = list(held)

    def clear(self):
        self._rows = []

    def registerTimer(self, at):
        self.timers.add(at)
        self.calls += 1

    def deleteTimer(self, at):
        self.timers.remove(at)
        self.calls += 1


def test_sessions_of_a_key_share_a_timer():
    handle, sessions = _Handle(), keyed_state._Sessions(10)
    sessions.init(handle)
    clock = lambda now: SimpleNamespace(getCurrentWatermarkInMs=lambda: now)
    feed = lambda *spans: [dict(first_ms=a, last_ms=b, n=n) for a, b, n in spans]
    opened = list(sessions.handleInputRows(("k",), iter(feed(*[(i * 100, i * 100, 1) for i in range(50)])), clock(0)))
    assert len(opened) == 50 and not any(r.expired for r in opened)
    assert handle.timers == {11} and handle.calls == 1
    assert [tuple(r) for r in sessions.handleInputRows(("k",), iter(feed((5, 8, 2))), clock(0))] == [("k", 0, 8, 3, False)]
    assert handle.timers == {19}  # it has moved with the first session
    handle.timers.clear()  # the engine drops a timer that has fired
    closed = list(sessions.handleExpiredTimer(("k",), clock(4000), None))
    assert [(r.first_ms, r.expired) for r in closed] == [(i * 100, True) for i in range(40)]
    assert handle.timers == {4011}
    handle.timers.clear()
    assert len(list(sessions.handleExpiredTimer(("k",), clock(9000), None))) == 10
    assert not handle.timers and not handle.exists()


def test_merged_spans():
    spans = [(0, 5, 1), (20, 30, 2), (15, 15, 1), (6, 6, 1), (100, 100, 1), (26, 90, 1), (0, 5, 1)]
    assert keyed_state.merged(spans, 9) == [(0, 90, 7), (100, 100, 1)]
    assert keyed_state.merged(spans, 10) == [(0, 100, 8)]
    assert keyed_state.merged(spans, 5) == [(0, 6, 3), (15, 90, 4), (100, 100, 1)]
    assert keyed_state.merged([], 5) == []
