"""Log pipelines over lines built from the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallygraph.plans.appointments import append_appointments, appointments
from tallygraph.plans.load_delay import DURATION_COLUMNS, count_reasons, judge_lines, load_delay
from tallygraph.plans.log_query import log_query as summarize_log
from tallygraph.queries.registry import query
from tallygraph.session import table
from tallygraph.storage import scratch_path

AS_OF = "2024-01-15"


def web_log_lines(spark, folder):
    """One web log line per event; events of type signup have user "-", every view no size."""
    kind = F.col("event_type")
    bytes_ = F.when(kind == "view", F.lit("-")).otherwise(F.floor("value").cast("string"))
    user = F.when(kind == "signup", F.lit('"-"')).otherwise(F.concat(F.lit("u"), F.col("user_id").cast("string")))
    good = F.concat(
        F.lit("10.0.0."), (F.col("user_id") % 250).cast("string"), F.lit(" - "), user,
        F.lit(' [18/Jan/2013:17:56:07 +1100] "GET /'), kind, F.lit(' HTTP/1.1" 200 '), bytes_,
        F.lit(' "http://a.example/" "agent" rest'),
    )
    line = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("broken "), kind)).otherwise(good)
    return table(spark, folder, "events").select(line.alias("value"))


@query(
    """
    WITH rows AS (
      SELECT event_id % 10 = 3 AS broken, event_type = 'signup' AS anonymous, event_type, user_id, value FROM events)
    SELECT CASE WHEN NOT broken AND NOT anonymous THEN '10.0.0.' || (user_id % 250) END AS ip,
           CASE WHEN NOT broken AND NOT anonymous THEN 'u' || user_id END AS user,
           CASE WHEN NOT broken AND NOT anonymous THEN 'GET /' || event_type || ' HTTP/1.1' END AS query,
           count(*) AS n,
           CAST(sum(CASE WHEN broken OR event_type = 'view' THEN 0 ELSE floor(value) END) AS BIGINT) AS bytes
    FROM rows GROUP BY 1, 2, 3
    """
)
def log_query(spark, folder):
    return summarize_log(web_log_lines(spark, folder))


def app_log_lines(events):
    """Four lines per event: start, configuration, ride configuration and end of one session.

    Sessions of type error lack the ride step; every 50th session has a broken first line.
    """
    event = F.col("event_id")
    at = F.unix_millis(F.col("ts").cast("timestamp"))
    network = F.array(*[F.lit(x) for x in ("2G", "3g", "4G", "WIFI", "lan")])[(F.col("user_id") % 5).cast("int")]
    os = F.when(F.col("user_id") % 2 == 0, "iOS").otherwise("Android")
    def step(offset, action, status):
        return F.struct(
            F.lit(offset).cast("bigint").alias("offset"), F.lit(action).alias("action"), F.lit(status).alias("status")
        )

    steps = F.array(
        step(0, "client.init.start", "1"),
        step(50 + event % 7 * 10, "client.init.getConfigData", "2"),
        step(80 + event % 11 * 10, "client.init.getRideConfig", "1"),
        step(200 + F.floor(F.col("value") * 100), "client.init.done", "1"),
    )
    rows = events.select(
        event, at.alias("at"), network.alias("network"), os.alias("os"), "event_type", "user_id", F.explode(steps).alias("s")
    )
    rows = rows.where(~((F.col("event_type") == "error") & (F.col("s.action") == "client.init.getRideConfig")))
    time = F.date_format(F.timestamp_millis(F.col("at") + F.col("s.offset")), "yyyy-MM-dd HH:mm:ss.SSS")
    body = F.to_json(
        F.struct(
            F.struct(
                event.cast("string").alias("progressKey"),
                F.col("s.action").alias("actionName"),
                F.col("s.status").alias("status"),
                F.concat(F.lit("5."), (F.col("user_id") % 4).cast("string")).alias("appversion"),
                F.col("network"),
                F.col("os").alias("ostype"),
            ).alias("condition")
        )
    )
    broken = (event % 50 == 7) & (F.col("s.action") == "client.init.start")
    body = F.when(broken, F.lit('{"condition":{')).otherwise(body)
    return rows.select(F.concat(F.lit("x,"), time, F.lit(",info,"), body).alias("value"))


LOAD_DELAY_SQL = f"""
WITH steps AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) // 1000 + o.off AS t, o.step AS step
  FROM (SELECT event_id, user_id, event_type, ts,
               unnest([{{'off': 0, 'step': 0}}, {{'off': 50 + event_id % 7 * 10, 'step': 1}},
                       {{'off': 80 + event_id % 11 * 10, 'step': 2}},
                       {{'off': 200 + CAST(floor(value * 100) AS BIGINT), 'step': 3}}]) AS o FROM events)),
kept AS (SELECT * FROM steps WHERE NOT (event_type = 'error' AND step = 2) AND NOT (event_id % 50 = 7 AND step = 0)),
sessions AS (
  SELECT t // 300000 AS w, event_id, any_value(user_id) AS user_id,
         max(t) - min(t) - abs(max(t) FILTER (WHERE step = 1) - max(t) FILTER (WHERE step = 2)) AS duration
  FROM kept GROUP BY 1, 2),
usable AS (
  SELECT w, '5.' || (user_id % 4) AS version, ['2G', '3G/4G', '3G/4G', 'Wifi', '其他'][CAST(user_id % 5 AS INTEGER) + 1] AS network,
         CASE WHEN user_id % 2 = 0 THEN 'ios' ELSE 'android' END AS os, duration
  FROM sessions WHERE duration > 0 AND duration < 60000)
SELECT strftime(make_timestamp(w * 300000000), '%Y-%m-%d %H:%M:%S') AS point_time, version, network, os,
       CAST(sum(duration) AS BIGINT) // count(*) AS "averageTimeByMinute", count(*) AS sessions,
       {', '.join(f'count(*) FILTER (WHERE least(duration // 1000, 10) = {i}) AS "{c}"' for i, c in enumerate(DURATION_COLUMNS))}
FROM usable GROUP BY w, version, network, os"""


@query(LOAD_DELAY_SQL)
def load_delay_histogram(spark, folder):
    histogram = load_delay(app_log_lines(table(spark, folder, "events")))
    return histogram.withColumn("point_time", F.date_format("point_time", "yyyy-MM-dd HH:mm:ss"))


@query(
    """
    WITH steps AS (
      SELECT event_id, event_type, unnest(range(0, 4)) AS step FROM events),
    judged AS (
      SELECT CASE WHEN step = 1 AND event_id % 10 = 3 THEN 'time' WHEN step = 3 AND event_id % 10 = 4 THEN 'text'
                  WHEN step = 0 AND event_id % 50 = 7 THEN 'session' ELSE 'kept' END AS reason
      FROM steps WHERE NOT (event_type = 'error' AND step = 2))
    SELECT reason, count(*) AS n FROM judged GROUP BY reason"""
)
def load_delay_reasons(spark, folder):
    """Kept and rejected log lines by reason, some of them broken on the way here."""
    lines = app_log_lines(table(spark, folder, "events"))
    event = F.regexp_extract("value", '"progressKey":"([0-9]+)"', 1).try_cast("bigint") % 10
    broken = (
        F.when((event == 3) & F.contains("value", F.lit("getConfigData")), F.regexp_replace("value", "^x,", "x,at "))
        .when((event == 4) & F.contains("value", F.lit("client.init.done")), F.substring_index("value", ",{", 1))
        .otherwise(F.col("value"))
    )
    return count_reasons(judge_lines(lines.select(broken.alias("value"))))


METRICS = (
    "Bike.Appointment", "Bike.Outtime.Appointment", "Bike.Cancel.Appointment",
    "Bike.Auto.Cancel.Appointment", "Bike.Ride",
)


def metric_lines(events):
    """One metric line per event; every 40th has a malformed body."""
    metric = F.array(*[F.lit(m) for m in METRICS])[(F.col("event_id") % 5).cast("int")]
    text = lambda c: c.cast("string")
    body = F.to_json(
        F.struct(
            F.struct(
                text(F.col("user_id")).alias("userGuid"),
                F.concat(F.lit("b"), text(F.col("event_id") % 97)).alias("bikeNo"),
                text(F.floor("value")).alias("distance"),
                text(F.col("user_id") % 90).alias("lat"),
                text(F.col("user_id") % 180).alias("lng"),
            ).alias("condition"),
            F.struct(metric.alias("metric")).alias("entityMata"),
        )
    )
    body = F.when(F.col("event_id") % 40 == 9, F.lit('{"condition":{"userGuid":oops}}')).otherwise(body)
    time = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSS")
    return events.select(F.concat(F.lit("INFO,"), time, F.lit(",metric,"), body).alias("value"))


APPOINTMENTS_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS user_guid, 'b' || (event_id % 97) AS bike_no,
       CAST(CAST(floor(value) AS BIGINT) AS VARCHAR) AS distance, CAST(user_id % 90 AS VARCHAR) AS lat,
       CAST(user_id % 180 AS VARCHAR) AS lng, CAST(event_id % 5 AS VARCHAR) AS status,
       strftime(date_trunc('millisecond', ts), '%Y-%m-%d %H:%M:%S.%g') AS create_time, strftime(ts, '%Y%m%d') AS pt
FROM events
WHERE event_id % 5 < 4 AND event_id % 40 <> 9
  AND CAST(ts AS DATE) BETWEEN DATE '{AS_OF}' - 2 AND DATE '{AS_OF}' + 2"""


@query(APPOINTMENTS_SQL)
def appointments_etl(spark, folder):
    path = scratch_path(spark, "appointments")
    append_appointments(appointments(metric_lines(table(spark, folder, "events")), AS_OF), path)
    columns = "user_guid STRING, bike_no STRING, distance STRING, lat STRING, lng STRING, status STRING, create_time STRING, pt STRING"
    return spark.read.schema(columns).parquet(path)
