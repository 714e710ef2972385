"""Log and file pipelines on hand-made lines."""

import random

import pytest

from tallygraph.plans import appointments, csv_repair, load_delay, log_query


def lines(spark, *text):
    return spark.createDataFrame([(t,) for t in text], "value STRING")


def web(user, size, query="GET /a HTTP/1.1"):
    return f'1.2.3.4 - {user} [18/Jan/2013:17:56:07 +1100] "{query}" 304 {size} "http://r/" "agent" "x" - 0'


def test_log_query(spark):
    df = lines(
        spark, web('"ANN"', "300"), web('"ANN"', "21"), web('"ANN"', "-"), web('"-"', "7"), "no log line",
        web('"ANN"', "5", "GET /b HTTP/1.1"),
    )
    got = {(r["ip"], r["user"], r["query"]): (r["n"], r["bytes"]) for r in log_query.log_query(df).collect()}
    assert got == {
        ("1.2.3.4", '"ANN"', "GET /a HTTP/1.1"): (3, 321),
        ("1.2.3.4", '"ANN"', "GET /b HTTP/1.1"): (1, 5),
        (None, None, None): (2, 7),
    }


def app(key, time, action="start", status="1", network="4G"):
    return (
        f'x,2024-01-01 10:00:{time},i,{{"condition":{{"progressKey":"{key}","actionName":"client.init.{action}",'
        f'"status":"{status}","appversion":"1","network":"{network}","ostype":"IOS"}}}}'
    )


def session(key, last, network="4G"):
    return [
        app(key, "00.000", network=network),
        app(key, "00.300", "getConfigData", "2", network),
        app(key, "00.500", "getRideConfig", "1", network),
        app(key, last, network=network),
    ]


def test_load_delay(spark):
    """Durations are last - first - |config - ride|, here with an advertisement of 200 ms."""
    broken = ["x,not a time,i,{}", "x,2024-01-01 10:00:00.000,i,{broken", "no comma"]
    no_ride = [app("n", "00.000"), app("n", "01.000", "getConfigData", "2")]
    df = lines(
        spark, *session("a", "01.199"), *session("b", "01.200"), *session("c", "10.200"),
        *session("d", "59.000", "lan"), *broken, *no_ride,
    )
    got = {r["network"]: r.asDict() for r in load_delay.load_delay(df).collect()}
    mobile = got["3G/4G"]
    assert (mobile["du1sLow"], mobile["du1To2s"], mobile["du10Over"], mobile["sessions"]) == (1, 1, 1, 3)
    assert mobile["averageTimeByMinute"] == (999 + 1000 + 10000) // 3
    assert got["其他"]["du10Over"] == 1
    assert len(got) == 2
    content = load_delay.as_content(load_delay.load_delay(df)).where("network = '其他'").first()["content"]
    assert '"averageTimeByMinute":58800' in content


def test_load_delay_bounds(spark):
    """Durations of 0 and of a minute do not count."""
    zero = session("z", "00.500")[:3] + [app("z", "00.200")]
    parsed = load_delay.parse_lines(lines(spark, *zero))
    durations = load_delay.session_durations(parsed)
    assert durations.first()["duration"] == 300
    edge = durations.selectExpr("point_time", "version", "network", "os", "explode(array(0L, 1L, 59999L, 60000L)) AS duration")
    assert load_delay.delay_histogram(edge).first()["sessions"] == 2


def metric(day, name="Bike.Appointment", body=None):
    body = body or (
        '{"condition":{"userGuid":"u","bikeNo":"b","distance":1.5,"lat":"2","lng":"3"},"entityMata":{"metric":"%s"}}' % name
    )
    return f"INFO,{day} 08:00:00.123,m,{body}"


def test_appointments(spark):
    df = lines(
        spark,
        *[metric(f"2024-03-{d:02d}") for d in (7, 8, 10, 12, 13)],
        metric("2024-03-10", "Bike.Auto.Cancel.Appointment"),
        metric("2024-03-10", "Bike.Ride"),
        metric("2024-03-10", body='{"condition":{oops}'),
        "INFO,no time,m," + metric("2024-03-10").split("m,", 1)[1],
        metric("2024-13-10"),
    )
    got = appointments.appointments(df, "2024-03-10").collect()
    assert sorted((r["pt"], r["status"]) for r in got) == [
        ("20240308", "0"), ("20240310", "0"), ("20240310", "3"), ("20240312", "0"),
    ]
    assert got[0].asDict() == {
        "user_guid": "u", "bike_no": "b", "distance": "1.5", "lat": "2", "lng": "3", "status": "0",
        "create_time": "2024-03-08 08:00:00.123", "pt": "20240308",
    }


def test_appointments_table(spark, tmp_path):
    rows = appointments.appointments(lines(spark, metric("2024-03-10")), "2024-03-10")
    for _ in range(2):
        appointments.append_appointments(rows, f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 2
    assert (tmp_path / "t" / "pt=20240310").is_dir()


def test_csv_repair(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "my file.csv").write_text('k,v\n"x\ny\nz",1\n"a",2\n3,"b"\n')
    got = csv_repair.read_repaired(spark, f"{tmp_path}/in").collect()
    assert sorted(tuple(r) for r in got) == [("3", "b"), ("a", "2"), ("xyz", "1")]
    csv_repair.repair(spark, f"{tmp_path}/in", f"{tmp_path}/out")
    back = spark.read.option("header", True).csv(f"{tmp_path}/out")
    assert back.columns == ["k", "v", "source"]
    assert {r["source"] for r in back.collect()} == {"my file.csv"}
    text = "".join(p.read_text() for p in (tmp_path / "out").rglob("part-*"))
    assert sorted(text.split()) == ["3,b", "a,2", "k,v", "xyz,1"]


def _one_pass(text):
    """Records of a text by a walk over its characters; one with a field never closed keeps its lines."""
    records, current, inside = [], "", False
    for char in text:
        inside ^= char == '"'
        if char == "\n" and not inside:
            records.append(current.replace("\n", ""))
            current = ""
        else:
            current += char
    return [r for r in records + current.split("\n") if r]


@pytest.mark.parametrize("piece_bytes, closed", [(800, True), (900, False), (100_000, False)])
def test_csv_repair_over_piece_borders(spark, tmp_path, piece_bytes, closed):
    """Fields with breaks at, over and far beyond the borders of pieces; also a field never closed."""
    rng = random.Random(piece_bytes)
    (tmp_path / "in").mkdir()
    want = {}
    for name in ("a", "b c"):
        rows = []
        for i in range(80):
            broken = "".join(rng.choice(["x", "\n", '""', ",", "yz", "é"]) for _ in range(rng.choice([0, 3, 30, 2000 if i % 20 == 3 else 90])))
            rows.append(f'{name}{i},"{broken}",{i}' if rng.random() < 0.6 else f"{name}{i},plain,{i}")
        text = "\n".join(rows) + "\n" + ("" if closed else 'end,"never\n""closed""\n\n' + "here,1\n" * 400)
        (tmp_path / "in" / f"{name}.csv").write_text(text)
        want[f"{name}.csv"] = _one_pass(text)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    opening = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(piece_bytes))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        found = csv_repair.repaired_lines(spark, f"{tmp_path}/in").where("value <> ''")
        lines = found.orderBy("source", "piece", "place").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", opening)
    got = {name: [r["value"] for r in lines if r["source"].endswith("/" + name)] for name in want}
    assert got == want
    if piece_bytes < 1000:
        assert len({(r["source"], r["piece"]) for r in lines}) > 10


def test_csv_repair_without_header_or_rows(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text('1;"x\r\ny"\n\n2;""\n3;\n')
    got = csv_repair.read_repaired(spark, f"{tmp_path}/in", header=False, sep=";")
    assert sorted(tuple(r) for r in got.collect()) == [("1", "xy"), ("2", None), ("3", None)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "a.csv").write_text("")
    assert csv_repair.read_repaired(spark, f"{tmp_path}/none").count() == 0


def test_parsing_evaluates_a_line_once(spark):
    df = lines(spark, app("a", "00.000")).repartition(2)
    plan = load_delay.parse_lines(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") + plan.count("jsontostructs") == 1


@pytest.mark.parametrize("name", ["load_delay_histogram", "log_query", "appointments_etl", "group_relation", "group_detection"])
def test_no_row_at_a_time_python(spark, name):
    from tallygraph.queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan
    assert "CartesianProduct" not in plan
    assert "NestedLoop" not in plan
