"""Sources, writers, relational operators and functions on small known tables."""

import math

import pytest
from pyspark.sql import functions as F

from tallygraph.functions import aggregates, scalar
from tallygraph.operators import layout, lists, relational, skew
from tallygraph.sources import avro, files, hive, jdbc, streams, writers

PEOPLE = [("Ines", None), ("Bode", 41), ("Tilda", 17)]


@pytest.fixture
def people(spark):
    return spark.createDataFrame(PEOPLE, "name STRING, age BIGINT")


def test_people_selects(people, rows):
    assert rows(people.select("name", (F.col("age") + 1).alias("a"))) == [("Bode", 42), ("Ines", None), ("Tilda", 18)]
    assert rows(people.where("age > 30")) == [("Bode", 41)]
    assert rows(people.groupBy("age").count()) == [(17, 1), (41, 1), (None, 1)]
    assert rows(people.where(F.col("age").between(11, 17)).select("name")) == [("Tilda",)]


def test_json_and_csv_people(spark, people, rows, tmp_path):
    people.write.json(f"{tmp_path}/json")
    read = files.read_json(spark, f"{tmp_path}/json")
    assert read.columns == ["age", "name"]
    assert rows(read, "name", "age") == sorted(PEOPLE, key=repr)
    people.write.options(sep=";", header=True).csv(f"{tmp_path}/csv")
    read = files.read_csv(spark, f"{tmp_path}/csv", sep=";")
    assert read.schema["age"].dataType.simpleString() == "int"
    assert rows(read) == sorted(PEOPLE, key=repr)


def test_nested_json(spark, rows):
    text = '{"name":"Yin","address":{"city":"Columbus","state":"Ohio"}}'
    df = spark.createDataFrame([(text,), ("{broken",)], "line STRING")
    parsed = files.parse_json(df, "line", files.schema_of_example(text))
    assert rows(parsed.select("parsed.name", "parsed.address.city")) == [("Yin", "Columbus"), (None, None)]


def test_merge_schema(spark, tmp_path):
    spark.range(1, 6).selectExpr("id AS value", "id * id AS square").write.parquet(f"{tmp_path}/key=1")
    spark.range(6, 11).selectExpr("id AS value", "id * id * id AS cube").write.parquet(f"{tmp_path}/key=2")
    merged = files.read_parquet(spark, str(tmp_path), merge_schema=True)
    assert merged.columns == ["value", "square", "cube", "key"]
    assert merged.where("key = 2 AND square IS NULL AND cube IS NOT NULL").count() == 5


def test_save_modes(spark, people, tmp_path):
    path = f"{tmp_path}/people"
    writers.write_parquet(people, path)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        writers.write_parquet(people, path)
    writers.write_parquet(people, path, "append")
    assert files.read_default(spark, path).count() == 6
    writers.write_parquet(people, path, "overwrite", partition_by="name")
    assert files.query_file(spark, path).columns == ["age", "name"]


def test_single_text_file(spark, people, tmp_path):
    writers.write_lines(people.select("name"), f"{tmp_path}/one", single_file=True)
    assert len(list((tmp_path / "one").glob("part-*"))) == 1


def test_text_layouts(spark, rows, tmp_path):
    def lines(name, *text):
        (tmp_path / name).write_text("\n".join(text) + "\n")
        return files.read_lines(spark, f"{tmp_path}/{name}")

    assert rows(files.split_columns(lines("p", "Ines, 29", "Bode, x"), [("name", "string"), ("age", "int")])) == [
        ("Bode", None),
        ("Ines", 29),
    ]
    assert rows(files.keyed_attributes(lines("u", "1,bo,Bo Lee", "3,ann"))) == [(1, ["bo", "Bo Lee"]), (3, ["ann"])]
    assert rows(files.vectors(lines("v", "1.0 2.5"))) == [([1.0, 2.5],)]
    assert rows(files.labelled_points(lines("l", "-1 0.5 2"))) == [(-1.0, [0.5, 2.0])]


def test_source_files(spark, tmp_path, rows):
    for name in ("a b.txt", "skip_me.txt"):
        (tmp_path / name).write_text("x\ny\n")
    found = files.source_files(spark.read.text(str(tmp_path)), excluded=["skip"])
    assert [(p.rsplit("/", 1)[1], n) for p, n in rows(found)] == [("a b.txt", 2)]


def test_bucketed_join_has_no_shuffle(spark, tmp_path):
    for name in ("left_b", "right_b"):
        writers.drop_table(spark, name)
        writers.save_table(
            spark.range(1000).selectExpr("id", "id * 2 AS v"), name, bucket_by="id", buckets=4, sort_by="id",
            path=f"{tmp_path}/{name}",
        )
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = spark.table("left_b").join(spark.table("right_b"), "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert "SortMergeJoin" in plan
    assert "Exchange" not in plan


def test_partitioned_table_and_drop(spark, people, tmp_path):
    writers.drop_table(spark, "people_by_age")
    writers.save_table(people, "people_by_age", partition_by="age", path=f"{tmp_path}/t")
    assert spark.table("people_by_age").columns[-1] == "age"
    writers.drop_table(spark, "people_by_age")
    assert not spark.catalog.tableExists("people_by_age")


def test_global_view_is_shared(spark, people):
    name = writers.create_view(people, "everyone", shared=True)
    assert spark.newSession().sql(f"SELECT * FROM {name}").count() == 3


class Recorder:
    """Stands in for a session: this container may not start the metastore's database."""

    def __init__(self):
        self.statements = []

    def sql(self, text):
        self.statements.append(text)


def test_hive_statements_parse(spark):
    recorder = Recorder()
    hive.create_text_table(recorder, "src", "key INT, value STRING")
    hive.load_file(recorder, "src", "/data/kv.txt")
    hive.create_parquet_table(recorder, "records", "key INT, value STRING")
    hive.create_external_table(recorder, "ids", "key BIGINT", "/data/ids")
    parser = spark._jsparkSession.sessionState().sqlParser()
    for statement in recorder.statements:
        parser.parsePlan(statement)
    assert len(recorder.statements) == 4


def test_jdbc_options():
    """Options only: no database may be started here."""
    got = jdbc.read_options("jdbc:x", "t", {"user": "u"}, "id DECIMAL(38, 0)", "id", ("0", "100"), 8)
    assert got == {
        "url": "jdbc:x", "dbtable": "t", "user": "u", "customSchema": "id DECIMAL(38, 0)",
        "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "8",
    }
    assert jdbc.write_options("jdbc:x", "t", None, "name CHAR(64)", 4)["createTableColumnTypes"] == "name CHAR(64)"


def test_kafka_options():
    got = streams.kafka_options("h:1", "subscribe", "a,b", "g", max_offsets_per_trigger=5000,
                                security={"security.protocol": "SASL_PLAINTEXT"})
    assert got["subscribe"] == "a,b"
    assert got["maxOffsetsPerTrigger"] == "5000"
    assert got["kafka.security.protocol"] == "SASL_PLAINTEXT"
    with pytest.raises(ValueError):
        streams.kafka_options("h:1", "follow", "a")


def test_avro_records_as_maps(spark):
    df = spark.createDataFrame([("a", 1, None)], "name STRING, n INT, missing STRING")
    assert avro.as_maps(df).first()["record"] == {"name": '"a"', "n": "1"}


def test_value_replacement_leaves_others(spark, rows):
    df = spark.createDataFrame([(1,), (2,), (3,), (7,)], "flag INT")
    assert rows(df.replace(scalar.GOOD_FLAG, subset=["flag"])) == [(0,), (0,), (1,), (7,)]


def test_networks_and_status(spark):
    df = spark.createDataFrame([("2G",), ("4g",), ("WIFI",), ("x",), (None,)], "n STRING")
    assert [r[0] for r in df.select(scalar.network_label(F.col("n"))).collect()] == ["2G", "3G/4G", "Wifi", "其他", "其他"]
    metrics = spark.createDataFrame([("Bike.Cancel.Appointment",), ("other",)], "m STRING")
    assert [r[0] for r in metrics.select(scalar.appointment_status(F.col("m"))).collect()] == ["2", None]


def test_epochs(spark):
    df = spark.createDataFrame([(1500000000,), (1500000000123,)], "e BIGINT")
    got = df.select(scalar.epoch_millis(F.col("e")), scalar.epoch_date(F.col("e")).cast("string")).collect()
    assert [tuple(r) for r in got] == [(1500000000000, "2017-07-14"), (1500000000123, "2017-07-14")]


def test_rounding_half_up(spark):
    df = spark.createDataFrame([(0.285,), (-0.285,)], "x DOUBLE")
    assert [r[0] for r in df.select(scalar.rounded(F.col("x"))).collect()] == [0.29, -0.29]


def test_group_rates_round_half_up(spark, rows):
    df = spark.createDataFrame([("g", 1)] + [("g", 0)] * 7, "k STRING, flag INT")  # 0.125
    assert rows(relational.group_rates(df, ["k"], "flag")) == [("g", 0.13, 0.88, 8)]


def test_averages_agree(spark):
    data = [(1, 1200.0), (1, 1900.0), (1, 2600.0), (1, None), (2, None)]
    df = spark.createDataFrame(data, "k INT, salary DOUBLE")
    aggregates.register_average(spark)
    aggregates.average_partials(df, ["k"], "salary").createOrReplaceTempView("partials")
    for frame in (
        spark.sql("SELECT k, my_average(sum, count) AS a FROM partials GROUP BY k"),
        df.groupBy("k").agg(aggregates.average(F.col("salary")).alias("a")),
        aggregates.typed_average(df, ["k"], "salary").select("k", F.col("average").alias("a")),
    ):
        got = {r["k"]: r["a"] for r in frame.collect()}
        assert got[1] == 1900.0
        assert math.isnan(got[2])


def test_semi_join_does_not_multiply(spark, people):
    keys = spark.createDataFrame([("Bode",), ("Bode",)], "name STRING")
    assert relational.restrict_to(people, keys, "name").count() == 1


def test_right_join_keeps_the_lookup(spark, rows):
    small = spark.range(5).withColumnRenamed("id", "a")
    big = spark.range(100).withColumnRenamed("id", "b")
    joined = relational.right_join_lookup(small, big, F.col("a") == F.col("b"))
    assert rows(joined.where("b < 7")) == [(0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (None, 5), (None, 6)]
    assert joined.count() == 100


def test_grouped_items_have_one_shape(spark, rows):
    data = [("hot", i % 40, 1) for i in range(400)] + [("cold", 7, 95), ("cold", 3, 1), ("cold", 4, 0)]
    df = spark.createDataFrame(data, "k STRING, v INT, n BIGINT")
    got = rows(lists.grouped_items(df, ["k"], "v", times="n"))
    assert got == sorted([("hot", v, 10) for v in range(40)] + [("cold", 3, 1), ("cold", 7, 95)], key=repr)
    assert rows(lists.grouped_items(df.where("k = 'cold'"), ["k"], "v")) == [("cold", 3, 1), ("cold", 4, 1), ("cold", 7, 1)]


def test_buckets_follow_the_size(spark):
    df = spark.range(1000)
    assert writers.bucket_count(df) == 1
    assert writers.bucket_count(df, spark.range(10), bytes_each=1000) == 8


def test_buckets_follow_the_rows_of_compressed_files(spark, tmp_path):
    spark.range(200_000).selectExpr("id DIV 100000 AS k").write.parquet(f"{tmp_path}/k")
    assert writers.bucket_count(spark.read.parquet(f"{tmp_path}/k"), bytes_each=100_000) == 16


def test_release_leaves_other_applications_alone(spark):
    from pathlib import Path

    from tallygraph import storage

    own = Path(storage.scratch_path(spark, "own").removeprefix("file:"))
    other = own.parent.parent / "app-of-another-session"
    other.mkdir(parents=True)
    kept = storage.materialize(spark.range(3), "kept")
    assert kept.count() == 3 and own.parent.exists()
    storage.release(spark)
    assert other.exists() and not own.parent.exists()


def test_salted_equals_plain(spark, rows):
    df = spark.range(3000).selectExpr("IF(id % 3 = 0, 0, id) AS k", "id AS v")
    plain = df.groupBy("k").agg(F.sum("v").alias("s"), F.count("v").alias("n"))
    salted = skew.salted_aggregate(
        df, ["k"], {"s": F.sum("v"), "n": F.count("v")}, {"s": F.sum("s"), "n": F.sum("n")}, salts=8
    )
    assert rows(salted) == rows(plain)
    right = spark.range(0, 3000, 2).selectExpr("id AS k", "id * 10 AS w")
    for how, hot_rows in (("inner", 100), ("left", 100), ("left", None)):
        got = skew.salted_join(df, right, "k", hot_rows, salts=8, how=how)
        assert rows(got, "k", "v", "w") == rows(df.join(right, "k", how), "k", "v", "w")


def test_heavy_keys_of_one_pass(spark, rows):
    """Every key above the share is found among many light ones, and rows are computed once."""
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            runs.add(batch.num_rows)
            yield batch

    heavy = {1: 9000, 2: 4500, 3: 2500}
    df = spark.range(34_000).selectExpr(
        "CASE WHEN id < 9000 THEN 1L WHEN id < 13500 THEN 2L WHEN id < 16000 THEN 3L WHEN id < 20000 THEN NULL ELSE id END AS k", "id AS v"
    ).repartition(6).mapInArrow(count, "k BIGINT, v BIGINT")
    written, found = skew.heavy_keys(df, "k", 1 / 16)
    assert runs.value == 34_000 and written.count() == 34_000
    got = dict(rows(found))
    assert set(got) == set(heavy)
    assert all(abs(got[k] - n) <= 34_000 / 16 / 9 for k, n in heavy.items())
    empty, none = skew.heavy_keys(df.limit(0), "k", 1 / 16)
    assert empty.count() == none.count() == 0


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_keys_of_text_and_none(spark, rows, how):
    """A third of the rows has one key, a third has none: both are spread, and no row is lost."""
    df = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE CAST(id AS STRING) END AS k", "id AS v")
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("5", 3), (None, 4)], "k STRING, w INT")
    got = skew.salted_join(df, right, "k", how=how)
    assert rows(got, "k", "v", "w") == rows(df.join(right, "k", how), "k", "v", "w")
    if how == "left":
        # Partitions as small as these would be put together again.
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            spread = skew.salted_join(df, right.hint("shuffle_hash"), "k", how=how)
            places = spread.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()
        finally:
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        assert len(places) > 1 and max(r["count"] for r in places) < 2000
    assert skew.salted_join(df.limit(0), right, "k", how=how).count() == 0


def test_layouts(spark):
    df = spark.range(100).selectExpr("id", "id % 5 AS k")
    assert layout.partition_by_key(df, "k", 6).rdd.getNumPartitions() == 6
    ruled = layout.partition_by_rule(df, F.col("k") + 1, 4).withColumn("p", F.spark_partition_id())
    assert {(r["k"], r["p"]) for r in ruled.select("k", "p").distinct().collect()} == {(k, (k + 1) % 4) for k in range(5)}
