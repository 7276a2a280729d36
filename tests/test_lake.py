import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.clean import add_layer_columns
from candlewick.plans.gold import gold, silver
from candlewick.schemas import BAR_SCHEMA
from candlewick.session import work_folder
from candlewick.sources import footers, kafka, lake


@pytest.fixture
def bars(spark):
    times = [dt.datetime(2023, 12, 31, 10, 0, 0, 123456), dt.datetime(2024, 1, 2), dt.datetime(2024, 2, 2), dt.datetime(2031, 2, 2)]
    return spark.createDataFrame([(at, "a", 1.0, 2.0, 0.5, 1.5, 10.0) for at in times], BAR_SCHEMA)


def folders(path):
    return sorted(str(p.relative_to(path)) for p in path.rglob("month=*"))


def test_bronze_folders_and_years(spark, bars, tmp_path):
    lake.write_bronze(bars, str(tmp_path / "b"), "avalanche", years=range(2022, 2027))
    assert folders(tmp_path / "b") == [
        "crypto=avalanche/year=2023/month=12", "crypto=avalanche/year=2024/month=01", "crypto=avalanche/year=2024/month=02",
    ]
    found = lake.read_bronze(spark, str(tmp_path / "b"))
    assert dict(found.dtypes)["month"] == "int" and found.count() == 3
    assert found.agg(F.min("datetime")).first()[0] == dt.datetime(2023, 12, 31, 10, 0, 0, 123456)


def test_layers_from_csv_to_indicators(spark, bars, tmp_path):
    bronze, middle, top = (str(tmp_path / name) for name in ("bronze", "silver", "gold"))
    lake.write_bronze(bars, bronze, "avalanche")
    lake.write_layer(silver(lake.read_bronze(spark, bronze)), middle)
    lake.write_layer(gold(spark.read.parquet(middle)), top)
    table = spark.read.parquet(top)
    assert table.count() == 4
    assert {row["crypto"] for row in table.collect()} == {"avalanche"}
    assert sorted(row["sma_200"] for row in table.collect()) == [1.5] * 4


def test_filters_on_folders_skip_them(spark, bars, tmp_path):
    lake.write_layer(add_layer_columns(bars, "avalanche"), str(tmp_path / "s"))
    plan = spark.read.parquet(str(tmp_path / "s")).filter("year = 2024 AND symbol = 'a'").select("close")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in text and "EqualTo(symbol,a)" in text
    assert "ReadSchema: struct<symbol:string,close:double>" in text


def test_replacing_only_found_folders(spark, bars, tmp_path):
    path = str(tmp_path / "s")
    lake.write_layer(add_layer_columns(bars, "avalanche"), path)
    again = add_layer_columns(bars.filter("month(datetime) = 1"), "avalanche").withColumn("close", F.lit(9.0))
    lake.write_layer(again, path, replace_found_only=True)
    assert sorted(row["close"] for row in spark.read.parquet(path).collect()) == [1.5, 1.5, 1.5, 9.0]


def test_csv_extension_in_any_case_and_nested(spark, tmp_path):
    source = tmp_path / "in put"
    for place, name in (("", "a.csv"), ("x", "b.CSV"), ("x/y", "c.Csv"), ("x", "d.txt"), ("é +z", "100% e.csv")):
        (source / place).mkdir(parents=True, exist_ok=True)
        (source / place / name).write_text("symbol,close\nq,1.5\n")
    assert lake.csv_to_parquet(spark, str(source), str(tmp_path / "out"))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((row["rel_dir"] or "", row["source_file"].rsplit("/", 1)[1]) for row in rows) == [
        ("", "a.csv"), ("x", "b.CSV"), ("x/y", "c.Csv"), ("é +z", "100% e.csv"),
    ]


def test_no_csv_files_means_no_output(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert not lake.csv_to_parquet(spark, str(tmp_path / "in"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_catalog_picks_up_new_folders_only(spark, bars, tmp_path):
    path = str(tmp_path / "layer")
    register = lambda: lake.register_layer(spark, "db1", "bars", path, database_path=str(tmp_path / "db"))
    lake.write_layer(add_layer_columns(bars.filter("year(datetime) = 2024"), "avalanche"), path)
    assert register().count() == 2
    more = add_layer_columns(bars, "avalanche").filter("year <> 2024").withColumn("extra", F.lit(1))
    lake.write_layer(more, path, mode="append")
    assert register().count() == 4
    assert "extra" not in spark.table("db1.bars").columns
    drift = lake.schema_drift(spark, spark.read.option("mergeSchema", True).parquet(path).schema, spark.table("db1.bars").schema)
    assert [tuple(row) for row in drift.collect()] == [("extra", "added", None, "int")]


def test_schema_drift_kinds(spark):
    old = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    new = T.StructType([T.StructField("a", T.LongType()), T.StructField("c", T.StringType())])
    rows = [tuple(row) for row in lake.schema_drift(spark, new, old).collect()]
    assert rows == [("a", "type", "int", "bigint"), ("b", "removed", "string", None), ("c", "added", None, "string")]


def test_work_folder_follows_the_cluster_setting(spark):
    assert work_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert work_folder(spark, "x") != work_folder(spark, "x")


def test_a_cluster_needs_a_shared_work_folder():
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "yarn"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        work_folder(Session(), "x")


def test_kafka_options():
    plain = kafka.connection("host:9092")
    assert plain == {"kafka.bootstrap.servers": "host:9092"}
    secure = kafka.connection("host:9092", "user", "secret")
    assert secure["kafka.security.protocol"] == "SASL_PLAINTEXT" and "secret" in secure["kafka.sasl.jaas.config"]
    assert kafka.stream_options(["a", "b"]) == {"subscribe": "a,b", "startingOffsets": "latest"}
    assert kafka.batch_options("a", [0])["assign"] == '{"a": [0]}'


def test_messages_leave_null_fields_out(spark):
    df = spark.createDataFrame([("k", 1, None)], "key1 string, field1 int, field2 int")
    assert tuple(kafka.to_messages(df, "key1", "t").first()) == ("t", "k", '{"key1":"k","field1":1}')


def test_footers_answer_counts_and_ranges(spark, tmp_path):
    path = str(tmp_path / "layer")
    rows = spark.range(1000).selectExpr("id", "if(id % 3 = 0, NULL, id * 0.5D) AS close", "string(id) AS text", "if(id % 4 = 0, NULL, int(id % 2)) AS part")
    rows.write.partitionBy("part").parquet(path)
    counted = footers.from_footers(spark, path, lambda df: df.groupBy("part").agg(F.count(F.lit(1)).alias("n")))
    assert {row["part"]: row["n"] for row in counted.collect()} == {None: 250, 0: 250, 1: 500}
    profile = {row["column"]: (row["null_count"], row["null_pct"], row["dtype"]) for row in footers.null_profile_files(spark, path, ["part"]).collect()}
    assert profile == {"id": (0, 0.0, "bigint"), "close": (334, 33.4, "double"), "text": (0, 0.0, "string"), "part": (250, 25.0, "int")}
    assert tuple(footers.value_range_files(spark, path, "close").first()) == (0.5, 499.0, 334)
    assert tuple(footers.value_range_files(spark, path, "text").first()) == ("0", "999", 0)
    plan = footers._footer_session(spark).read.parquet(path).agg(F.min("close"), F.count("text"))
    assert footers.reads_footers_only(plan)
    assert not footers.reads_footers_only(plan.sparkSession.read.parquet(path).agg(F.min("text")))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session stays as it is


@pytest.mark.parametrize("values, expected", [([1.0, math.nan, None], (1.0, 1.0, 1)), ([None, None], (None, None, 2)), ([], (None, None, 0)), ([0.0, 2.0], (0.0, 2.0, 0))])
def test_ranges_where_footers_lack_them(spark, tmp_path, values, expected):
    path = str(tmp_path / "odd")
    spark.createDataFrame([(v,) for v in values], "close double").coalesce(1).write.parquet(path)
    assert footers.folder_counts(spark, path).first()["n_rows"] == len(values)
    row = footers.value_range_files(spark, path).first()
    assert tuple(row) == expected and not str(row[0]).startswith("-")
