import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from candlewick.operators import measures as M
from candlewick.operators.vwap import vwap_windows
from candlewick.schemas import VWAP_SCHEMA
from candlewick.sources.kafka import tail_topic
from candlewick.streaming.candles import closed_candles, live_candles, parse_candles
from candlewick.streaming.jobs import drain, late_counts, run_to_files, split_late, vwap_messages, vwap_stream

VALUE = "value string"


def ms(minute):
    return int(dt.datetime(2026, 3, 9, 11, minute, tzinfo=dt.timezone.utc).timestamp() * 1000)


def candle(minute, close, volume, symbol="AVAX"):
    return json.dumps({"symbol": symbol, "@timestamp": "t", "close": close, "volume": volume, "timestamp_ms": ms(minute)})


def drop(folder, number, lines):
    folder.mkdir(exist_ok=True)
    (folder / f"drop{number}.txt").write_text("\n".join(lines) + "\n")


def run(spark, tmp_path):
    stream = spark.readStream.schema(VALUE).text(str(tmp_path / "in"))
    job = vwap_stream(parse_candles(stream))
    query = run_to_files(job, str(tmp_path / "out"), str(tmp_path / "checkpoint"))
    query.awaitTermination()
    rows = spark.read.schema(job.schema).parquet(str(tmp_path / "out")).collect()
    split_late(parse_candles(stream), str(tmp_path / "split"), str(tmp_path / "split-checkpoint")).awaitTermination()
    late = late_counts(spark, str(tmp_path / "split")).agg(F.sum("n_late")).first()[0]
    return {row["window_start"][11:16]: row["vwap"] for row in rows}, len(rows), late


def test_windows_come_once_and_late_rows_are_counted(spark, tmp_path):
    drop(tmp_path / "in", 1, [candle(20, 10.0, 1.0), candle(21, 20.0, 3.0)])
    assert run(spark, tmp_path)[:2] == ({}, 0)
    drop(tmp_path / "in", 2, [candle(28, 30.0, 1.0)])
    expected = {"11:16": 10.0, "11:17": 17.5, "11:18": 17.5, "11:19": 17.5, "11:20": 17.5, "11:21": 20.0}
    assert run(spark, tmp_path) == (expected, 6, 0)
    drop(tmp_path / "in", 3, [candle(21, 99.0, 9.0), candle(26, 5.0, 1.0), "junk"])
    assert run(spark, tmp_path) == (expected, 6, 2)  # both candles lie before 11:27
    assert run(spark, tmp_path) == (expected, 6, 2)  # a restart repeats nothing
    late = spark.read.parquet(str(tmp_path / "split")).filter("late = 1").collect()
    assert sorted((r["close"], r["watermark_ms"]) for r in late) == [(5.0, ms(27)), (99.0, ms(27))]


def test_stream_equals_batch_for_closed_windows(spark, tmp_path):
    rows = [candle(m, float(m % 7 + 1), float(m % 3), s) for m in range(0, 55, 2) for s in ("a", "b")]
    drop(tmp_path / "in", 1, rows)
    run(spark, tmp_path)
    streamed = spark.read.schema(VWAP_SCHEMA).parquet(str(tmp_path / "out"))
    candles = parse_candles(spark.createDataFrame([(row,) for row in rows], VALUE))
    batch = vwap_windows(candles.withColumnRenamed("timestamp", "datetime")).filter("window_end <= '2026-03-09 11:53:00'")
    left = {(r["window_start"][11:16], r["symbol"], r["vwap"]) for r in streamed.collect()}
    assert left == {(r["window_start"].strftime("%H:%M"), r["symbol"], r["vwap"]) for r in batch.collect()}


def test_vwap_message_is_keyed_json(spark):
    vwaps = spark.createDataFrame([("s", "e", "AVAX", 17.5), ("s", "e", "B", None)], VWAP_SCHEMA)
    assert [tuple(row) for row in vwap_messages(vwaps).collect()] == [
        ("AVAX", '{"window_start":"s","window_end":"e","symbol":"AVAX","vwap":17.5}'),
        ("B", '{"window_start":"s","window_end":"e","symbol":"B"}'),
    ]


def raw(spark, *texts):
    return spark.createDataFrame([(text,) for text in texts], VALUE)


def test_closed_and_live_candles(spark):
    kline = {"s": "AVAX", "i": "1m", "c": "10.5", "v": "3", "T": 1773055319999}
    messages = raw(
        spark,
        json.dumps({"k": kline | {"x": True}}),
        json.dumps({"k": kline | {"x": False, "c": "11"}}),
        '{"e":"ping"}',
        "junk",
    )
    assert [tuple(r) for r in closed_candles(messages).collect()] == [
        ("AVAX", "2026-03-09T11:21:59Z", 10.5, 3.0, 1773055319999)
    ]
    assert [tuple(r) for r in live_candles(messages).collect()] == [("1m", "10.5", "3"), ("1m", "11", "3")]


@pytest.fixture
def messages(spark):
    at = dt.datetime(2026, 3, 9, 11, 0)
    rows = [
        ("t1", '{"symbol":"A","close":74240.12,"timestamp_ms":1000}'),
        ("t1", '{"symbol":null,"close":1.5}'),
        ("t1", '{"close":"abc","symbol":"A"}'),
        ("t1", '{"symbol":"A"}'),
        ("t1", ""),
        ("t1", None),
        ("t2", '{"symbol":"A","vwap":2.0,"window_end":"2026-03-25T15:15:00.000Z"}'),
        ("t9", '{"close":1.0}'),
    ]
    return spark.createDataFrame([(t, v, at) for t, v in rows], "topic string, value string, timestamp timestamp")


ROUTES = [M.Route("t1", "quotes", "close"), M.Route("t2", "vwap", "vwap")]


def test_router(messages):
    routed = M.route_measures(messages, ROUTES, version=F.lit(7))
    records = {r["MeasureValue"]: r for r in M.records_of(routed).collect()}
    assert set(records) == {"74240.12", "1.5", "2.0"}
    first = records["74240.12"]
    assert (first["table"], first["MeasureName"], first["Time"], first["Version"]) == ("quotes", "close", "1000", 7)
    assert [tuple(d) for d in first["Dimensions"]] == [("symbol", "A"), ("source_topic", "t1")]
    assert records["1.5"]["Dimensions"][0]["Value"] == "UNKNOWN"
    assert records["1.5"]["Time"] == str(ms(0))
    assert records["2.0"]["Time"] == "1774451700000"
    reasons = sorted(row["reason"] for row in M.rejects_of(routed).collect())
    assert reasons == ["empty or malformed message"] * 2 + ["measure is not a number", "measure missing", "unknown topic"]


def test_router_can_take_the_clock(messages):
    routed = M.records_of(M.route_measures(messages, ROUTES, processing_time=True), "vwap")
    assert int(routed.first()["Time"]) > 1_700_000_000_000


def test_router_config_is_broadcast(messages):
    plan = M.route_measures(messages, ROUTES)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_latest_version_wins(spark):
    df = spark.createDataFrame([(1, 10.0, 100), (2, 11.0, 100), (3, 12.0, 200), (3, 11.0, 200)], "v long, close double, at long")
    records = M.to_measure_records(df, "close", ["at"], F.col("at"), F.col("v"))
    best = {r["Time"]: r["MeasureValue"] for r in M.latest_version(records).collect()}
    assert best == {"100": "11.0", "200": "12.0"}


def test_streaming_router_and_tail(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"topic":"t1","value":"{\\"close\\":1}","key":"k"}\n{"topic":"t2","value":"{}","key":"k"}\n'
    )
    schema = "topic string, value string, key string, partition int, offset long, timestamp timestamp"
    stream = spark.readStream.schema(schema).json(str(tmp_path / "in"))
    routed = drain(M.route_measures(stream, ROUTES), "router", partition_by="table")
    assert sorted(row["table"] for row in routed.collect()) == ["quotes", "rejects"]
    writer = tail_topic(stream, str(tmp_path / "checkpoint"), str(tmp_path / "out"))
    writer.trigger(availableNow=True).start().awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).columns == ["topic", "partition", "offset", "key", "value", "timestamp"]
