import datetime as dt

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from candlewick.functions import scalars as S
from candlewick.operators import bars as B
from candlewick.operators import vwap as V
from candlewick.sources.payloads import parse_bar_payloads


def ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, datetime timestamp, close double, volume double")


def at(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def test_resample_of_ticks(spark):
    rows = [("a", at(1, 0, 10), 5.0, 1.0), ("a", at(1, 0, 40), 9.0, 2.0), ("a", at(1, 0, 20), 2.0, 4.0), ("a", at(1, 1), 1.0, 1.0)]
    for unique in (False, True):
        first, second = B.resample(ticks(spark, rows), "hour_1", unique).orderBy("datetime").collect()
        assert tuple(first) == (at(1), "a", 5.0, 9.0, 2.0, 9.0, 7.0)
        assert second["datetime"] == at(1, 1)


def test_resample_of_bars_uses_their_range(spark):
    bars = spark.createDataFrame(
        [("a", at(1), 1.0, 8.0, 0.5, 2.0, 1.0), ("a", at(1, 1), 2.0, 3.0, 1.0, 3.0, 1.0)],
        "symbol string, datetime timestamp, open double, high double, low double, close double, volume double",
    )
    assert tuple(B.resample(bars, "daily").first()) == (at(1), "a", 1.0, 8.0, 0.5, 3.0, 2.0)


def test_resample_ties_do_not_depend_on_order(spark):
    rows = [("a", at(1), 5.0, 1.0), ("a", at(1), 3.0, 1.0)]
    for source in (rows, rows[::-1]):
        bar = B.resample(ticks(spark, source), "daily").first()
        assert (bar["open"], bar["close"]) == (3.0, 5.0)


def test_weeks_start_on_monday(spark):
    bar = B.resample(ticks(spark, [("a", dt.datetime(2026, 1, 18, 5), 1.0, 1.0)]), "weekly").first()
    assert bar["datetime"] == dt.datetime(2026, 1, 12)


def test_unknown_interval():
    with pytest.raises(ValueError):
        B.bar_start("datetime", "hour_7")


def test_week_slice_keeps_both_ends(spark):
    days = [dt.datetime(2026, 1, 11, 23), dt.datetime(2026, 1, 12), dt.datetime(2026, 1, 19), dt.datetime(2026, 1, 19, 1)]
    df = ticks(spark, [("a", day, 1.0, 1.0) for day in days] + [("b", days[1], 1.0, 1.0)])
    rows = B.week_slice(df, "a", "2026-01-18").orderBy("datetime").collect()
    assert [(row["datetime"], row["dow"]) for row in rows] == [(days[1], "Monday"), (days[2], "Monday")]
    assert B.week_slice(df, "a", "2026-01-18", closed="left").count() == 1


def test_week_slice_filter_reaches_the_scan(spark, tmp_path):
    ticks(spark, [("a", at(1), 1.0, 1.0)]).write.parquet(str(tmp_path / "t"))
    plan = B.week_slice(spark.read.parquet(str(tmp_path / "t")), "a", "2024-01-03")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(symbol,a)" in text and "GreaterThanOrEqual(datetime" in text


@pytest.mark.parametrize("n", [3, 1461])
def test_last_n_bars(spark, n):
    df = spark.range(4000).selectExpr("if(id % 4 = 0, 'b', 'a') AS symbol", "timestamp_seconds(id * 25) AS datetime", "id")
    result = B.last_n_bars(df, n)
    assert result.columns == df.columns
    ids = {symbol: [i for i in range(4000) if (i % 4 == 0) == (symbol == "b")][-n:] for symbol in "ab"}
    assert sorted(row["id"] for row in result.collect()) == sorted(ids["a"] + ids["b"])


def test_small_n_is_cut_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("string(id % 2) AS symbol", "timestamp_seconds(id) AS datetime")
    assert "WindowGroupLimit" in B.last_n_bars(df, 5)._jdf.queryExecution().executedPlan().toString()


def test_history_is_one_symbol_oldest_first(spark):
    rows = [(s, at(d), float(d), 1.0) for s in "ab" for d in range(1, 9)]
    assert [row["close"] for row in B.history(ticks(spark, rows), "a", "daily", 3).collect()] == [6.0, 7.0, 8.0]


def test_history_by_exchange_and_contract(spark):
    rows = [("NSE:NIFTY1!", at(1), 1.0, 1.0), ("NSE:NIFTY", at(1), 2.0, 1.0), ("NIFTY", at(1), 3.0, 1.0)]
    close = lambda **names: B.history(ticks(spark, rows), "NIFTY", **names).first()["close"]
    assert (close(exchange="NSE", contract=1), close(exchange="NSE"), close()) == (1.0, 2.0, 3.0)


def test_vwap_values(spark):
    rows = [("a", at(1), 10.0, 1.0), ("a", at(1), 20.0, 3.0), ("z", at(1), 10.0, 0.0), ("n", at(1), 10.0, 1.0), ("n", at(1), None, 9.0)]
    result = {row["symbol"]: row["vwap"] for row in V.vwap(ticks(spark, rows)).collect()}
    assert result == {"a": 17.5, "z": None, "n": 10.0}
    kept = {row["symbol"]: row["vwap"] for row in V.vwap(ticks(spark, rows), keep_unpriced=True).collect()}
    assert kept["n"] == 1.0


def test_sliding_vwap_lies_between_low_and_high(spark):
    rows = [("a", at(1, 0, m), float(m * 7 % 11 + 1), float(m % 3)) for m in range(60)]
    windows = V.vwap_windows(ticks(spark, rows)).collect()
    assert len(windows) == 64
    windows = [window for window in windows if window["vwap"] is not None]
    assert len(windows) == 63  # the first window only holds the first minute, which has no volume
    for window in windows:
        inside = [r[2] for r in rows if window["window_start"] <= r[1] < window["window_end"] and r[3] > 0]
        assert min(inside) - 1e-9 <= window["vwap"] <= max(inside) + 1e-9


@pytest.mark.parametrize("minutes", [5, 30])
def test_sliding_vwap_equals_direct_windows(spark, minutes):
    df = ticks(spark, [("a", at(1, 0, m), float(m), 1.0 + m % 5) for m in range(0, 50, 3)])
    direct = df.groupBy(F.window("datetime", f"{minutes} minutes", "1 minute"), "symbol").agg(
        F.try_divide(F.sum(F.col("close") * F.col("volume")), F.sum("volume")).alias("vwap")
    )
    expected = {(r["window"]["start"], round(r["vwap"], 9)) for r in direct.collect()}
    assert {(r["window_start"], round(r["vwap"], 9)) for r in V.vwap_windows(df, minutes).collect()} == expected


def parsed(spark, raw, **options):
    df = spark.createDataFrame([("x", raw)], "symbol string, raw string")
    return [tuple(row)[2:] for row in parse_bar_payloads(df, **options).orderBy("datetime").collect()]


def payload(*bars):
    return 'head "s":[' + ",".join(f'{{"i":{i},"v":[{bar}]}}' for i, bar in enumerate(bars)) + '],"ns":{}} tail'


def test_payload_volume_stays_zero_after_a_missing_one(spark):
    raw = payload("1700000000.0,1,2,0.5,1.5,100", "1700000060.0,1,2,0.5,1.5", "1700000120.0,1,2,0.5,1.5,50")
    assert [row[-1] for row in parsed(spark, raw)] == [100.0, 0.0, 0.0]
    assert [row[-1] for row in parsed(spark, raw, sticky_volume=False)] == [100.0, 0.0, 50.0]


def test_payload_bad_price_becomes_zero_and_stops_volume(spark):
    raw = payload("1700000000.0,1,2,0.5,1.5,7", "1700000060.0,null,2,0.5,1.5,8", "1700000120.0,1,2,0.5,1.5,9")
    assert parsed(spark, raw) == [(1.0, 2.0, 0.5, 1.5, 7.0), (0.0, 2.0, 0.5, 1.5, 0.0), (1.0, 2.0, 0.5, 1.5, 0.0)]


def test_payload_without_series_gives_no_rows(spark):
    assert parsed(spark, "nothing here") == []


def test_payload_time_is_utc(spark):
    df = spark.createDataFrame([("x", payload("1700000000.0,1,2,3,4,5"))], "symbol string, raw string")
    assert parse_bar_payloads(df).first()["datetime"] == dt.datetime(2023, 11, 14, 22, 13, 20)


def test_symbols(spark):
    rows = [("NIFTY", "NSE", "1"), ("AVAXUSD", "Binance", None), ("A:B", None, None)]
    df = spark.createDataFrame(rows, "symbol string, exchange string, contract string")
    out = [row[0] for row in df.select(S.format_symbol("symbol", "exchange", "contract")).collect()]
    assert out == ["NSE:NIFTY1!", "Binance:AVAXUSD", "A:B"]
    bad = spark.createDataFrame([("N", "E", "1.5")], "symbol string, exchange string, contract string")
    with pytest.raises(Exception, match="not a valid contract"):
        bad.select(S.format_symbol("symbol", "exchange", "contract")).collect()


def test_times(spark):
    df = spark.createDataFrame([(1773055319999, "2026-03-25T15:15:00.000Z")], "ms long, iso string")
    row = df.select(S.ms_to_iso("ms"), S.ms_to_time("ms"), S.iso_to_ms("iso"), S.time_to_iso(S.ms_to_time("ms"))).first()
    assert row[0] == "2026-03-09T11:21:59Z"
    assert row[1] == dt.datetime(2026, 3, 9, 11, 21, 59, 999000)
    assert row[2] == 1774451700000
    assert row[3] == "2026-03-09T11:21:59.999Z"


def test_week_slice_reads_its_week_only(spark):
    from __spark_entry__ import QUERIES

    plan = QUERIES["week_slice"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts,2024-01-08" in plan and "LessThan(ts,2024-01-16" in plan
