import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL, values
from pyspark.sql import functions as F

from candlewick import views
from candlewick.operators import indicators as I
from candlewick.operators.clean import dedup_bars
from candlewick.operators.ordering import own_rows, spread_to_blocks, with_position
from candlewick.plans.gold import gold


def recursion(closes, alpha):
    """Plain exponential mean with normalised weights; a missing value only adds its weight."""
    base, total, weight, out = 1 - alpha, 0.0, 0.0, []
    for close in closes:
        total = total * base + (0.0 if close is None else close)
        weight = weight * base + 1
        out.append(total / weight)
    return np.array(out)


def test_sma_starts_with_partial_means(series):
    assert values(I.sma(series([1, 2, 3]), n=200), "sma_200") == [1.0, 1.5, 2.0]


def test_sma_can_wait_for_enough_rows(series):
    assert values(I.sma(series([1, 2, 3]), n=2, out="m", min_rows=2), "m") == [None, 1.5, 2.5]


@pytest.mark.parametrize("n", [1, 2, 3, 16, 17, 200, 1500])
def test_sma_equals_rolling_mean_with_gaps(series, n):
    rng = np.random.default_rng(n)
    closes = [None if rng.random() < 0.2 else float(v) for v in rng.uniform(1, 9, 3000)]
    result = I.sma(series(closes), n=n, out="m")
    expected = pd.Series(closes, dtype=float).rolling(n, min_periods=1).mean()
    assert np.allclose(np.array(values(result, "m"), dtype=float), expected, equal_nan=True)


@pytest.mark.parametrize("size", [10, 64])
def test_trailing_mean_does_not_depend_on_block_size(series, size):
    closes = [1e15, *np.random.default_rng(4).uniform(1, 9, 300)]
    rows = spread_to_blocks(with_position(series(closes).withColumnRenamed("close", "_x")), size, 29)
    means = own_rows(I._with_trailing_mean(rows, ["symbol"], "datetime", 30, "m"), size)
    expected = [np.mean(closes[max(0, i - 29) : i + 1]) for i in range(301)]
    assert np.allclose(values(means, "m"), expected, rtol=1e-14)


def test_ema_of_constant_is_constant(series):
    result = values(I.ema(series([5] * 20_100), span=9), "ema_9")
    assert all(math.isclose(value, 5.0, rel_tol=1e-12) for value in result)


@pytest.mark.parametrize("span", [2, 9, 50, 2000])
def test_ema_equals_recursion_on_long_series(series, span):
    closes = np.random.default_rng(span).uniform(1, 200, 20_000)
    result = np.array(values(I.ema(series(closes), span=span, out="e"), "e"))
    assert np.abs(result - recursion(closes, 2 / (span + 1))).max() < 1e-9


def test_ema_null_counts_in_the_weights_only(series):
    closes = [None, 4.0, None, 8.0]
    result = values(I.ema(series(closes), span=3, out="e"), "e")
    assert result[0] is None
    assert np.allclose(result[1:], recursion(closes, 0.5)[1:])


def test_ema_with_all_weight_on_newest_row(series):
    assert values(I.ema(series([3, 1, 2]), alpha=1, out="e"), "e") == [3.0, 1.0, 2.0]


@pytest.mark.parametrize("size", [1, 7, 64, 5000])
def test_block_size_does_not_change_the_ema(series, size):
    closes = list(np.random.default_rng(1).uniform(1, 9, 300))
    series_frame = series(closes).withColumnRenamed("close", "_x")
    rows = spread_to_blocks(with_position(series_frame), size)
    means = I._smooth(rows, ["symbol"], "datetime", size, [I.Smoothing("_x", 0.2, "e")])
    assert np.allclose(values(means, "e"), recursion(closes, 0.2), atol=1e-11)


@pytest.mark.parametrize("size", [1, 5, 50])
def test_macd_signal_does_not_depend_on_block_size(series, size):
    closes = np.random.default_rng(2).uniform(1, 9, 200)
    rows = spread_to_blocks(with_position(series(closes).withColumnRenamed("close", "_x")), size)
    lines = [I.Smoothing("_x", 2 / 13, "_fast"), I.Smoothing("_x", 2 / 27, "_slow")]
    means = I._smooth(rows, ["symbol"], "datetime", size, lines, 0.2)
    macd = recursion(closes, 2 / 13) - recursion(closes, 2 / 27)
    assert np.allclose(values(means, "macd"), macd, atol=1e-11)
    assert np.allclose(values(means, "_signal"), recursion(macd, 0.2), atol=1e-11)


def test_rsi_is_null_until_the_first_loss(series):
    frame = series([10, 11, 12, 11, 13, 13])
    result = values(I.rsi(frame, period=14), "rsi_14")
    assert result[:3] == [None, None, None]
    assert np.allclose(result[3:], [64.16819, 79.77617, 79.77617], atol=1e-5)
    assert values(I.rsi(frame, no_loss=100.0), "rsi_14")[:3] == [100.0] * 3


def test_positions_and_copies_across_blocks(series):
    placed = with_position(series(range(1000)), grain_micros=7 * 60_000_000)
    assert values(placed, "_pos") == list(range(1000))
    spread = spread_to_blocks(placed, 10, 25)
    assert own_rows(spread, 10).count() == 1000
    seen = {(row["_block"], row["_pos"]) for row in spread.collect()}
    assert seen == {(b, p) for p in range(1000) for b in range(p // 10, (p + 25) // 10 + 1)}


def test_positions_before_1970(series):
    placed = with_position(series(range(300), start=dt.datetime(1969, 12, 31, 22, 0)))
    assert values(placed, "_pos") == list(range(300))


def test_gold_equals_plain_computation(spark):
    ticks = views.ticks(spark, SMALL).withColumns({name: F.col("close") for name in ("open", "high", "low")})
    table = gold(ticks.drop("event_id"), crypto="x").toPandas().sort_values(["symbol", "datetime"])
    assert list(table.columns[-3:]) == ["year", "month", "crypto"]
    for _, rows in table.groupby("symbol"):
        closes = rows["close"].to_numpy()
        macd = recursion(closes, 2 / 13) - recursion(closes, 2 / 27)
        signal = recursion(macd, 0.2)
        move = np.diff(closes, prepend=closes[0])
        gain, loss = recursion(np.maximum(move, 0), 1 / 14), recursion(np.maximum(-move, 0), 1 / 14)
        with np.errstate(all="ignore"):
            rsi = np.where(loss == 0, np.nan, 100 - 100 / (1 + gain / loss))
        sma = pd.Series(closes).rolling(200, min_periods=1).mean()
        for column, expected in {
            "sma_200": sma, "ema_50": recursion(closes, 2 / 51), "rsi_14": rsi, "macd": macd,
            "macd_signal": signal, "macd_hist": macd - signal,
        }.items():
            assert np.allclose(rows[column].to_numpy(), np.asarray(expected), atol=1e-9, equal_nan=True), column
        known = rows["rsi_14"].dropna()
        assert known.between(0, 100).all()


def test_gold_drops_incomplete_rows_and_merges_copies(spark):
    at = "2024-01-01 00:00:0"
    rows = [(at + "1", "a", "5"), (at + "1", "a", "7"), (at + "2", "a", "bad"), (at + "3", None, "1"), (None, "a", "1")]
    bars = spark.createDataFrame(rows, "datetime string, symbol string, close string")
    for name in ("open", "high", "low", "volume"):
        bars = bars.withColumn(name, F.lit("1"))
    table = gold(bars).collect()
    assert [(row["close"], row["ema_50"]) for row in table] == [(7.0, 7.0)]


def test_rows_without_key_stay_without_result(spark):
    frame = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1), 2.0), (None, dt.datetime(2024, 1, 1), 3.0)],
        "symbol string, datetime timestamp, close double",
    )
    assert {(r["symbol"], r["sma_200"]) for r in I.sma(frame).collect()} == {("a", 2.0), (None, None)}


def test_dedup_is_independent_of_row_order(spark):
    rows = [("a", 1, 5.0, 1.0), ("a", 1, 5.0, 3.0), ("a", 1, 4.0, 9.0), ("b", 1, None, 2.0)]
    columns = "symbol string, datetime int, close double, volume double"
    one = dedup_bars(spark.createDataFrame(rows, columns)).collect()
    two = dedup_bars(spark.createDataFrame(rows[::-1], columns)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two)) == [("a", 1, 5.0, 3.0), ("b", 1, None, 2.0)]


def test_long_average_in_the_indicator_table(series):
    closes = np.random.default_rng(9).uniform(1, 9, 3000)
    table = I.all_indicators(series(closes), I.GoldPeriods(sma=1200))
    assert table.columns == ["symbol", "datetime", "close", *I.GoldPeriods(sma=1200).outputs]
    assert np.allclose(values(table, "sma_1200"), pd.Series(closes).rolling(1200, min_periods=1).mean())
    assert np.allclose(values(table, "ema_50"), recursion(closes, 2 / 51))


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_window_gathers_a_whole_symbol_of_rows(spark):
    """Only the per-minute counts are ordered per symbol; row windows are per minute or per block."""
    plan = final_plan(gold(views.bars(spark, SMALL, "hour_1"), unique=True))
    specs = [line for line in plan.splitlines() if "windowspecdefinition(symbol" in line]
    assert specs
    for line in specs:
        assert "_rows" in line or "_grain" in line.split("windowspecdefinition(", 1)[1][:40] or "_block" in line


def test_rows_are_shuffled_once_for_all_row_windows(spark, tmp_path):
    """Merging copies happens once for all branches, and the block sums reuse the rows' shuffle."""
    bars = views.ticks(spark, SMALL).withColumns({name: F.col("close") for name in ("open", "high", "low")})
    bars.drop("event_id").write.parquet(str(tmp_path / "bars"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = final_plan(gold(spark.read.parquet(str(tmp_path / "bars")))).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("ReusedExchange") >= 2
    assert plan.count("FileScan") == 2
    assert "IsNotNull(datetime)" in plan and "IsNotNull(symbol)" in plan
    by_block = [line for line in plan.splitlines() if "Exchange hashpartitioning(symbol" in line and "_block" in line]
    # The rows once; all others have one row per block: sums, signals, and the RSI at the blocks' ends.
    assert len([line for line in by_block if "Reused" not in line]) <= 7


def test_rsi_holds_its_value_through_flat_stretches(spark, series):
    """One loss, one gain, 13,000 rows without a move, then a gain: the averages are long below the smallest double."""
    bars = series([100.0, 90.0, 95.0, *[95.0] * 13_000, 96.0, 96.0])
    found = values(I.rsi(bars, "close", 14), "rsi_14")
    assert found[:2] == [None, 0.0] and found[2] is not None
    assert all(v == pytest.approx(found[2], abs=1e-9) for v in found[2:13_003])
    assert found[13_003:] == [100.0, 100.0]
    gold = values(I.all_indicators(bars), "rsi_14")
    assert gold == pytest.approx(found, nan_ok=True, abs=1e-9) or all((a is None and b is None) or abs(a - b) < 1e-9 for a, b in zip(gold, found))


def test_rows_of_one_time_stay(spark):
    rows = [(i, "a", dt.datetime(2024, 1, 1, 0, i // 2), float(i)) for i in range(6)] + [(9, "a", None, 1.0), (10, None, dt.datetime(2024, 1, 1), 1.0)]
    df = spark.createDataFrame(rows, "n int, symbol string, datetime timestamp, close double")
    for result in (I.sma(df, "close", 3), I.ema(df, "close", span=3), I.rsi(df, "close", 3), I.macd(df), I.all_indicators(df)):
        assert sorted(r["n"] for r in result.collect()) == [0, 1, 2, 3, 4, 5, 9, 10]
    means = {r["n"]: r["sma_3"] for r in I.sma(df, "close", 3).collect()}
    assert means == {0: 0.0, 1: 0.5, 2: 1.0, 3: 2.0, 4: 3.0, 5: 4.0, 9: None, 10: None}
