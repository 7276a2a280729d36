"""Splits, sessions, gaps as runs, delivery with errors, corrected windows, kept tables."""

import datetime as dt
import math
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from candlewick.functions.scalars import number_text
from candlewick.operators.adjust import adjust_for_splits
from candlewick.operators.bars import history
from candlewick.operators.continued import IndicatorStore
from candlewick.operators.indicators import GoldPeriods, all_indicators
from candlewick.operators.kept_stats import DescribeStore
from candlewick.operators.quality import describe_by, gap_intervals, missing_days
from candlewick.operators.sessions import Session, in_sessions, session_calendar
from candlewick.sources.versioned import VersionedTable
from candlewick.streaming.corrections import correct_vwap, corrected, versions
from candlewick.streaming.delivery import Delivery, folder_writer

DAY = dt.datetime(2024, 3, 8)


def at(hours):
    return DAY + dt.timedelta(hours=hours)


def test_splits_apply_to_earlier_rows_only(spark):
    rows = spark.createDataFrame(
        [("a", at(h), 8.0, 10.0, "x") for h in (0, 5, 6, 30, 80)] + [("b", at(1), 8.0, 1.0, "y"), (None, at(1), 8.0, 1.0, "n"), ("a", None, 8.0, 1.0, "n")],
        "symbol string, datetime timestamp, close double, volume double, factor string",
    )
    splits = [("a", at(6), 2.0), ("a", at(6), 2.0), ("a", at(40), 4.0), ("a", at(50), 0.5), ("a", at(60), 0.0), ("a", None, 3.0), ("a", at(7), math.nan), ("c", at(9), 9.0), (None, at(9), 9.0)]
    done = adjust_for_splits(rows, spark.createDataFrame(splits, "symbol string, effective timestamp, factor double"))
    assert done.columns == rows.columns
    own = done.filter("symbol = 'a' AND datetime IS NOT NULL")
    assert values(own, "close") == [2.0, 2.0, 4.0, 4.0, 8.0]
    assert values(own, "volume") == [40.0, 40.0, 20.0, 20.0, 10.0]
    assert sorted(r["close"] for r in done.filter("symbol IS NULL OR symbol = 'b' OR datetime IS NULL").collect()) == [8.0] * 3


def test_no_splits(spark):
    rows = spark.createDataFrame([("a", at(0), 1.0, 2.0)], "symbol string, datetime timestamp, close double, volume double")
    none = spark.createDataFrame([], "symbol string, effective timestamp, factor double")
    assert [tuple(r) for r in adjust_for_splits(rows, none).collect()] == [("a", at(0), 1.0, 2.0)]
    assert adjust_for_splits(rows.limit(0), none).count() == 0


HOURS = [
    Session("NY", "regular", "America/New_York", range(1, 6), "09:30", "16:00"),
    Session("NY", "regular", "America/New_York", [1], "09:00", "10:00"),
    Session("CME", "regular", "America/Chicago", [7, 1, 2, 3, 4], "17:00", "16:00"),
]


def test_sessions_follow_the_clock_change(spark):
    """Friday before and Monday after the clocks go forward in New York: 14:30 UTC, then 13:30 UTC is the opening."""
    times = [dt.datetime(2024, 3, 8, 14, 29), dt.datetime(2024, 3, 8, 14, 30), dt.datetime(2024, 3, 8, 20, 59), dt.datetime(2024, 3, 8, 21, 0),
             dt.datetime(2024, 3, 9, 15), dt.datetime(2024, 3, 11, 12, 59), dt.datetime(2024, 3, 11, 13, 0), dt.datetime(2024, 3, 11, 13, 30), None]
    rows = spark.createDataFrame([("NY", t) for t in times] + [("??", times[1]), (None, times[1])], "exchange string, datetime timestamp")
    found = in_sessions(rows, session_calendar(spark, HOURS), "regular")
    assert values(found, "datetime") == [times[1], times[2], times[6], times[7]]
    assert values(found, "exchange_time") == [dt.datetime(2024, 3, 8, 9, 30), dt.datetime(2024, 3, 8, 15, 59), dt.datetime(2024, 3, 11, 9, 0), dt.datetime(2024, 3, 11, 9, 30)]


def test_overnight_session_belongs_to_the_day_it_opened(spark):
    times = [dt.datetime(2024, 1, 7, 23, 30), dt.datetime(2024, 1, 8, 5), dt.datetime(2024, 1, 8, 21, 59), dt.datetime(2024, 1, 8, 22, 30), dt.datetime(2024, 1, 12, 23, 30)]
    rows = spark.createDataFrame([("CME", t) for t in times], "exchange string, datetime timestamp")
    found = in_sessions(rows, session_calendar(spark, HOURS), "regular")
    assert values(found, "trading_day") == [dt.date(2024, 1, 7)] * 3
    with pytest.raises(ValueError, match="weekday"):
        session_calendar(spark, [Session("X", "regular", "UTC", [8], "09:00", "10:00")])


def test_history_of_trading_days(spark):
    rows = [("CME:a", dt.datetime(2024, 1, 7, 23, 30), 1.0, 1.0), ("CME:a", dt.datetime(2024, 1, 8, 5), 3.0, 2.0), ("CME:a", dt.datetime(2024, 1, 8, 23, 30), 5.0, 4.0)]
    ticks = spark.createDataFrame(rows, "symbol string, datetime timestamp, close double, volume double")
    splits = spark.createDataFrame([("CME:a", dt.datetime(2024, 1, 8, 4), 2.0)], "symbol string, effective timestamp, factor double")
    found = history(ticks, "a", "daily", 5, exchange="CME", splits=splits, calendar=session_calendar(spark, HOURS))
    assert [(r["datetime"].date(), r["open"], r["close"], r["volume"]) for r in found.collect()] == [
        (dt.date(2024, 1, 7), 0.5, 3.0, 4.0), (dt.date(2024, 1, 8), 5.0, 5.0, 4.0)
    ]
    with pytest.raises(ValueError, match="exchange"):
        history(ticks, "a", calendar=session_calendar(spark, HOURS))


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_gaps_are_runs(spark, block):
    days = [0, 1, 1, 4, 5, 11, 900_000]
    rows = [("a", DAY + dt.timedelta(days=d)) for d in days] + [("a", at(7)), ("a", None), ("b", DAY), ("c", None)]
    rows += [(None, DAY), (None, DAY + dt.timedelta(days=2)), ("d", DAY), ("d", at(60))]
    df = spark.createDataFrame(rows, "symbol string, datetime timestamp").repartition(3)
    found = {(r["symbol"], (r["first_missing"] - DAY).days, (r["last_missing"] - DAY).days, r["n_missing"]) for r in gap_intervals(df, block=block).collect()}
    assert found == {("a", 2, 3, 2), ("a", 6, 10, 5), ("a", 12, 899_999, 899_988), (None, 1, 1, 1), ("d", 1, 2, 2)}
    assert missing_days(df).filter("symbol = 'a'").count() == 899_995


def test_delivery_survives_one_broken_table(spark, tmp_path):
    rows = spark.createDataFrame([(i, "ok" if i % 2 else "bad") for i in range(10)], "id long, table string")
    to_folder, broken = folder_writer(str(tmp_path / "tables")), [True, True]

    def write(part, table, batch):
        to_folder(part, table, batch)
        if table == "bad" and broken:
            broken.pop()
            raise ConnectionError("gone")

    delivery = Delivery(spark, str(tmp_path / "work"), write)
    for batch in range(2):
        delivery.stage(rows.withColumn("id", F.col("id") + 10 * batch), batch)
        delivery.stage(rows.withColumn("id", F.col("id") + 10 * batch), batch)  # a batch that is run again
        delivery.deliver()
    assert delivery.pending() == [(0, "bad", 5)]  # failed twice; the batch after it went on
    assert delivery.deliver() == 0 and delivery.pending() == []
    for table, rest in (("ok", 1), ("bad", 0)):
        assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "tables" / table)).collect()) == [i for i in range(20) if i % 2 == rest]
    events = delivery.ledger().groupBy("event").count().collect()
    assert {r["event"]: r["count"] for r in events}["failed"] == 2 and {r["event"]: r["count"] for r in events}["written"] == 4
    delivery.stage(rows.limit(0), 7)
    assert delivery.pending() == []


def test_late_rows_make_new_versions(spark, tmp_path):
    schema = "symbol string, timestamp timestamp, close double, volume double"
    noon = dt.datetime(2024, 1, 1, 23, 58)
    drops = [[("a", noon, 10.0, 1.0), ("a", noon + dt.timedelta(minutes=10), 1.0, 1.0)], [("a", noon, 20.0, 3.0), ("a", None, 1.0, 1.0), (None, noon, 5.0, 1.0)]]
    for drop in drops:
        spark.createDataFrame(drop, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        correct_vwap(stream, str(tmp_path / "out"), str(tmp_path / "checkpoint")).awaitTermination()
    assert {r["vwap"] for r in corrected(spark, str(tmp_path / "out")).filter("window_end <= '2024-01-02 00:03:00' AND symbol = 'a'").collect()} == {17.5}
    counts = {(r["version"], r["correction"]): r["count"] for r in versions(spark, str(tmp_path / "out")).groupBy("version", "correction").count().collect()}
    assert counts == {(0, False): 10, (1, True): 10}


def test_only_touched_buckets_are_written(spark, tmp_path):
    kept = VersionedTable(spark, str(tmp_path / "t"), "k long, v string, n long", ["k"], "n", buckets=8)
    assert kept.read().count() == 0
    frame = lambda rows: spark.createDataFrame(rows, "k long, v string, n long")
    kept.merge(frame([(i, "old", 1) for i in range(100)]))
    before = {r["bucket"]: r["file_generation"] for r in kept.manifest().collect()}
    touched = kept.merge(frame([(3, "new", 2), (3, "newer", 3), (4, "late", 0), (None, "null key", 1)]))
    after = {r["bucket"]: r["file_generation"] for r in kept.manifest().collect()}
    assert 1 <= len(touched) <= 3 and {b for b in after if after[b] != before.get(b)} == set(touched)
    state = {r["k"]: r["v"] for r in kept.read().collect()}
    assert len(state) == 101 and state[3] == "newer" and state[4] == "old" and state[None] == "null key"
    kept.merge(frame([(3, "newer", 3)]))
    kept.merge(frame([]))
    kept.compact()
    assert {r["file_generation"] for r in kept.manifest().collect()} == {4}
    assert {r["k"]: r["v"] for r in kept.read().collect()} == state


def test_number_texts(spark):
    numbers = [0.0, -0.0, 1.5, -2.0, 1e7, 123456789.25, 1e16, 1.5e-5, 0.0001, 1e22, 1e23, 2.0**-44, 0.1 + 0.2, -1e-9, 2.2250738585072014e-308, 1.7976931348623157e308, 100.0, 9007199254740993.0, 0.001234567890123456]
    df = spark.createDataFrame([(x,) for x in [*numbers, None, math.nan, math.inf, -math.inf]], "x double")
    assert [r[0] for r in df.select(number_text("x")).collect()] == [*map(repr, numbers), None, "nan", "inf", "-inf"]


def test_appended_rows_continue_the_indicators(spark, tmp_path):
    rng = random.Random(3)
    start = dt.datetime(2024, 1, 1)
    rows, price = [], {"a": 50.0, "b": 20.0}
    for i in range(1500):
        for symbol in ("a", "b"):
            if symbol == "b" and 700 <= i < 1100:
                continue  # no rows in one append
            flat = symbol == "a" and 600 < i < 900
            price[symbol] += 0.0 if flat else rng.choice([-1.0, 0.0, 0.5, 1.0])
            rows.append((symbol, start + dt.timedelta(minutes=i), price[symbol]))
    rows.append(("c", start + dt.timedelta(minutes=1200), 5.0))  # a key that starts late
    schema = "symbol string, datetime timestamp, close double"
    store = IndicatorStore(spark, str(tmp_path / "kept"))
    cuts = [0, 3, 150, 700, 1100, 1100, 1500]
    for low, high in zip(cuts, cuts[1:], strict=False):
        of = [r for r in rows if low <= (r[1] - start).total_seconds() / 60 < high]
        store.append(spark.createDataFrame(of, schema))
    assert store.appends() == 6
    names = GoldPeriods().outputs
    want = {(r["symbol"], r["datetime"]): r for r in all_indicators(spark.createDataFrame(rows, schema)).collect()}
    got = store.rows().collect()
    assert len(got) == len(want) == len(rows)
    for r in got:
        other = want[(r["symbol"], r["datetime"])]
        for name in names:
            a, b = r[name], other[name]
            assert (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1.0, abs(b))), (r, other)
    with pytest.raises(Exception, match="not after the last one"):
        store.append(spark.createDataFrame([("a", start + dt.timedelta(minutes=1499), 1.0)], schema))
    assert store.appends() == 6


@pytest.mark.parametrize("most_ranges", [512, 0])
def test_kept_describe_is_exact_and_reads_new_folders_only(spark, tmp_path, most_ranges):
    rng = random.Random(4)
    rows = []
    for day in ("d1", "d2", "d3"):
        rows += [("hot", day, rng.choice([rng.gauss(100, 1), 100.0, -1e6])) for _ in range(3000)]
        rows += [("ties", day, float(rng.randint(0, 2))) for _ in range(50)]
    rows += [("one", "d2", 5.0), ("none", "d1", None), ("none", "d3", math.nan), (None, "d1", 9.0), ("zero", "d3", 0.0), ("zero", "d1", -0.0)]
    table = spark.createDataFrame(rows, "symbol string, folder string, close double")
    store = DescribeStore(spark, str(tmp_path / "kept"), chunk=16, most_ranges=most_ranges)
    assert store.read().count() == 0
    store.add(table.filter("folder IN ('d1', 'd2')"), ["close"])
    before = {file: file.stat().st_mtime_ns for file in (tmp_path / "kept").rglob("folder=d[12]/*.parquet")}
    store.add(table.filter("folder = 'd3'"), ["close"])
    store.add(table.filter("folder = 'd3'"), ["close"])  # done again: nothing doubles
    assert before and before == {file: file.stat().st_mtime_ns for file in (tmp_path / "kept").rglob("folder=d[12]/*.parquet")}
    clean = table.withColumn("close", F.expr("if(isnan(close), NULL, close)"))
    expected = {row["symbol"]: row for row in describe_by(clean, columns=["close"]).collect()}
    found = {row["key"]: row for row in store.read().collect()}
    assert set(found) == set(expected) == {"hot", "ties", "one", "none", "zero"}
    for symbol, row in expected.items():
        for name in ("count", "mean", "std", "min", "q25", "q50", "q75", "max"):
            assert found[symbol][name] == pytest.approx(row[name], abs=2e-6), (symbol, name)
