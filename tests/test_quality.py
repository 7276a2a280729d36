import datetime as dt

import numpy as np
import pytest
from candlewick.operators import clean as C
from candlewick.operators import quality as Q
from candlewick.operators.quantiles import exact_quantiles

DAY = dt.datetime(2024, 1, 1)


def frame(spark, rows, columns="symbol string, datetime timestamp, close double"):
    return spark.createDataFrame(rows, columns)


def test_duplicates_treat_nulls_as_equal(spark):
    df = frame(spark, [("a", DAY, 1.0), ("a", DAY, 2.0), (None, None, 3.0), (None, None, 4.0), ("b", DAY, 5.0)])
    assert Q.duplicate_count(df).first()[0] == 2
    assert sorted(row["close"] for row in Q.duplicated_rows(df).collect()) == [1.0, 2.0, 3.0, 4.0]
    marked = {row["close"]: row["repeat"] for row in Q.mark_repeats(df, ["close"]).collect()}
    assert marked == {1.0: False, 2.0: True, 3.0: False, 4.0: True, 5.0: False}


def test_quartiles_interpolate(spark):
    df = frame(spark, [("a", DAY, float(v)) for v in (1, 2, 4, 8)])
    row = Q.describe_by(df, columns=["close"]).first()
    assert (row["q25"], row["q50"], row["q75"]) == (1.75, 3.0, 5.0)


@pytest.mark.parametrize("kind", ["uniform", "outlier", "ties", "tiny", "constant", "negative"])
def test_exact_quantiles_against_numpy(spark, kind):
    rng = np.random.default_rng(3)
    data = {
        "uniform": rng.uniform(0, 1, 5000),
        "outlier": np.concatenate([rng.uniform(100, 100.01, 5000), [1e12, -1e12]]),
        "ties": rng.integers(0, 4, 5000).astype(float),
        "tiny": np.array([7.0, 3.0]),
        "constant": np.full(100, 2.5),
        "negative": -rng.lognormal(0, 3, 5000),
    }[kind]
    df = spark.createDataFrame([("k", float(v)) for v in data], "key string, v double")
    names = ["a", "b", "c", "d"]
    probs = [0.0, 0.25, 0.5, 0.999]
    # A coarse sketch must not change the result.
    row = exact_quantiles(df, ["key"], "v", probs, names, accuracy=10).first()
    expected = np.quantile(data, probs)
    assert np.allclose([row[name] for name in names], expected, rtol=1e-12, atol=1e-9)


def test_describe_leaves_null_symbols_out_and_gives_null_std_for_one_row(spark):
    df = frame(spark, [("a", DAY, 1.0), (None, DAY, 2.0)])
    rows = Q.describe_by(df, columns=["close"]).collect()
    assert [(row["symbol"], row["count"], row["std"]) for row in rows] == [("a", 1, None)]


def test_describe_approximate_is_close(spark):
    df = spark.range(1000).selectExpr("'a' AS symbol", "double(id) AS close")
    row = Q.describe_by(df, columns=["close"], approximate=True).first()
    assert abs(row["q50"] - 499.5) <= 1


def test_coverage_with_leap_day(spark):
    rows = [("a", dt.datetime(2024, 2, 29), 1.0), ("a", dt.datetime(2028, 2, 28), 1.0), ("b", None, 1.0)]
    rows += [("c", dt.datetime(2024, 1, 1), 1.0), ("c", dt.datetime(2027, 12, 29), 1.0)]
    result = {row["symbol"]: row for row in Q.coverage_check(frame(spark, rows)).collect()}
    assert result["a"]["target_end"] == dt.datetime(2028, 2, 29) and result["a"]["ok"]
    assert not result["b"]["ok"] and result["b"]["reason"] == "no valid dates"
    assert not result["c"]["ok"] and result["c"]["reason"] is None


def test_gaps_and_missing_days(spark):
    noon = DAY + dt.timedelta(hours=12)
    rows = [("a", noon, 1.0), ("a", noon, 2.0), ("a", noon + dt.timedelta(days=3), 1.0), ("a", None, 1.0)]
    df = frame(spark, rows)
    row = Q.gap_check(df).first()
    assert (row["n_rows"], row["n_times"], row["n_repeated"], row["expected"], row["missing"]) == (4, 2, 1, 4, 2)  # the row without a time is a row too
    missing = sorted(row["datetime"] for row in Q.missing_days(df).collect())
    assert missing == [noon + dt.timedelta(days=1), noon + dt.timedelta(days=2)]


def test_null_profile_order_and_share(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (3, "y", 1.5)], "id int, b string, a double")
    rows = [tuple(row) for row in Q.null_profile(df).collect()]
    assert rows == [("a", 2, 66.667, "double"), ("b", 1, 33.333, "string"), ("id", 0, 0.0, "int")]


def test_null_profile_of_no_rows(spark):
    assert Q.null_profile(spark.createDataFrame([], "a int")).first()["null_pct"] is None


def test_quality_report_counts(spark):
    rows = [("a", DAY, 1.0, 3.0, 2.0, 2.5), ("a", DAY, 1.0, 1.0, 2.0, None), ("b", None, 1.0, 3.0, 2.0, 9.0)]
    df = frame(spark, rows, "symbol string, datetime timestamp, open double, high double, low double, close double")
    assert tuple(Q.quality_report(df).first()) == (3, 1, 1, 1, 1)


def test_normalize_bars(spark):
    names = [" datetime", "symbol ", "open", "high", "low", "close", "volume", "note"]
    rows = [("2024-01-01 10:00:00", "a", "1", "2", "0.5", "NaN", "x", "n"), ("never", "a", "1", "2", "0.5", "1.5", "3", "n")]
    df = C.normalize_bars(spark.createDataFrame(rows, names))
    first, second = df.collect()
    assert first["datetime"] == dt.datetime(2024, 1, 1, 10) and first["close"] is None and first["volume"] is None
    assert second["datetime"] is None and second["close"] == 1.5 and second["note"] == "n"


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="volume"):
        C.require_columns(spark.createDataFrame([(1,)], "datetime int"))


def test_hot_key_goes_through_counts_not_windows(spark):
    """A third of all rows are copies of one key."""
    df = spark.range(30_000).selectExpr(
        "if(id % 3 = 0, 'hot', string(id)) AS symbol", "timestamp_seconds(if(id % 3 = 0, 0, id)) AS datetime", "id"
    )
    copies = Q.duplicated_rows(df)
    assert copies.count() == 10_000
    assert "Window" not in copies._jdf.queryExecution().executedPlan().toString()
    assert Q.mark_repeats(df, ["id"]).filter("NOT repeat").count() == 20_001
