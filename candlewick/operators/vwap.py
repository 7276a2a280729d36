"""Volume-weighted average price, in batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.operators.clean import drop_incomplete


def priced(df: DataFrame) -> DataFrame:
    """Rows with both close and volume; a row without a close must not add its volume to the divisor."""
    return drop_incomplete(df, ["close", "volume"])


def vwap_value(value: Column | str, volume: Column | str) -> Column:
    """Traded value over volume; null when there was no volume."""
    return F.try_divide(F.sum(value), F.sum(volume))


def vwap(df: DataFrame, keys: Sequence[str] = ("symbol",), keep_unpriced: bool = False) -> DataFrame:
    """VWAP per key. ``keep_unpriced`` lets rows without a close count in the divisor."""
    rows = df if keep_unpriced else priced(df)
    return rows.groupBy(*keys).agg(vwap_value(F.col("close") * F.col("volume"), "volume").alias("vwap"))


def vwap_windows(
    df: DataFrame, minutes: int = 5, slide_minutes: int = 1, keep_unpriced: bool = False
) -> DataFrame:
    """VWAP per symbol and sliding window.

    Rows are first summed per slide-wide pane; the panes, not the rows, are copied into the windows.
    """
    if minutes % slide_minutes:
        raise ValueError("the window must be a multiple of the slide")
    rows = df if keep_unpriced else priced(df)
    traded = rows.select("symbol", "datetime", F.expr("close * volume AS _value"), F.col("volume").alias("_volume"))
    pane = F.window("datetime", f"{slide_minutes} minutes").start
    sums = [F.sum(name).alias(name) for name in ("_value", "_volume")]
    traded = traded.groupBy("symbol", pane.alias("datetime")).agg(*sums)
    return (
        traded.groupBy("symbol", F.window("datetime", f"{minutes} minutes", f"{slide_minutes} minutes"))
        .agg(vwap_value("_value", "_volume").alias("vwap"))
        .select("window.start", "window.end", "symbol", "vwap")
        .toDF("window_start", "window_end", "symbol", "vwap")
    )
