"""From typed bars to the indicator table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from candlewick.operators.clean import add_layer_columns, dedup_bars, drop_incomplete, normalize_bars
from candlewick.operators.indicators import GoldPeriods, all_indicators


def silver(bronze: DataFrame) -> DataFrame:
    """Typed bars: fixed column types, bad values null, extra columns kept."""
    return normalize_bars(bronze)


def gold(
    bars: DataFrame,
    periods: GoldPeriods = GoldPeriods(),
    crypto: str | None = None,
    unique: bool = False,
) -> DataFrame:
    """Typed bars with a close, plus indicators, year and month.

    Of several bars of a symbol at the same time one is kept (``dedup_bars``);
    pass ``unique=True`` when there are none, to save that shuffle.
    """
    typed = drop_incomplete(normalize_bars(bars))
    return add_layer_columns(all_indicators(typed if unique else dedup_bars(typed), periods, complete=True), crypto)
