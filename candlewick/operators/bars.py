"""Resampling, slices and last bars."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalars import format_symbol
from candlewick.operators.adjust import adjust_for_splits
from candlewick.operators.ordering import GRAIN_MICROS
from candlewick.operators.sessions import in_sessions
from candlewick.schemas import VALUE_COLUMNS
from candlewick.session import stored

# Bar sizes by name.
INTERVALS = {
    "min_1": "1 minute",
    "min_3": "3 minutes",
    "min_5": "5 minutes",
    "min_15": "15 minutes",
    "min_30": "30 minutes",
    "min_45": "45 minutes",
    "hour_1": "1 hour",
    "hour_2": "2 hours",
    "hour_3": "3 hours",
    "hour_4": "4 hours",
    "daily": "1 day",
    "weekly": "week",
    "monthly": "month",
}

# Bar sizes of whole trading days.
DAYS = ("daily", "weekly", "monthly")

# Up to this many rows per key Spark cuts each task's rows before the shuffle.
GROUP_LIMIT_ROWS = 1000


def bar_start(time: Column | str, interval: str) -> Column:
    """Start of the bar a time falls in. Weeks start on Monday, months on the 1st."""
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval: {interval}")
    width = INTERVALS[interval]
    if width in ("week", "month"):
        return F.date_trunc(width, time)
    return F.window(time, width).start


def resample(df: DataFrame, interval: str, unique: bool = False) -> DataFrame:
    """Bars of the given size from smaller bars, or from ticks that only have close and volume.

    With several rows at a bar's first or last time, the lowest open and the
    highest close win, so the result does not depend on row order. Pass
    ``unique=True`` when ``(symbol, datetime)`` is unique: the plan then stays in
    hash aggregation.
    """
    full = all(name in df.columns for name in ("open", "high", "low"))
    opened, high, low = ("open", "high", "low") if full else ("close", "close", "close")
    if unique:
        first, last = F.min_by(opened, "datetime"), F.max_by("close", "datetime")
    else:
        first = F.min(F.struct("datetime", opened)).getField(opened)
        last = F.max(F.struct("datetime", "close")).getField("close")
    return (
        df.filter(F.col("datetime").isNotNull())
        .withColumn("_bar", bar_start("datetime", interval))
        .groupBy("symbol", "_bar")
        .agg(
            first.alias("open"),
            F.max(high).alias("high"),
            F.min(low).alias("low"),
            last.alias("close"),
            F.sum("volume").alias("volume"),
        )
        .select(F.col("_bar").alias("datetime"), "symbol", *VALUE_COLUMNS)
    )


def last_n_bars(
    df: DataFrame, n: int, key: Sequence[str] = ("symbol",), order: str = "datetime"
) -> DataFrame:
    """The last ``n`` rows of each key by time; at equal times the greater other columns, in their order, come later.

    Large ``n`` first drops the minutes that lie before the last ``n`` rows,
    found from row counts per minute, so the ranking sees few more rows than it
    keeps. The list of first minutes, one per key, is stored so that Spark knows
    whether it can be broadcast.
    """
    rows = df.filter(F.col(order).isNotNull())
    if n > GROUP_LIMIT_ROWS:
        rows = rows.withColumn("_grain", F.floor(F.unix_micros(order) / F.lit(GRAIN_MICROS)))
        later = Window.partitionBy(*key).orderBy(F.desc("_grain")).rowsBetween(Window.unboundedPreceding, -1)
        first = (
            rows.groupBy(*key, "_grain")
            .agg(F.count(F.lit(1)).alias("_rows"))
            .withColumn("_later", F.coalesce(F.sum("_rows").over(later), F.lit(0)))
            .filter(F.col("_later") < n)
            .groupBy(*key)
            .agg(F.min("_grain").alias("_first"))
        )
        rows = rows.join(stored(first, "first-minutes"), list(key)).filter("_grain >= _first")
        rows = rows.select(*df.columns)
    others = [f.name for f in df.schema.fields if f.name not in (*key, order) and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    newest = Window.partitionBy(*key).orderBy(F.desc(order), *[F.desc(name) for name in others])
    return rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= n).drop("_rank")


def history(
    bars: DataFrame,
    symbol: str,
    interval: str = "daily",
    n_bars: int = 10,
    exchange: str | None = None,
    contract: int | None = None,
    splits: DataFrame | None = None,
    calendar: DataFrame | None = None,
    session: str = "regular",
) -> DataFrame:
    """The last ``n_bars`` bars of one symbol at the given bar size, oldest first.

    With ``exchange`` (and ``contract`` for futures) the symbol is looked up
    under its full name, ``EXCHANGE:TICKER`` or ``EXCHANGE:TICKER<n>!``. ``splits`` (symbol, effective, factor)
    adjusts prices and volumes before bars are made. With a ``calendar`` only rows in the exchange's sessions of the kind ``session`` count,
    and bars start by the exchange's clock: ``datetime`` is its wall time, and daily bars are trading days.
    """
    name = F.lit(symbol)
    if exchange is not None:
        name = format_symbol(name, F.lit(exchange), None if contract is None else F.lit(contract))
    rows = bars.filter(F.col("symbol") == name)
    if splits is not None:
        rows = adjust_for_splits(rows, splits.filter(F.col("symbol") == name))
    if calendar is not None:
        if exchange is None:
            raise ValueError("a session calendar needs the exchange")
        rows = in_sessions(rows.withColumn("_at", F.lit(exchange)), calendar, session, "_at")
        clock = F.col("trading_day").cast("timestamp") if interval in DAYS else F.col("exchange_time").cast("timestamp")
        rows = rows.withColumn("_clock", F.col("exchange_time")).withColumn("datetime", clock)
        if interval in DAYS:  # first and last by the clock within the trading day
            return last_n_bars(session_bars(rows, interval), n_bars).orderBy("datetime")
    return last_n_bars(resample(rows, interval), n_bars).orderBy("datetime")


def session_bars(rows: DataFrame, interval: str) -> DataFrame:
    """Bars of whole trading days: ``datetime`` is the row's trading day, ``_clock`` its time, which orders rows within a bar."""
    full = all(name in rows.columns for name in ("open", "high", "low"))
    opened, high, low = ("open", "high", "low") if full else ("close", "close", "close")
    grouped = rows.filter(F.col("datetime").isNotNull()).withColumn("_bar", bar_start("datetime", interval)).groupBy("symbol", "_bar")
    return grouped.agg(
        F.min(F.struct("_clock", opened)).getField(opened).alias("open"),
        F.max(high).alias("high"),
        F.min(low).alias("low"),
        F.max(F.struct("_clock", "close")).getField("close").alias("close"),
        F.sum("volume").alias("volume"),
    ).select(F.col("_bar").alias("datetime"), "symbol", *VALUE_COLUMNS)


def week_of(date: dt.date | str) -> tuple[dt.datetime, dt.datetime]:
    """Monday 00:00 of the week of a date, and of the next week."""
    day = dt.date.fromisoformat(date) if isinstance(date, str) else date
    monday = dt.datetime.combine(day - dt.timedelta(days=day.weekday()), dt.time())
    return monday, monday + dt.timedelta(days=7)


def week_slice(df: DataFrame, symbol: str | None, date: dt.date | str, closed: str = "both") -> DataFrame:
    """Rows from Monday 00:00 of the week of ``date`` to the next Monday 00:00, with day name and date.

    Both ends belong to the slice; ``closed="left"`` leaves the next Monday out.
    ``symbol=None`` keeps all symbols.
    """
    monday, following = week_of(date)
    start, end = (F.to_timestamp(F.lit(at.isoformat(sep=" "))) for at in (monday, following))
    upper = F.col("datetime") <= end if closed == "both" else F.col("datetime") < end
    rows = df if symbol is None else df.filter(F.col("symbol") == symbol)
    return rows.filter((F.col("datetime") >= start) & upper).withColumns(
        {"dow": F.date_format("datetime", "EEEE"), "date": F.to_date("datetime")}
    )


def first_rows(df: DataFrame, n: int, *order: Column | str) -> DataFrame:
    """The first ``n`` rows in the given order."""
    return df.orderBy(*order).limit(n)
