"""Trading sessions: which rows an exchange was open for, in its own zone."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DAY_MINUTES = 1440


class Session(NamedTuple):
    """Opening hours of one kind on some weekdays (1 is Monday), in the exchange's zone; a close at or before the open is on the next day."""

    exchange: str
    kind: str
    zone: str
    weekdays: Sequence[int]
    opens: str
    closes: str


def _minutes(text: str) -> int:
    hours, minutes = text.split(":")
    value = int(hours) * 60 + int(minutes)
    if not 0 <= value <= DAY_MINUTES or int(minutes) > 59:
        raise ValueError(f"not a time of day: {text}")
    return value


def session_calendar(spark: SparkSession, sessions: Sequence[Session]) -> DataFrame:
    """One row per exchange, kind, weekday and interval of minutes; a session over midnight has two.

    ``day_shift`` is 1 in the part after midnight: the trading day is the one before.
    """
    rows = []
    for session in sessions:
        start, end = _minutes(session.opens), _minutes(session.closes)
        for weekday in session.weekdays:
            if not 1 <= weekday <= 7:
                raise ValueError(f"not a weekday: {weekday}")
            if end > start:
                rows.append((session.exchange, session.kind, session.zone, weekday, start, end, 0))
                continue
            rows.append((session.exchange, session.kind, session.zone, weekday, start, DAY_MINUTES, 0))
            if end:
                rows.append((session.exchange, session.kind, session.zone, weekday % 7 + 1, 0, end, 1))
    return spark.createDataFrame(rows, "exchange string, kind string, zone string, weekday int, opens int, closes int, day_shift int")


def in_sessions(rows: DataFrame, calendar: DataFrame, kind: str | None = None, exchange: str = "exchange") -> DataFrame:
    """The rows whose time lies in a session of their exchange, with ``session``, ``exchange_time`` and ``trading_day``.

    ``datetime`` is an instant; ``exchange_time`` is the exchange's wall clock (a time without a zone), clock changes included: of an hour that comes
    twice both keep their rows. Opening times belong to a session, closing times do not. The calendar is joined by
    exchange and weekday, then by range; overlapping sessions of one kind give a row once.
    ``kind=None`` keeps all kinds, a row once for each. Rows without a time and of unknown exchanges are left out.
    """
    wanted = calendar if kind is None else calendar.filter(F.col("kind") == kind)
    zones = wanted.select(F.col("exchange").alias("_exchange"), "zone").distinct()
    local = rows.join(zones, rows[exchange] == zones["_exchange"])
    local = local.withColumn("exchange_time", F.from_utc_timestamp("datetime", F.col("zone")).cast("timestamp_ntz"))
    at = F.hour("exchange_time") * 60 + F.minute("exchange_time")
    local = local.withColumn("_weekday", F.weekday("exchange_time") + 1).withColumn("_minute", at)
    open_from = F.array_sort(F.collect_set(F.struct("opens", "closes", "day_shift")))
    hours = wanted.groupBy(F.col("exchange").alias("_of"), F.col("zone").alias("_zone"), "kind", "weekday").agg(open_from.alias("_open"))
    same = (F.col("_exchange") == F.col("_of")) & (F.col("zone") == F.col("_zone")) & (F.col("_weekday") == F.col("weekday"))
    hit = F.get(F.filter("_open", lambda s: (F.col("_minute") >= s["opens"]) & (F.col("_minute") < s["closes"])), F.lit(0))
    found = local.join(hours, same).withColumn("_hit", hit).filter("_hit IS NOT NULL")
    day = F.date_sub(F.to_date("exchange_time"), F.col("_hit.day_shift"))
    return found.select(*[rows[c] for c in rows.columns], F.col("kind").alias("session"), "exchange_time", day.alias("trading_day"))
