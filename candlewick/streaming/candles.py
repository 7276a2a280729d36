"""Candle messages, as batch or stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import ms_to_iso, ms_to_time, to_number
from candlewick.schemas import CANDLE_SCHEMA, RAW_CANDLE_SCHEMA


def _raw(messages: DataFrame) -> DataFrame:
    parsed = F.from_json(F.col("value").cast("string"), RAW_CANDLE_SCHEMA)
    return messages.select(parsed.alias("_m")).select("_m.k.*")


def closed_candles(messages: DataFrame) -> DataFrame:
    """Event payload of exchange messages whose candle has closed; others are left out."""
    return (
        _raw(messages)
        .filter("x")
        .select(
            F.col("s").alias("symbol"),
            ms_to_iso("T").alias("@timestamp"),
            to_number("c").alias("close"),
            to_number("v").alias("volume"),
            F.col("T").alias("timestamp_ms"),
        )
    )


def live_candles(messages: DataFrame) -> DataFrame:
    """Interval, close and volume as sent, of open and closed candles."""
    return _raw(messages).filter("x IS NOT NULL").selectExpr("i AS interval", "c AS close", "v AS volume")


def parse_candles(messages: DataFrame) -> DataFrame:
    """Typed candle events with their event time; malformed messages give nulls."""
    data = messages.select(F.from_json(F.col("value").cast("string"), CANDLE_SCHEMA).alias("data")).select("data.*")
    return data.withColumn("timestamp", ms_to_time("timestamp_ms"))
