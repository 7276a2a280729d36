"""The driver's tables in the shapes the operators work on."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.operators.bars import resample
from candlewick.session import configure


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def ticks(spark: SparkSession, folder: str, start: dt.datetime | None = None, end: dt.datetime | None = None) -> DataFrame:
    """Events as ticks: one symbol per event type, volume from the properties.

    ``start`` (included) and ``end`` (not) are compared with the stored time, so the scan skips other rows.
    """
    events = table(spark, folder, "events")
    kind = events.schema["ts"].dataType
    if start is not None:
        events = events.filter(F.col("ts") >= F.lit(start).cast(kind))
    if end is not None:
        events = events.filter(F.col("ts") < F.lit(end).cast(kind))
    return events.select(
        "event_id",
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("datetime"),
        F.col("value").alias("close"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


def bars(
    spark: SparkSession, folder: str, interval: str, start: dt.datetime | None = None, end: dt.datetime | None = None
) -> DataFrame:
    return resample(ticks(spark, folder, start, end), interval)


def trades(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as trades: one symbol per return flag."""
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("datetime"),
        F.col("l_extendedprice").alias("close"),
        F.col("l_quantity").alias("volume"),
    )
