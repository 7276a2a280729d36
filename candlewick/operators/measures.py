"""Long-form measure records, routed from topics to tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import iso_to_ms, now_ms, number_text, to_number
from candlewick.schemas import MEASURE_SCHEMA, ROUTE_SCHEMA

UNKNOWN_SYMBOL = "UNKNOWN"  # fixed value: symbol of messages that name none
REJECTS = "rejects"


class Route(NamedTuple):
    """Which measure of a topic goes to which table."""

    topic: str
    table: str
    measure: str


def measure_record(
    dimensions: Mapping[str, Column], measure: Column, value: Column, time_ms: Column, version: Column
) -> list[Column]:
    """The columns of a measure record; value and time are text."""
    columns = [
        F.array(*[F.struct(F.lit(name).alias("Name"), column.alias("Value")) for name, column in dimensions.items()]),
        measure,
        number_text(value),
        F.lit("DOUBLE"),
        time_ms.cast("string"),
        F.lit("MILLISECONDS"),
        version.cast("long"),
    ]
    return [column.alias(name) for column, name in zip(columns, MEASURE_SCHEMA.names)]


def to_measure_records(
    df: DataFrame,
    measure: str,
    dimensions: Sequence[str],
    time_ms: Column,
    version: Column | None = None,
    value: str | None = None,
) -> DataFrame:
    """One record per row: the value column as measure, the named columns as dimensions.

    ``time_ms`` is the record's time in epoch milliseconds, for instance
    ``iso_to_ms("window_end")``; ``version`` is the write time unless given.
    """
    names = {name: F.col(name).cast("string") for name in dimensions}
    version = now_ms() if version is None else version
    return df.select(*measure_record(names, F.lit(measure), F.col(value or measure), time_ms, version))


def route_measures(
    messages: DataFrame, routes: Sequence[Route], processing_time: bool = False, version: Column | None = None
) -> DataFrame:
    """A record per message with its target ``table``; works on batch and stream.

    Messages that cannot become a record keep their place under table
    ``rejects``, with the reason. Record time is the time in the message
    (``timestamp_ms``, else ``window_end``, else the message's own time), so a
    replay gives the same records; ``processing_time`` takes the clock instead.
    """
    spark = messages.sparkSession
    config = spark.createDataFrame(pa.table({n: [getattr(r, n) for r in routes] for n in Route._fields}), ROUTE_SCHEMA)
    text = F.col("value").cast("string")
    fields = F.from_json(text, "map<string,string>")
    found = (
        messages.select("topic", text.alias("value"), "timestamp", fields.alias("_fields"))
        .join(config, "topic", "left")
        .withColumn("_raw", F.try_element_at("_fields", F.col("measure")))
        .withColumn("_number", to_number("_raw"))
    )
    reason = (
        F.when(F.coalesce(F.size("_fields"), F.lit(0)) <= 0, "empty or malformed message")
        .when(F.col("table").isNull(), "unknown topic")
        .when(F.col("_raw").isNull(), "measure missing")
        .when(F.col("_number").isNull(), "measure is not a number")
    )
    member = {name: F.try_element_at("_fields", F.lit(name)) for name in ("symbol", "timestamp_ms", "window_end")}
    event_ms = F.coalesce(
        member["timestamp_ms"].try_cast("long"), iso_to_ms(member["window_end"]), F.unix_millis("timestamp")
    )
    dimensions = {"symbol": F.coalesce(member["symbol"], F.lit(UNKNOWN_SYMBOL)), "source_topic": F.col("topic")}
    record = measure_record(
        dimensions,
        F.col("measure"),
        F.col("_number"),
        now_ms() if processing_time else event_ms,
        now_ms() if version is None else version,
    )
    judged = found.withColumn("reason", reason)
    return judged.select(
        F.when(F.col("reason").isNull(), F.col("table")).otherwise(F.lit(REJECTS)).alias("table"),
        "topic",
        "value",
        "reason",
        F.when(F.col("reason").isNull(), F.struct(*record)).alias("record"),
    )


def records_of(routed: DataFrame, table: str | None = None) -> DataFrame:
    """The measure records of one table, or of all."""
    accepted = routed.filter(F.col("reason").isNull())
    return (accepted if table is None else accepted.filter(F.col("table") == table)).select("table", "record.*")


def rejects_of(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("reason").isNotNull()).select("topic", "value", "reason")


def latest_version(records: DataFrame, key: Sequence[str] = ("Dimensions", "MeasureName", "Time"), version: str = "Version") -> DataFrame:
    """The record with the highest version per key; of equal versions the greatest record."""
    rest = [name for name in records.columns if name not in key and name != version]
    best = records.groupBy(*key).agg(F.max(F.struct(version, *rest)).alias("_best"))
    return best.select(*[F.col(name) if name in key else F.col(f"_best.`{name}`") for name in records.columns])
