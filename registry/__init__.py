"""Named queries on the driver's tables, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

# Averages of two-decimal prices often end in an exact 5 at the fifth place, where two engines may
# round apart. Moving the value by a fixed step first keeps such values off the rounding edge.
NUDGE = 3e-6


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; its times are returned without a zone, like the SQL's."""

    def add(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return without_zone(build(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return build

    return add


def without_zone(df: DataFrame) -> DataFrame:
    zoned = [field.name for field in df.schema.fields if isinstance(field.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned}) if zoned else df


def near(column: Column | str, places: int = 4) -> Column:
    value = F.col(column) if isinstance(column, str) else column
    return F.round(value + F.lit(NUDGE), places)


def rounded(df: DataFrame, *names: str, places: int = 4) -> DataFrame:
    return df.withColumns({name: near(name, places) for name in names})


def near_sql(expression: str, places: int = 4) -> str:
    return f"round({expression} + {NUDGE!r}, {places})"


TICKS_SQL = """ticks AS (
    SELECT event_id, event_type AS symbol, ts AS datetime, value AS "close",
           CAST(json_extract_string(props, '$.k') AS DOUBLE) AS volume
    FROM events)"""


def bars_sql(start: str, name: str = "bars") -> str:
    """Bars of the ticks; ``start`` is the SQL of the bar's start."""
    return f"""{name} AS (
    SELECT {start} AS datetime, symbol, arg_min("close", datetime) AS open, max("close") AS high,
           min("close") AS low, arg_max("close", datetime) AS "close", sum(volume) AS volume
    FROM ticks GROUP BY 1, 2)"""


HOUR_SQL = bars_sql("date_trunc('hour', datetime)")
DAY_SQL = bars_sql("CAST(date_trunc('day', datetime) AS TIMESTAMP)")
