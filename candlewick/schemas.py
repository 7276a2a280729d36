"""Record layouts shared by the jobs."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE_COLUMNS = ["open", "high", "low", "close"]
VALUE_COLUMNS = [*PRICE_COLUMNS, "volume"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField("datetime", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        *[T.StructField(name, T.DoubleType()) for name in VALUE_COLUMNS],
    ]
)

LAYER_PARTITIONS = ["crypto", "year", "month"]

# Closed candle as it travels on the topic; the key is the symbol.
CANDLE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("@timestamp", T.StringType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("timestamp_ms", T.LongType()),
    ]
)

# Exchange message; prices arrive as text.
RAW_CANDLE_SCHEMA = T.StructType(
    [
        T.StructField(
            "k",
            T.StructType(
                [
                    T.StructField("s", T.StringType()),
                    T.StructField("i", T.StringType()),
                    T.StructField("c", T.StringType()),
                    T.StructField("v", T.StringType()),
                    T.StructField("T", T.LongType()),
                    T.StructField("x", T.BooleanType()),
                ]
            ),
        )
    ]
)

VWAP_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.StringType()),
        T.StructField("window_end", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("vwap", T.DoubleType()),
    ]
)

ENVELOPE_COLUMNS = ["topic", "partition", "offset", "key", "value", "timestamp"]

MEASURE_SCHEMA = T.StructType(
    [
        T.StructField(
            "Dimensions",
            T.ArrayType(
                T.StructType([T.StructField("Name", T.StringType()), T.StructField("Value", T.StringType())])
            ),
        ),
        T.StructField("MeasureName", T.StringType()),
        T.StructField("MeasureValue", T.StringType()),
        T.StructField("MeasureValueType", T.StringType()),
        T.StructField("Time", T.StringType()),
        T.StructField("TimeUnit", T.StringType()),
        T.StructField("Version", T.LongType()),
    ]
)

ROUTE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("table", T.StringType()),
        T.StructField("measure", T.StringType()),
    ]
)
