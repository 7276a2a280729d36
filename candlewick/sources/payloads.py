"""Bars from raw chart payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.functions.scalars import time_of_seconds
from candlewick.schemas import VALUE_COLUMNS

# How bars are marked in a payload. "." does not match a line feed.
SERIES_PATTERN = r'(?d)"s":\[(.+?)\}\]'
VALUES_PATTERN = r'"v":\[([^\]]*)'


def parse_bar_payloads(
    df: DataFrame, raw: str = "raw", symbol: str = "symbol", sticky_volume: bool = True
) -> DataFrame:
    """One row per bar of the first series in each payload.

    Empty, junk and absent fields become 0.0, each by itself; a bar without a readable time has a null time. Once a
    bar has such a value, the volume is 0.0 from that bar to the end of the
    payload; ``sticky_volume=False`` judges every bar by itself. Payloads
    without a series give no rows.
    """
    others = [name for name in df.columns if name not in (raw, symbol)]
    series = F.regexp_extract(raw, SERIES_PATTERN, 1)
    # Each bar's values as text, so that one bad field spoils neither its bar nor the payload.
    texts = F.regexp_extract_all("_text", F.lit(VALUES_PATTERN), F.lit(1))
    number = "try_cast(get(t, i) AS double)"
    parsed = (
        df.withColumn("_text", series)
        .filter(F.col("_text") != "")
        .withColumn("_fields", F.transform(texts, lambda text: F.split(text, ",")))
        .withColumn("_values", F.expr(f"transform(_fields, t -> transform(sequence(0, 5), i -> {number}))"))
    )
    broken = "exists(slice(v, 2, 5), x -> x IS NULL)"
    first_broken = f"array_position(transform(_values, v -> {broken}), true)"
    bars = parsed.select(
        symbol,
        *others,
        F.posexplode("_values").alias("_pos", "_v"),
        F.expr(first_broken).alias("_first_broken"),
    )
    failed = "_first_broken > 0 AND _pos + 1 >= _first_broken" if sticky_volume else "false"
    values = [F.expr(f"coalesce(_v[{i + 1}], 0D)").alias(name) for i, name in enumerate(VALUE_COLUMNS[:4])]
    return bars.select(
        *others,
        time_of_seconds(F.col("_v")[0]).alias("datetime"),
        F.col(symbol).alias("symbol"),
        *values,
        F.expr(f"if({failed}, 0D, coalesce(_v[5], 0D))").alias("volume"),
    )
