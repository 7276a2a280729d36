"""Prices and volumes adjusted for splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlewick.schemas import PRICE_COLUMNS
from candlewick.session import stored


def later_splits(times: DataFrame, splits: DataFrame, key: str = "symbol") -> DataFrame:
    """Per key and day of ``times``: the product ``later`` of the factors of all later days, and the day's own ``splits`` in time order.

    The running product goes backward over one row per key and day that has rows or splits, never over the
    rows themselves. ``times``: the key and ``datetime``; ``splits``: the key, ``effective``, ``factor``.
    """
    known = splits.filter((F.col("factor") > 0) & (F.col("factor") < float("inf")) & F.col("effective").isNotNull()).select(key, "effective", "factor").distinct()
    by_day = known.groupBy(key, F.to_date("effective").alias("_day")).agg(
        F.array_sort(F.collect_list(F.struct("effective", "factor"))).alias("_splits"), F.product("factor").alias("_product")
    )
    days = times.filter("datetime IS NOT NULL").select(key, F.to_date("datetime").alias("_day")).distinct()
    none = F.lit(None)
    days = days.select(key, "_day", none.cast(by_day.schema["_splits"].dataType).alias("_splits"), none.cast("double").alias("_product"))
    both = days.unionByName(by_day).groupBy(key, "_day").agg(F.max("_splits").alias("_splits"), F.max("_product").alias("_product"))
    later = Window.partitionBy(key).orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    return both.withColumn("_later", F.coalesce(F.product("_product").over(later), F.lit(1.0))).drop("_product")


def adjust_for_splits(
    rows: DataFrame, splits: DataFrame, key: str = "symbol", prices: Sequence[str] = PRICE_COLUMNS, volume: str | None = "volume"
) -> DataFrame:
    """Rows in terms of the latest unit: prices divided, volumes multiplied by the factors of all later splits.

    ``splits``: the key, ``effective`` (time) and ``factor`` (new units for one old, 2.0 for two for one). A row at the effective time is
    already in new units. Splits without a positive, finite factor, a time or a key count for nothing, a repeated
    split once; rows without a time or key stay as they are. Price columns that are not there are passed over. All other columns stay.
    """
    table = stored(later_splits(rows, splits, key), "later-splits")
    table = table.withColumnsRenamed({key: "_key"})
    joined = rows.withColumn("_on", F.to_date("datetime")).join(table, (F.col(key) == F.col("_key")) & (F.col("_on") == F.col("_day")), "left")
    same_day = F.filter("_splits", lambda s: s["effective"] > F.col("datetime"))
    own = F.coalesce(F.reduce(same_day, F.lit(1.0), lambda product, s: product * s["factor"]), F.lit(1.0))
    joined = joined.withColumn("_factor", own * F.coalesce("_later", F.lit(1.0)))
    changed = {name: F.col(name) / F.col("_factor") for name in prices if name in rows.columns}
    if volume in rows.columns:
        changed[volume] = F.col(volume) * F.col("_factor")
    return joined.withColumns(changed).select(rows.columns)
