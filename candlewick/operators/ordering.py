"""Row positions and fixed-size blocks of long sequences.

``Window.partitionBy("symbol")`` puts a whole symbol into one task. Here the
position of a row comes from counts per short time grain, and sequence windows
run over blocks of a fixed number of rows, so one symbol spreads over many tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GRAIN_MICROS = 60_000_000  # one minute
DAY_MICROS = 86_400_000_000


def with_position(
    df: DataFrame,
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
    grain_micros: int = GRAIN_MICROS,
    count_values: str | None = None,
    ties: Sequence[str] = (),
) -> DataFrame:
    """Add ``_pos``, the 0-based position by time within the key.

    ``order`` is a timestamp; rows of one time follow in the order of the columns ``ties``. One key's rows of one
    minute are ordered in one task. The cumulative counts run over one small row per key and minute, day
    by day, and over one per key and day. With ``count_values``, ``_seen`` is the
    number of values of that column up to and including the row.
    """
    keyed = df.withColumn("_grain", F.floor(F.unix_micros(order) / F.lit(grain_micros)))
    totals = [F.count(F.lit(1)).alias("_rows")]
    if count_values:
        totals.append(F.count(count_values).alias("_values"))
    names = {"_rows": "_start"} | ({"_values": "_seen_start"} if count_values else {})
    counts = keyed.groupBy(*key, "_grain").agg(*totals)
    counts = counts.withColumn("_day", F.floor(F.col("_grain") * F.lit(grain_micros) / F.lit(DAY_MICROS)))
    earlier = Window.partitionBy(*key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    in_day = Window.partitionBy(*key, "_day").orderBy("_grain").rowsBetween(Window.unboundedPreceding, -1)
    days = counts.groupBy(*key, "_day").agg(*[F.sum(name).alias(f"_day{name}") for name in names])
    days = days.select(*key, "_day", *[F.coalesce(F.sum(f"_day{name}").over(earlier), F.lit(0)).alias(f"_before{name}") for name in names])
    starts = counts.join(days, [*key, "_day"], "left").select(
        *key,
        "_grain",
        *[(F.col(f"_before{name}") + F.coalesce(F.sum(name).over(in_day), F.lit(0))).alias(start) for name, start in names.items()],
    )
    local = Window.partitionBy(*key, "_grain").orderBy(order, *ties)
    ranked = keyed.withColumn("_rank", F.row_number().over(local) - 1)
    drop = ["_grain", "_rank", "_start"]
    if count_values:
        running = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        ranked = ranked.withColumn("_local_seen", F.count(count_values).over(running))
        drop += ["_local_seen", "_seen_start"]
    # Every row has its grain's start; a left join adds no filters that would tell the branches apart.
    placed = ranked.join(starts, [*key, "_grain"], "left").withColumn("_pos", F.col("_start") + F.col("_rank"))
    if count_values:
        placed = placed.withColumn("_seen", F.col("_seen_start") + F.col("_local_seen"))
    return placed.drop(*drop)


def spread_to_blocks(df: DataFrame, size: int, reach: int = 0) -> DataFrame:
    """Add ``_block``: the row's own block, and copies in the blocks that look back at it.

    A row is copied to a later block when one of that block's rows has it among
    its ``reach`` predecessors. :func:`own_rows` drops the copies again.
    """
    first = F.floor(F.col("_pos") / F.lit(size))
    last = F.floor((F.col("_pos") + F.lit(reach)) / F.lit(size))
    return df.withColumn("_block", F.explode(F.sequence(first, last)) if reach else first)


def own_rows(df: DataFrame, size: int) -> DataFrame:
    return df.filter(F.col("_block") == F.floor(F.col("_pos") / F.lit(size)))
