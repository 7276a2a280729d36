"""Exact quantiles of large groups.

The built-in ``percentile`` keeps all distinct values of a group in one task.
Here a sketch gives cut points near the wanted quantiles, values are counted in
narrow bins between the cut points, and only the bins that hold a wanted rank
are looked at value by value. The counts are exact, so a poor sketch costs time
but never changes the result. Cut points and bins are a few rows per group; they
are stored, because a sketch may come out differently when computed again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import stored

BINS = 1024  # per segment in which a wanted rank is expected


def near_probs(probs: Sequence[float], accuracy: int = 1000) -> list[float]:
    """Places just below and above the wanted ones, between which a sketch surely has them."""
    margin = 2.0 / accuracy
    return sorted({min(max(p + side * margin, 0.0), 1.0) for p in probs for side in (-1, 1)})


def first_look(column: str, probs: Sequence[float], accuracy: int = 1000) -> list[Column]:
    """Least and greatest value and the sketch's cut points: what a first scan must find."""
    sketch = F.percentile_approx(column, near_probs(probs, accuracy), accuracy)
    return [F.min(column).alias("_min"), F.max(column).alias("_max"), sketch.alias("_near")]


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    column: str,
    probs: Sequence[float],
    names: Sequence[str],
    accuracy: int = 1000,
    also: Sequence[Column] = (),
    summary: DataFrame | None = None,
) -> DataFrame:
    """One row per key with the given quantiles, linear between neighbouring ranks.

    ``also`` are further aggregates of the same column, taken in the first scan; a ``summary`` that has the keys,
    the columns of :func:`first_look` and any others replaces that scan. Groups without values have null quantiles.
    """
    keys = list(keys)
    rows = df.select(*keys, column).withColumn("_v", F.col(column))
    near = near_probs(probs, accuracy)
    if summary is None:
        summary = rows.groupBy(*keys).agg(*first_look("_v", probs, accuracy), *also)
    extras = [name for name in summary.columns if name not in (*keys, "_min", "_max", "_near")]
    cut_points = F.expr("array_sort(concat(array(_min), _near, array(_max)))").alias("_cuts")
    summary = stored(summary.select(*keys, cut_points, *extras), "cuts")
    n_cuts = len(near) + 2
    segment = " + ".join(f"int(_v >= _cuts[{i}])" for i in range(1, n_cuts - 1))
    edges = [0.0, *near, 1.0]
    expected = [i for i in range(n_cuts - 1) if any(edges[i] <= p <= edges[i + 1] for p in probs)]
    in_expected = f"_seg IN ({', '.join(map(str, expected))})"
    binned = (
        rows.filter("_v IS NOT NULL")
        .join(summary.select(*keys, "_cuts"), keys)
        .withColumn("_seg", F.expr(segment))
        .withColumn("_low", F.expr("_cuts[_seg]"))
        .withColumn("_width", F.expr("_cuts[_seg + 1] - _low"))
        .withColumn(
            "_bin",
            F.expr(
                f"if(_width > 0 AND {in_expected}, int(least(floor((_v - _low) / _width * {BINS}), {BINS - 1})), 0)"
            ),
        )
        .select(*keys, "_seg", "_bin", "_v")
    )
    place = [*keys, "_seg", "_bin"]
    ordered = Window.partitionBy(*keys).orderBy("_seg", "_bin")
    wanted = ", ".join(
        f"named_struct('_name', '{name}', '_at', (_total - 1) * {p!r}D)" for name, p in zip(names, probs)
    )
    targets = (
        binned.groupBy(*place)
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_end", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
        .withColumn("_want", F.explode(F.expr(f"array({wanted})")))
        .selectExpr(*place, "_end - _n AS _start", "_end", "_total", "_want._name", "_want._at")
        .withColumn("_rank", F.explode(F.expr("array_distinct(array(floor(_at), least(floor(_at) + 1, _total - 1)))")))
        .filter("_rank >= _start AND _rank < _end")
    )
    targets = stored(targets, "ranks")
    bins = targets.select(*place, "_start").distinct()
    in_bin = Window.partitionBy(*place).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    values = (
        binned.join(bins, place)
        .groupBy(*place, "_start", "_v")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_upto", F.col("_start") + F.sum("_n").over(in_bin))
        .selectExpr(*place, "_v", "_upto - _n AS _from", "_upto")
    )
    found = targets.join(values, place).filter("_rank >= _from AND _rank < _upto")
    share = "1 - abs(_at - _rank)"  # the two ranks around the wanted place share the weight
    quantiles = (
        found.withColumn("_part", F.expr(f"_v * ({share})"))
        .groupBy(*keys)
        .agg(*[F.expr(f"sum(if(_name = '{name}', _part, NULL)) AS {name}") for name in names])
    )
    return summary.drop("_cuts").join(quantiles, keys, "left")
