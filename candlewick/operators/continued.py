"""Indicators of appended rows, continued from what the earlier rows have left.

The state of a key is one row: how many rows it has, the last time, the last value of every exponential mean,
the last RSI and whether there was a loss, and the last ``sma - 1`` values. A mean's weighted sum follows from
the mean and the number of rows, so new rows take up the series as if the earlier ones were a block before
them. Earlier rows are never read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.indicators import (
    GoldPeriods, Smoothing, _series, _smooth, _ties, _weights, _with_move, _with_rsi, _with_trailing_mean, block_rows, span_alpha,
)
from candlewick.operators.ordering import own_rows, spread_to_blocks, with_position

_MEANS = ["_fast", "_slow", "_ema", "_avg_gain", "_avg_loss", "_signal"]


def _specs(periods: GoldPeriods) -> list[Smoothing]:
    wilder = 1.0 / periods.rsi
    return [
        Smoothing("_x", span_alpha(periods.fast), "_fast"),
        Smoothing("_x", span_alpha(periods.slow), "_slow"),
        Smoothing("_x", span_alpha(periods.ema), "_ema"),
        Smoothing("_gain", wilder, "_avg_gain"),
        Smoothing("_loss", wilder, "_avg_loss"),
    ]


def state_schema(df: DataFrame, key: Sequence[str] = ("symbol",), order: str = "datetime") -> T.StructType:
    """Columns of the state for rows like those of ``df``: the key, the last time, and what is carried on."""
    fields = [T.StructField(f.name, f.dataType) for f in (df.schema[name] for name in (*key, order))]
    fields += [T.StructField("n_rows", T.LongType())]
    fields += [T.StructField(name[1:], T.DoubleType()) for name in _MEANS]
    fields += [T.StructField("rsi", T.DoubleType()), T.StructField("lost", T.BooleanType()), T.StructField("tail", T.ArrayType(T.DoubleType()))]
    return T.StructType(fields)


def empty_state(spark: SparkSession, df: DataFrame, key: Sequence[str] = ("symbol",), order: str = "datetime") -> DataFrame:
    return spark.createDataFrame([], state_schema(df, key, order))


def continue_indicators(
    new: DataFrame, state: DataFrame, periods: GoldPeriods = GoldPeriods(), key: Sequence[str] = ("symbol",), order: str = "datetime"
) -> DataFrame:
    """The rows of ``new`` with all indicators of ``close``, and the columns ``_n_rows``, ``_fast`` to ``_avg_loss`` and ``_lost`` that
    :func:`next_state` reads.

    Equal to ``all_indicators`` of all rows so far, if every row comes after its key's last time in ``state`` (one row per key).
    A row that does not stops the job: results after it would have to change. Rows without a key or time have null
    results. A key without a state starts anew; an empty ``new`` gives no rows.
    """
    specs = _specs(periods)
    signal = Smoothing("macd", span_alpha(periods.signal), "_signal")
    size = block_rows([s.alpha for s in (*specs, signal)])
    reach = max(periods.sma - 1, 1)
    state = state.withColumnsRenamed({order: "_last_time"})
    series = with_position(_series(new, "close", key, order), key, order, ties=_ties(new, key, order))
    head = state.select(*key, F.col("n_rows").alias("_before"), "_last_time")
    fresh = series.join(head, list(key), "left")
    late = F.raise_error(F.concat(F.lit("row not after the last one of its series: "), F.col(order).cast("string")))
    fresh = fresh.withColumn("_before", F.when(F.col(order) <= F.col("_last_time"), late.cast("long")).otherwise(F.coalesce("_before", F.lit(0))))
    fresh = fresh.drop("_last_time")
    # The last values of the earlier rows, at positions below 0.
    tail = state.select(*key, F.size("tail").alias("_held"), F.col("n_rows").alias("_before"), F.posexplode("tail").alias("_at", "_x"))
    tail = tail.withColumn("_pos", (F.col("_at") - F.col("_held")).cast("long")).drop("_at", "_held")
    rows = spread_to_blocks(fresh.unionByName(tail, allowMissingColumns=True), size, reach)
    sma = periods.outputs[0]
    moved = _with_move(_with_trailing_mean(rows, key, "_pos", periods.sma, sma), key, "_pos")
    own = own_rows(moved, size).filter("_pos >= 0")
    block = [*[F.col(name) for name in key], F.lit(-1).cast("long").alias("_block")]
    sums = state.select(
        *block,
        *[F.expr(f"{s.out[1:]} * {_weights(s, 'n_rows')}").alias(f"_end_{s.out}") for s in specs],
        F.expr(f"signal * {_weights(signal, 'n_rows')}").alias("_own_end"),
        *[F.lit(0.0).alias(f"_factor_{s.out}") for s in specs[:2]],
    )
    means = _smooth(own, key, "_pos", size, specs, signal.alpha, before=sums)
    last = state.select(*block, F.col("rsi").alias("_rsi_end"), F.col("lost").alias("_lost"))
    valued = _with_rsi(means, key, "_rsi", before=last)
    lost = f"max(_loss) OVER (PARTITION BY {', '.join(f'`{k}`' for k in key)}, _block) > 0"
    ema, rsi = periods.outputs[1:3]
    done = valued.selectExpr(
        *[f"`{name}`" for name in new.columns], sma, f"_ema AS {ema}", f"_rsi AS {rsi}", "macd", "_signal AS macd_signal",
        "macd - _signal AS macd_hist", "_pos + 1 + _before AS _n_rows", *[m for m in _MEANS if m not in ("_ema", "_signal")], f"{lost} AS _lost", "_x",
    )
    rest = new.filter(" OR ".join(f"`{name}` IS NULL" for name in (*key, order)))
    return done.unionByName(rest, allowMissingColumns=True)


def next_state(
    result: DataFrame, state: DataFrame, periods: GoldPeriods = GoldPeriods(), key: Sequence[str] = ("symbol",), order: str = "datetime"
) -> DataFrame:
    """The state after the rows of ``result`` (:func:`continue_indicators`, best stored); keys without new rows keep theirs."""
    ema, rsi = periods.outputs[1:3]
    names = {"_fast": "fast", "_slow": "slow", ema: "ema", "_avg_gain": "avg_gain", "_avg_loss": "avg_loss", "macd_signal": "signal", rsi: "rsi"}
    rows = result.filter("_n_rows IS NOT NULL")
    newest = F.max_by(F.struct(F.col(order), "_n_rows", *[F.col(a).alias(b) for a, b in names.items()]), "_n_rows").alias("newest")
    # Merged before the shuffle: one row per key and task.
    ends = rows.groupBy(*key).agg(newest, F.max("_lost").alias("lost"))
    ends = ends.select(*key, "newest.*", "lost").withColumnsRenamed({"_n_rows": "n_rows"})
    old = state.select(*key, F.col("lost").alias("_lost_before"), F.col("tail").alias("_tail_before"))
    keep = periods.sma - 1 if periods.sma > 1 else 1
    near = rows.select(*key, "_n_rows", "_x").join(ends.select(*key, F.col("n_rows").alias("_end")), list(key))
    near = near.filter(F.col("_n_rows") > F.col("_end") - keep)
    tails = near.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("_n_rows", "_x"))).alias("_new"))
    after = ends.join(tails, list(key)).join(old, list(key), "left")
    tail = F.concat(F.coalesce("_tail_before", F.array().cast("array<double>")), F.col("_new._x"))
    after = after.withColumn("tail", F.slice(tail, F.greatest(F.size(tail) - keep + 1, F.lit(1)), F.lit(keep)))
    after = after.withColumn("lost", F.col("lost") | F.coalesce("_lost_before", F.lit(False)))
    unchanged = state.join(ends.select(*key), list(key), "left_anti")
    return after.select(state.columns).unionByName(unchanged.select(state.columns))


class IndicatorStore:
    """Indicators of an append-only series in a folder: rows by append, and the state after each.

    An append writes its rows, then its state; rows count once their state is there. An append that failed between the
    two is written again under its number. One append runs at a time.
    """

    def __init__(self, spark: SparkSession, path: str, periods: GoldPeriods = GoldPeriods(), key: Sequence[str] = ("symbol",), order: str = "datetime"):
        self.spark, self.path, self.periods, self.key, self.order = spark, path.rstrip("/"), periods, tuple(key), order

    def _exists(self, number: int) -> bool:
        file = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/state-{number}/_SUCCESS")
        return file.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(file)

    def appends(self) -> int:
        """How many appends are complete."""
        number = 0
        while self._exists(number):
            number += 1
        return number

    def append(self, new: DataFrame) -> DataFrame:
        """Add rows that come after all earlier ones of their keys; returns them with their indicators."""
        number = self.appends()
        if number:
            state = self.spark.read.schema(state_schema(new, self.key, self.order)).parquet(f"{self.path}/state-{number - 1}")
        else:
            state = empty_state(self.spark, new, self.key, self.order)
        rows = continue_indicators(new, state, self.periods, self.key, self.order)
        folder = f"{self.path}/rows-{number}"
        rows.write.mode("overwrite").parquet(folder)
        written = self.spark.read.schema(rows.schema).parquet(folder)
        next_state(written, state, self.periods, self.key, self.order).write.mode("overwrite").parquet(f"{self.path}/state-{number}")
        return written.select(*new.columns, *self.periods.outputs)

    def rows(self) -> DataFrame:
        """All rows of complete appends."""
        folders = [f"{self.path}/rows-{number}" for number in range(self.appends())]
        everything = self.spark.read.parquet(*folders)
        return everything.drop("_n_rows", "_fast", "_slow", "_avg_gain", "_avg_loss", "_lost", "_x")
