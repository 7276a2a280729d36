"""SMA, EMA, RSI and MACD of long series.

All functions give back the rows they are given, repeated times included: rows of
one time follow in the order of their other columns. The columns travel with the
series; nothing is joined back by time. The series is cut into blocks of equal row count:

* trailing windows see copies of the rows just before their block;
* an exponential mean is the block's own weighted sum plus the sums of the
  blocks before it, weighted by their distance. Blocks whose weight is below the
  smallest double add nothing and are left out.

No step sorts or collects a whole symbol in one task, and no weight overflows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.functions.scalars import to_number
from candlewick.operators.clean import drop_incomplete
from candlewick.operators.ordering import own_rows, spread_to_blocks, with_position

LOCAL_WEIGHT_RANGE = 150 * math.log(10)  # weights inside a block span at most 150 decimal orders
SMALLEST_WEIGHT = 745.0  # exp(-745) is below the smallest double
MAX_BLOCK_ROWS = 65_536


@dataclass(frozen=True)
class Smoothing:
    """One exponential mean: input column, weight of the newest row, output column."""

    source: str
    alpha: float
    out: str

    @property
    def base(self) -> float:
        return 1.0 - self.alpha

    @property
    def decay(self) -> float:
        return -math.log(self.base)


def span_alpha(span: float) -> float:
    return 2.0 / (span + 1.0)


def block_rows(alphas: Sequence[float], reach: int = 0) -> int:
    """Rows per block: small enough for the fastest decay, else large against ``reach``."""
    if not alphas:
        return max(8192, 8 * reach)
    fastest = max(Smoothing("", alpha, "").decay for alpha in alphas)
    return max(1, min(MAX_BLOCK_ROWS, int(LOCAL_WEIGHT_RANGE / fastest)))


def _weight(spec: Smoothing, distance: str) -> str:
    return f"pow({spec.base!r}D, {distance})"


def _weights(spec: Smoothing, rows: str) -> str:
    """The weights of so many rows have a closed form."""
    return f"((1 - {_weight(spec, rows)}) / {1 - spec.base!r}D)"


def _mean(spec: Smoothing, numerator: str, rows: str = "_pos + 1") -> str:
    """Weighted mean from the weighted sum of so many rows."""
    return f"({numerator}) / {_weights(spec, rows)}"


def _steps(specs: Sequence[Smoothing], size: int) -> int:
    """How many earlier blocks have a weight that a double can hold."""
    return 1 + max(math.ceil(SMALLEST_WEIGHT / (spec.decay * size)) for spec in specs)


def _fan_out(ends: DataFrame, steps: int) -> DataFrame:
    """Copy each block's sums to itself (step 0) and to the next ``steps`` blocks."""
    copies = ends.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(steps))))
    return copies.withColumn("_block", F.expr("_block + _step"))


def _arriving(spec: Smoothing, size: int) -> Column:
    """Sum of what earlier blocks bring into a block, in weights of the row before its first."""
    weight = _weight(spec, f"{size} * (_step - 1)")
    return F.expr(f"sum(if(_step > 0, _end_{spec.out} * {weight}, 0D)) AS _carry_{spec.out}")


def _staying(name: str) -> Column:
    return F.expr(f"max(if(_step = 0, {name}, NULL)) AS {name}")


def _smooth(
    rows: DataFrame,
    key: Sequence[str],
    order: str,
    size: int,
    specs: Sequence[Smoothing],
    signal_alpha: float | None = None,
    before: DataFrame | None = None,
) -> DataFrame:
    """Add the exponential means to rows that carry ``_pos`` and ``_block``.

    ``before`` (with the signal only): what earlier rows of each key have left, as the sums of a block -1; rows then
    carry ``_before``, their number.

    With ``signal_alpha``, the first two means are the fast and the slow line:
    adds ``macd`` (fast minus slow) and ``_signal``, its exponential mean. A
    block's share of the signal is linear in the sums brought into the block, so
    the signal needs no second pass over the rows to find its block sums.
    """
    block = [*key, "_block"]
    quoted = ", ".join(f"`{name}`" for name in block)
    running = f"OVER (PARTITION BY {quoted} ORDER BY `{order}` ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    local = f"pmod(_pos, {size})"
    to_end = f"{size - 1} - {local}"
    value = {s.out: f"coalesce({s.source}, 0D)" for s in specs}

    def running_sum(column: str, spec: Smoothing) -> str:
        return f"sum({column} * {_weight(spec, f'-{local}')}) {running} * {_weight(spec, local)}"

    def numerator(spec: Smoothing) -> str:
        return f"coalesce(_carry_{spec.out}, 0D) * {_weight(spec, f'{local} + 1')} + _own_{spec.out}"

    sums = rows.selectExpr("*", *[f"{running_sum(value[s.out], s)} AS _own_{s.out}" for s in specs])
    block_sums = [f"sum({value[s.out]} * {_weight(s, to_end)}) AS _end_{s.out}" for s in specs]
    if signal_alpha is None:
        ends = sums.groupBy(*block).agg(*map(F.expr, block_sums))
        carry = _fan_out(ends, _steps(specs, size)).groupBy(*block).agg(*[_arriving(s, size) for s in specs])
        joined = sums.join(carry, block, "left")
        return joined.selectExpr(*rows.columns, *[f"{_mean(s, numerator(s))} AS {s.out}" for s in specs])

    count = "_pos + 1" if before is None else "_pos + 1 + _before"
    signal = Smoothing("macd", signal_alpha, "_signal")
    lines = specs[:2]
    fast, slow = lines
    share = _weight(signal, to_end)
    gap = f"({_mean(fast, f'_own_{fast.out}', count)} - {_mean(slow, f'_own_{slow.out}', count)})"
    block_sums.append(f"sum({gap} * {share}) AS _own_end")
    for s in lines:
        block_sums.append(f"sum({_mean(s, _weight(s, f'{local} + 1'), count)} * {share}) AS _factor_{s.out}")
    ends = sums.groupBy(*block).agg(*map(F.expr, block_sums))
    if before is not None:
        ends = ends.unionByName(before)
    carried = [f"_carry_{s.out}" for s in specs]
    kept = ["_own_end", *[f"_factor_{s.out}" for s in lines]]
    first = _fan_out(ends, _steps(specs, size)).groupBy(*block)
    brought = [f"_carry_{s.out} * _factor_{s.out}" for s in lines]
    second = first.agg(*[_arriving(s, size) for s in specs], *map(_staying, kept)).selectExpr(
        *block, *carried, f"_own_end + {brought[0]} - {brought[1]} AS _end__signal"
    )
    carry = _fan_out(second, _steps([signal], size)).groupBy(*block)
    carry = carry.agg(_arriving(signal, size), *map(_staying, carried))

    means = sums.join(carry, block, "left").selectExpr(
        *rows.columns, *[f"{_mean(s, numerator(s), count)} AS {s.out}" for s in specs], "_carry__signal"
    )
    with_line = means.selectExpr("*", f"{fast.out} - {slow.out} AS macd")
    own = with_line.selectExpr("*", f"{running_sum('macd', signal)} AS _own__signal")
    return own.selectExpr("*", f"{_mean(signal, numerator(signal), count)} AS _signal")


def _with_trailing_mean(rows: DataFrame, key: Sequence[str], order: str, n: int, out: str) -> DataFrame:
    """Add the mean of ``_x`` over the last ``n`` rows of the block.

    A sliding frame adds up all ``n`` values for every row. Here a short frame
    gives sums of about sqrt(n) rows, and the long sum is put together from
    those of earlier rows; nothing is ever subtracted. The number of values
    comes from a running count.
    """
    quoted = ", ".join(f"`{name}`" for name in [*key, "_block"])
    over = f"(PARTITION BY {quoted} ORDER BY `{order}`"
    width = max(1, math.isqrt(n))
    pieces = n // width
    parts = [f"sum(_x) OVER {over} ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS _piece"]
    if n > pieces * width:
        frame = f"ROWS BETWEEN {n - 1} PRECEDING AND {pieces * width} PRECEDING"
        parts.append(f"coalesce(sum(_x) OVER {over} {frame}), 0D) AS _rest")
    else:
        parts.append("0D AS _rest")
    parts.append(f"count(_x) OVER {over} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _count")
    pieces_sum = " + ".join(
        ["coalesce(_piece, 0D)", *[f"coalesce(lag(_piece, {i * width}) OVER {over}), 0D)" for i in range(1, pieces)]]
    )
    total, count = f"{pieces_sum} + _rest AS _sum", f"_count - coalesce(lag(_count, {n}) OVER {over}), 0L) AS _values"
    return rows.selectExpr("*", *parts).selectExpr(*rows.columns, total, count).selectExpr(
        *rows.columns, f"try_divide(_sum, _values) AS {out}"
    )


def _with_move(rows: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Add ``_gain`` and ``_loss`` against the previous row; both 0 in the first row."""
    quoted = ", ".join(f"`{name}`" for name in key)
    delta = f"_x - lag(_x) OVER (PARTITION BY {quoted}, _block ORDER BY `{order}`) AS _delta"
    return rows.selectExpr("*", delta).selectExpr(
        "*", "if(_delta > 0, _delta, 0D) AS _gain", "if(_delta < 0, -_delta, 0D) AS _loss"
    )


def _rsi_value(gain: str, loss: str, lost: str) -> str:
    """RSI from the averages; 100 if losses have faded beyond what a double holds, null if there were none."""
    return f"if({loss} > 0 AND greatest({gain}, {loss}) > 1e-290D, 100 - 100 / (1 + {gain} / {loss}), if({lost}, 100D, NULL))"


def _with_rsi(rows: DataFrame, key: Sequence[str], out: str, no_loss: float | None = None, before: DataFrame | None = None) -> DataFrame:
    """Add the RSI to rows with ``_gain``, ``_loss`` and their averages.

    A row without a move scales both averages alike and so has the last moving row's value. Averages
    underflow in a long flat stretch, so the value is taken where there is a move and carried on: inside a block by
    a window, across blocks by one small row for each block. ``before``: ``_rsi_end`` and ``_lost`` of earlier rows, as of a block -1.
    """
    block = [*key, "_block"]
    keys, blocks = (", ".join(f"`{name}`" for name in names) for names in (key, block))
    moves = "_gain > 0 OR _loss > 0"
    ends = rows.groupBy(*block).agg(
        F.expr(f"max_by(_avg_gain, _pos) FILTER (WHERE {moves})").alias("_gain_end"),
        F.expr(f"max_by(_avg_loss, _pos) FILTER (WHERE {moves})").alias("_loss_end"),
        F.expr("bool_or(_loss > 0)").alias("_lost"),
    )
    if before is not None:
        ends = ends.withColumn("_rsi_end", F.lit(None).cast("double")).unionByName(before, allowMissingColumns=True)
    earlier = f"OVER (PARTITION BY {keys} ORDER BY _block ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    ends = ends.selectExpr("*", f"coalesce(bool_or(_lost) {earlier}, false) AS _lost_before")
    known = "NULL" if before is None else "_rsi_end"
    ends = ends.selectExpr("*", f"if(_gain_end IS NULL, {known}, {_rsi_value('_gain_end', '_loss_end', '_lost OR _lost_before')}) AS _rsi_last")
    ends = ends.selectExpr(*block, "_lost_before", f"last(_rsi_last, true) {earlier} AS _rsi_before")
    running = f"OVER (PARTITION BY {blocks} ORDER BY _pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    joined = rows.join(ends, block, "left").selectExpr("*", f"_lost_before OR bool_or(_loss > 0) {running} AS _lost")
    valued = joined.selectExpr("*", f"if({moves}, {_rsi_value('_avg_gain', '_avg_loss', '_lost')}, NULL) AS _rsi_here")
    value = f"coalesce(last(_rsi_here, true) {running}, _rsi_before)"
    value = value if no_loss is None else f"coalesce({value}, {float(no_loss)!r}D)"
    return valued.selectExpr(*rows.columns, f"{value} AS {out}")


def _series(df: DataFrame, column: str, key: Sequence[str], order: str) -> DataFrame:
    return drop_incomplete(df.withColumn("_x", to_number(column)), [*key, order])


def _ties(df: DataFrame, key: Sequence[str], order: str) -> list[str]:
    """The columns that decide between rows of one time: all others that can be ordered."""
    unordered = (T.MapType, T.VariantType)
    return [f.name for f in df.schema.fields if f.name not in (*key, order) and not isinstance(f.dataType, unordered)]


def _all_rows(df: DataFrame, result: DataFrame, key: Sequence[str], order: str, outputs: Sequence[str]) -> DataFrame:
    """The result and, with null results, the rows that have no key or time."""
    done = result.select(*df.columns, *outputs)
    if not any(df.schema[name].nullable for name in (*key, order)):
        return done
    rest = df.filter(" OR ".join(f"`{name}` IS NULL" for name in (*key, order)))
    return done.unionByName(rest.select(*df.columns, *[F.lit(None).cast("double").alias(name) for name in outputs]))


def sma(
    df: DataFrame,
    col: str = "close",
    n: int = 200,
    out: str | None = None,
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
    min_rows: int = 1,
) -> DataFrame:
    """Mean of the last up to ``n`` values; shorter at the start unless ``min_rows`` asks for more rows."""
    out = out or f"sma_{n}"
    size = block_rows([], n - 1)
    placed = with_position(_series(df, col, key, order), key, order, ties=_ties(df, key, order))
    rows = spread_to_blocks(placed, size, n - 1)
    result = own_rows(_with_trailing_mean(rows, key, "_pos", n, "_mean"), size).withColumn(
        out, F.when(F.col("_pos") + 1 >= min_rows, F.col("_mean"))
    )
    return _all_rows(df, result, key, order, [out])


def ema(
    df: DataFrame,
    col: str = "close",
    span: float | None = None,
    out: str | None = None,
    alpha: float | None = None,
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
) -> DataFrame:
    """Exponential mean with normalised weights, from ``span`` or ``alpha``.

    A missing value adds nothing, but its place still counts in the weights.
    The result is null until the first value.
    """
    if (span is None) == (alpha is None):
        raise ValueError("give span or alpha")
    alpha = span_alpha(span) if alpha is None else alpha
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie in (0, 1]")
    out = out or (f"ema_{span:g}" if span is not None else "ema")
    if alpha == 1:  # all weight on the newest row
        return df.withColumn(out, to_number(col))
    size = block_rows([alpha])
    placed = with_position(_series(df, col, key, order), key, order, count_values="_x", ties=_ties(df, key, order))
    rows = spread_to_blocks(placed, size)
    result = _smooth(rows, key, "_pos", size, [Smoothing("_x", alpha, "_mean")])
    result = result.withColumn(out, F.when(F.col("_seen") > 0, F.col("_mean")))
    return _all_rows(df, result, key, order, [out])


def rsi(
    df: DataFrame,
    col: str = "close",
    period: int = 14,
    out: str | None = None,
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
    no_loss: float | None = None,
) -> DataFrame:
    """Relative strength with Wilder's smoothing; ``no_loss`` (default null) while there was no loss.

    Through rows without a move, however many, the value stays what it was.
    """
    out = out or f"rsi_{period}"
    if period < 2:
        raise ValueError("period must be at least 2")
    alpha = 1.0 / period
    size = block_rows([alpha])
    placed = with_position(_series(df, col, key, order), key, order, ties=_ties(df, key, order))
    moved = _with_move(spread_to_blocks(placed, size, 1), key, "_pos")
    specs = [Smoothing("_gain", alpha, "_avg_gain"), Smoothing("_loss", alpha, "_avg_loss")]
    result = _with_rsi(_smooth(own_rows(moved, size), key, "_pos", size, specs), key, out, no_loss)
    return _all_rows(df, result, key, order, [out])


def macd(
    df: DataFrame,
    col: str = "close",
    fast: int = 12,
    slow: int = 26,
    signal: int = 9,
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
) -> DataFrame:
    """Fast minus slow exponential mean (``macd``), its mean (``macd_signal``) and their gap (``macd_hist``)."""
    alphas = [span_alpha(span) for span in (fast, slow, signal)]
    size = block_rows(alphas)
    placed = with_position(_series(df, col, key, order), key, order, count_values="_x", ties=_ties(df, key, order))
    rows = spread_to_blocks(placed, size)
    lines = [Smoothing("_x", alphas[0], "_fast"), Smoothing("_x", alphas[1], "_slow")]
    means = _smooth(rows, key, "_pos", size, lines, alphas[2])
    result = means.selectExpr(
        *[f"`{name}`" for name in df.columns],
        "if(_seen > 0, macd, NULL) AS macd",
        "if(_seen > 0, _signal, NULL) AS macd_signal",
        "if(_seen > 0, macd - _signal, NULL) AS macd_hist",
    )
    return _all_rows(df, result, key, order, ["macd", "macd_signal", "macd_hist"])


@dataclass(frozen=True)
class GoldPeriods:
    """Periods of the indicator table."""

    sma: int = 200
    ema: int = 50
    rsi: int = 14
    fast: int = 12
    slow: int = 26
    signal: int = 9

    @property
    def outputs(self) -> list[str]:
        return [f"sma_{self.sma}", f"ema_{self.ema}", f"rsi_{self.rsi}", "macd", "macd_signal", "macd_hist"]


def all_indicators(
    df: DataFrame,
    periods: GoldPeriods = GoldPeriods(),
    key: Sequence[str] = ("symbol",),
    order: str = "datetime",
    complete: bool = False,
) -> DataFrame:
    """All indicators of ``close`` over one set of blocks; rows need a close. ``complete``: none lacks its key or time."""
    wilder = 1.0 / periods.rsi
    alphas = [span_alpha(span) for span in (periods.ema, periods.fast, periods.slow, periods.signal)]
    size = block_rows([*alphas, wilder])
    reach = max(periods.sma - 1, 1)
    if reach > size // 2 and periods.sma > 2:  # too many copies for these blocks: average in larger ones
        others = all_indicators(df, replace(periods, sma=1), key, order, complete)
        return sma(others, "close", periods.sma, key=key, order=order).select(*df.columns, *periods.outputs)
    sma_out, ema_out, rsi_out = periods.outputs[:3]
    placed = with_position(_series(df, "close", key, order), key, order, ties=_ties(df, key, order))
    rows = spread_to_blocks(placed, size, reach)
    moved = _with_move(_with_trailing_mean(rows, key, "_pos", periods.sma, sma_out), key, "_pos")
    specs = [
        Smoothing("_x", alphas[1], "_fast"),
        Smoothing("_x", alphas[2], "_slow"),
        Smoothing("_x", alphas[0], ema_out),
        Smoothing("_gain", wilder, "_avg_gain"),
        Smoothing("_loss", wilder, "_avg_loss"),
    ]
    means = _with_rsi(_smooth(own_rows(moved, size), key, "_pos", size, specs, alphas[3]), key, rsi_out)
    result = means.selectExpr(
        *[f"`{name}`" for name in df.columns],
        sma_out,
        ema_out,
        rsi_out,
        "macd",
        "_signal AS macd_signal",
        "macd - _signal AS macd_hist",
    )
    return result.select(*df.columns, *periods.outputs) if complete else _all_rows(df, result, key, order, periods.outputs)
