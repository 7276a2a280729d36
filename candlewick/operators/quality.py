"""Profiles, sanity checks, duplicates, coverage and gaps of bar tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from candlewick.operators.clean import KEY, value_columns
from candlewick.operators.quantiles import exact_quantiles, first_look
from candlewick.session import stored

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Per column: null count, null percentage and type; most nulls first. One scan for all columns."""
    chosen = T.StructType([df.schema[name] for name in columns or df.columns])
    counts = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(f"`{name}`").isNull()).alias(f"_null_{i}") for i, name in enumerate(chosen.names)],
    )
    return null_table(counts, chosen)


def null_table(counts: DataFrame, schema: T.StructType) -> DataFrame:
    """The null profile of ``schema``'s columns from one row with ``_rows`` and, by place, ``_null_0``, ``_null_1`` and so on."""
    entries = F.array(
        *[
            F.struct(
                F.lit(field.name).alias("column"), F.col(f"_null_{i}").alias("null_count"), F.lit(field.dataType.simpleString()).alias("dtype")
            )
            for i, field in enumerate(schema.fields)
        ]
    )
    return (
        counts.select("_rows", F.explode(entries).alias("_entry"))
        .select(
            "_entry.column",
            "_entry.null_count",
            F.bround(F.try_divide(F.col("_entry.null_count") * 100.0, F.col("_rows")), 3).alias("null_pct"),
            "_entry.dtype",
        )
        .orderBy(F.desc("null_count"), "column")
    )


def ohlc_sanity() -> list[Column]:
    """Counts of rows with high below low and with a close outside [low, high]; nulls count as fine."""
    outside = (F.col("close") < F.col("low")) | (F.col("close") > F.col("high"))
    return [
        F.count_if(F.col("high") < F.col("low")).alias("high_below_low"),
        F.count_if(outside).alias("close_outside"),
    ]


def key_counts(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Rows per key; null keys form a group of their own. Copies merge before the shuffle."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows"))


def quality_report(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """One row: rows, extra copies of keys, rows without a time, OHLC problems."""
    checks = ohlc_sanity() if all(name in df.columns for name in ("open", "high", "low", "close")) else []
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), *checks)
    names = [name for name in per_key.columns if name not in (*key, "_n")]
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicate_keys"),
        F.coalesce(F.sum(F.when(F.col("datetime").isNull(), F.col("_n"))), F.lit(0)).alias("invalid_datetimes"),
        *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in names],
    )


def duplicate_count(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """Extra rows beyond the first of each key."""
    return key_counts(df, key).agg(F.coalesce(F.sum(F.col("n_rows") - 1), F.lit(0)).alias("duplicate_keys"))


def _on_key(left: str, right: str, key: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in key:
        condition = condition & F.col(f"{left}.{name}").eqNullSafe(F.col(f"{right}.{name}"))
    return condition


def duplicated_rows(df: DataFrame, key: Sequence[str] = tuple(KEY)) -> DataFrame:
    """All copies of keys that occur more than once.

    The repeated keys come from a pre-aggregated count and are stored, so Spark
    knows their size: a short list is broadcast and the rows need no shuffle; a
    long one is sort-merged, split at hot keys by adaptive execution. No window
    gathers the copies of a key.
    """
    repeated = stored(key_counts(df, key).filter("n_rows > 1").select(*key), "repeated-keys")
    return df.alias("rows").join(repeated.alias("repeated"), _on_key("rows", "repeated", key), "left_semi")


def mark_repeats(df: DataFrame, order: Sequence[str], key: Sequence[str] = tuple(KEY), out: str = "repeat") -> DataFrame:
    """Mark the second and later copies of a key; ``order`` decides which is first and must be unique per key."""
    first = df.groupBy(*key).agg(F.min(F.struct(*order)).alias("_first"))
    joined = df.alias("rows").join(first.alias("first"), _on_key("rows", "first", key))
    return joined.select("rows.*", (F.struct(*[F.col(f"rows.{c}") for c in order]) != F.col("first._first")).alias(out))


def describe_by(
    df: DataFrame, key: str = "symbol", columns: Sequence[str] | None = None, approximate: bool = False
) -> DataFrame:
    """Per key and column: count, mean, std, min, quartiles, max, rounded to 6 places. Null keys are left out.

    Quartiles are exact unless ``approximate`` asks for sketches.
    """
    names, probs = list(columns or value_columns(df)), list(QUARTILES.values())
    rows = df.filter(F.col(key).isNotNull()).select(key, *names)

    def looked(name: str) -> Column:
        basic = {"count": F.count(name), "mean": F.avg(name), "std": F.stddev_samp(name), "min": F.min(name), "max": F.max(name)}
        more = [F.percentile_approx(name, probs).alias("_sketch")] if approximate else first_look(name, probs)
        return F.struct(F.lit(name).alias("column"), *[value.alias(stat) for stat, value in basic.items()], *more)

    # The first scan takes each column as it is; only the later ones, for the values' bins, put columns one below the other.
    wide = rows.groupBy(key).agg(F.array(*[looked(name) for name in names]).alias("_all"))
    summary = wide.select(key, F.explode("_all").alias("_one")).select(key, "_one.*")
    group = [key, "column"]
    if approximate:
        stats = summary.withColumns({name: F.col("_sketch")[i] for i, name in enumerate(QUARTILES)})
    else:
        entries = F.array(*[F.struct(F.lit(name).alias("column"), F.col(name).alias("value")) for name in names])
        long = rows.select(key, F.explode(entries).alias("_e")).select(key, "_e.*")
        stats = exact_quantiles(long, group, "value", probs, list(QUARTILES), summary=summary)
    floats = ["mean", "std", "min", *QUARTILES, "max"]
    return stats.select(*group, "count", *[F.bround(name, 6).alias(name) for name in floats])


def coverage_check(df: DataFrame, years: int = 4, tolerance_days: int = 2, key: str = "symbol") -> DataFrame:
    """Per key: does its time range span ``years``, give or take the tolerance?"""
    target = F.col("start") + F.make_interval(F.lit(years))
    gap = F.abs(F.unix_micros("end") - F.unix_micros("target_end"))
    day = 86_400_000_000
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.min("datetime").alias("start"), F.max("datetime").alias("end"))
        .withColumn("target_end", target)
        .select(
            key,
            "start",
            "end",
            "target_end",
            ((F.unix_micros("end") - F.unix_micros("start")) / F.lit(float(day))).alias("delta_days"),
            F.coalesce(gap <= tolerance_days * day, F.lit(False)).alias("ok"),
            F.lit(tolerance_days).alias("tolerance_days"),
            F.when(F.col("start").isNull(), F.lit("no valid dates")).alias("reason"),
        )
    )


def gap_check(df: DataFrame, key: str = "symbol", step_days: int = 1) -> DataFrame:
    """Per key: rows, distinct times, repeated rows, expected steps from first to last time, missing steps.

    Rows without a time are rows too, and repeat each other; a key without any time expects no steps.
    """
    span = F.unix_micros("_last") - F.unix_micros("_first")
    per_time = df.groupBy(key, "datetime").agg(F.count(F.lit(1)).alias("_n"))
    return (
        per_time.groupBy(key)
        .agg(
            F.sum("_n").alias("n_rows"),
            F.count("datetime").alias("n_times"),
            F.sum(F.col("_n") - 1).alias("n_repeated"),
            F.min("datetime").alias("_first"),
            F.max("datetime").alias("_last"),
        )
        .withColumn("expected", F.coalesce(F.floor(span / F.lit(step_days * 86_400_000_000)) + 1, F.lit(0)))
        .select(
            key,
            "n_rows",
            "n_times",
            "n_repeated",
            "expected",
            (F.col("expected") - F.col("n_times")).alias("missing"),
        )
    )


def gap_intervals(df: DataFrame, key: str = "symbol", step_days: int = 1, block: int = 4096) -> DataFrame:
    """Runs of expected times, from first to last in whole steps, that no row has: ``first_missing``, ``last_missing``, ``n_missing``.

    Gaps and islands: a gap follows a time whose next one is more than a step away. Next times are found within blocks of
    ``block`` steps, and across them over one row per key and block, so one key's times spread over many tasks, and
    a far-off time is one row. Times that are no whole steps from the first one fill no gap. Null keys are a key.
    """
    step = step_days * 86_400_000_000
    known = df.filter(F.col("datetime").isNotNull())
    span = known.groupBy(key).agg(F.min(F.unix_micros("datetime")).alias("_from"), F.max(F.unix_micros("datetime")).alias("_to"))
    span = stored(span.select(F.col(key).alias("_key"), "_from", F.floor((F.col("_to") - F.col("_from")) / F.lit(step)).alias("_end")), "gap-spans")
    placed = known.select(key, F.unix_micros("datetime").alias("_at")).distinct()
    placed = placed.join(span, placed[key].eqNullSafe(span["_key"])).withColumn("_off", F.col("_at") - F.col("_from"))
    placed = placed.filter(F.col("_off") % step == 0).withColumn("_i", (F.col("_off") / F.lit(step)).cast("long"))
    placed = placed.withColumn("_block", F.floor(F.col("_i") / F.lit(block)))
    heads = placed.groupBy(F.col(key).alias("_of"), F.col("_block").alias("_in")).agg(F.min("_i").alias("_head"))
    after = F.lead("_head").over(Window.partitionBy("_of").orderBy("_in"))
    heads = stored(heads.select("_of", "_in", after.alias("_after")), "gap-blocks")
    following = F.lead("_i").over(Window.partitionBy(key, "_block").orderBy("_i"))
    ends = placed.withColumn("_next", following).join(heads, placed[key].eqNullSafe(heads["_of"]) & (F.col("_block") == F.col("_in")))
    until = F.coalesce("_next", "_after", F.col("_end") + 1)
    gaps = ends.withColumn("_until", until).filter(F.col("_until") > F.col("_i") + 1)
    at = lambda index: F.timestamp_micros(F.col("_from") + index * step)
    return gaps.select(
        key, at(F.col("_i") + 1).alias("first_missing"), at(F.col("_until") - 1).alias("last_missing"), (F.col("_until") - F.col("_i") - 1).alias("n_missing")
    )


def missing_days(df: DataFrame, key: str = "symbol", step_days: int = 1) -> DataFrame:
    """The expected times, from first to last in whole steps, that no row has.

    Gaps become times in two steps, so no list is longer than 4,096 entries, however far apart two times lie.
    """
    step, most = step_days * 86_400_000_000, 4096
    gaps = gap_intervals(df, key, step_days).withColumn("_from", F.unix_micros("first_missing"))
    pieces = gaps.select(key, "_from", "n_missing", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_missing") - 1, F.lit(most).cast("long"))).alias("_piece"))
    last = F.least(F.col("_piece") + (most - 1), F.col("n_missing") - 1)
    steps = pieces.select(key, "_from", F.explode(F.sequence("_piece", last)).alias("_i"))
    return steps.select(key, F.timestamp_micros(F.col("_from") + F.col("_i") * step).alias("datetime"))


def value_range(df: DataFrame, column: str = "close") -> DataFrame:
    """Smallest and largest value and the number of nulls."""
    return df.agg(
        F.min(column).alias(f"min_{column}"),
        F.max(column).alias(f"max_{column}"),
        F.count_if(F.col(column).isNull()).alias(f"null_{column}"),
    )
