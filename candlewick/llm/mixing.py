"""Mixing sources to target weights by entropy balancing.

Among all document rates that meet the token targets, entropy balancing takes those nearest to one
copy each (least relative entropy, weighted by size). The optimum is an exponential tilt,
``rate = exp(sum of the multipliers of the document's groups)``, and its convex dual is solved by
Newton steps on the multipliers. Rates become whole copies by a hash of the row and its number among equal rows, and a few exchanges
bring each group's tokens onto its target. Everything is grouped aggregation and joins with the small
table of groups; no group is ever gathered or sorted.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import release, stored

#: Newton steps at most; a step that leaves every target within TOLERANCE of its size ends them.
STEPS, TOLERANCE = 60, 1e-9
#: Rounds of exchanges after the first rounding: by chance of many rows, then of one row per group.
SPREAD, SINGLE = 3, 4
#: Hash values are cut to this many bits to make a number from 0 to 1.
BITS = 52


def word_count(text: Column) -> Column:
    """Runs of anything but a blank or the controls from tab to carriage return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def share_targets(sizes: DataFrame, group: str, size: str, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """Token targets of groups: ``share`` of all tokens dealt by weight, none above ``most`` times its own.

    ``weights`` repeat over the groups in code point order, null last. What a full group leaves is
    dealt to the others by weight until none is above its bound: each target is
    ``min(bound, weight * level)`` for one common level. A group without tokens has target 0; if the
    bounds cannot hold the share, every group gets its bound.
    """
    ranked = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col(group).asc_nulls_last())))
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    full = ranked.withColumn("weight", F.element_at(cycle, ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    full = full.withColumn("bound", F.col(size) * float(most))
    order = Window.orderBy((F.col("bound") / F.col("weight")).asc(), "rank")
    everything = Window.partitionBy()
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    later = order.rowsBetween(0, Window.unboundedFollowing)
    dealt = F.sum(size).over(everything) * float(share)
    # The tokens held by full groups and the level of the rest, if the groups before this one are full.
    level = (dealt - F.coalesce(F.sum("bound").over(earlier), F.lit(0.0))) / F.sum("weight").over(later)
    full = full.withColumn("level", level).withColumn("level", F.max("level").over(everything))
    enough = F.sum("bound").over(everything) <= dealt
    target = F.when(enough, F.col("bound")).otherwise(F.least("bound", F.col("weight") * F.col("level")))
    return full.select(group, F.col(size), target.alias("target"))


def balance(cells: DataFrame, margins: dict[str, DataFrame], size: str, most: float) -> DataFrame:
    """Rates of cells, the combinations of groups, that meet every margin's token targets.

    ``cells``: the margins' columns and the tokens ``size``; ``margins``: column name to a table of
    that column and ``target``. Each Newton step solves one margin's block of the dual, which is
    diagonal since a row lies in one group of a margin: with ``g`` tokens taken by the group and ``h`` the
    part of them below the bound, the multiplier moves by ``(target - g) / h``. The step is limited
    to 2 in either direction; targets of 0 or above what the bound allows end at the bounds.
    """
    spark = cells.sparkSession
    state = {name: stored(table.select(name, "target", F.lit(0.0).alias("multiplier")), "multipliers") for name, table in margins.items()}

    def rated(state: dict[str, DataFrame]) -> DataFrame:
        out = cells
        for name, table in state.items():
            own = table.select(F.col(name).alias("_key"), F.col("multiplier").alias(f"_{name}"), (F.col("target") <= 0).alias(f"_zero_{name}"))
            out = out.join(own, out[name].eqNullSafe(own["_key"]), "left").drop("_key")
        total = reduce(lambda a, b: a + b, [F.coalesce(f"_{name}", F.lit(0.0)) for name in state])
        zero = reduce(lambda a, b: a | b, [F.coalesce(f"_zero_{name}", F.lit(False)) for name in state])
        out = out.withColumn("rate", F.when(zero, 0.0).otherwise(F.least(F.exp(total), F.lit(float(most)))))
        return out.select(*cells.columns, "rate")

    for _ in range(STEPS):
        worst = 0.0
        for name in margins:
            taken = F.col(size) * F.col("rate")
            sums = rated(state).groupBy(F.col(name).alias("_key")).agg(
                F.sum(taken).alias("g"), F.sum(F.when(F.col("rate") < most, taken).otherwise(0.0)).alias("h"), F.sum(size).alias("all")
            )
            now = state[name].join(sums, state[name][name].eqNullSafe(sums["_key"]), "left")
            # At the bound the slope is zero; a small one leads back from it.
            slope = F.greatest(F.col("h"), F.col("g") * 1e-3)
            step = F.greatest(F.lit(-2.0), F.least(F.lit(2.0), (F.col("target") - F.col("g")) / slope))
            reachable = (F.col("target") > 0) & (F.col("all") > 0) & ~((F.col("target") >= F.col("all") * most) & (F.col("h") <= 0))
            step = F.when(reachable, step).otherwise(0.0)
            miss = F.when(reachable, F.abs(F.col("target") - F.col("g")) / F.col("all")).otherwise(0.0)
            state[name] = stored(
                now.select(name, "target", (F.col("multiplier") + F.coalesce(step, F.lit(0.0))).alias("multiplier"), F.coalesce(miss, F.lit(0.0)).alias("miss")),
                "multipliers",
            )
            worst = max(worst, state[name].agg(F.max("miss")).first()[0] or 0.0)
            state[name] = state[name].drop("miss")
        if worst <= TOLERANCE:
            break
    return rated(state)


def _chance(*columns) -> Column:
    """A number from 0 to 1 that depends on the columns only."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 64 - BITS) / float(1 << BITS)


def numbered(rows: DataFrame) -> DataFrame:
    """Add ``number``, which counts the rows of one ``mark`` from 0. ``row`` is a stored ``monotonically_increasing_id``.

    A mark may be on a third of all rows: they are counted within the task that wrote them (the upper bits of
    ``row``), and one small row per mark and task says where its count begins.
    """
    rows = rows.withColumn("_task", F.shiftrightunsigned("row", 33))
    inside = Window.partitionBy("mark", "_task").orderBy("row")
    earlier = Window.partitionBy("mark").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("mark", "_task").agg(F.count(F.lit(1)).alias("_rows"))
    starts = starts.select("mark", "_task", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    placed = rows.withColumn("_rank", F.row_number().over(inside) - 1).join(starts, ["mark", "_task"])
    return placed.withColumn("number", F.col("_start") + F.col("_rank")).drop("_task", "_rank", "_start")


def to_copies(rows: DataFrame, targets: DataFrame, group: str, most: int) -> DataFrame:
    """Whole copies for rows with ``row``, ``mark``, ``number``, ``size``, ``rate`` and the group's column.

    First the rate is rounded up or down by chance of the row's mark and number. Then rows are moved by one copy:
    of those no larger than the group's error, just so many by chance as make it up, a few times; at
    last, one row per group at a time, whose size is nearest to what is still missing.
    """
    kept = [name for name in rows.columns if name != "copies"]
    whole = F.floor(F.round("rate", 9))
    copies = whole + (_chance("mark", "number", F.lit("first")) < F.round("rate", 9) - whole).cast("int")
    now = stored(rows.select(*kept, F.least(copies, F.lit(most)).cast("int").alias("copies")), "copies")
    for turn in range(SPREAD + SINGLE):
        sums = now.groupBy(F.col(group).alias("_key")).agg(F.sum(F.col("copies") * F.col("size")).alias("taken"))
        error = sums.join(targets, sums["_key"].eqNullSafe(targets[group]))
        error = stored(error.select("_key", (F.col("target") - F.col("taken")).alias("missing")), "mix-errors")
        near = now.join(error, now[group].eqNullSafe(error["_key"]), "left")
        movable = F.when(F.col("missing") > 0, F.col("copies") < most).otherwise(F.col("copies") > 0) & (F.col("size") > 0)
        size, missing = F.col("size"), F.abs("missing")
        if turn < SPREAD:
            near = near.withColumn("may", movable & (size <= missing))
            total = near.filter("may").groupBy(F.col("_key").alias("_group")).agg(F.sum("size").alias("all"))
            total = stored(total, "mix-errors")
            near = near.join(total, near["_key"].eqNullSafe(total["_group"]), "left")
            move = F.col("may") & (_chance("mark", "number", F.lit(turn)) < missing / F.col("all"))
        else:
            near = near.withColumn("may", movable & (size < 2 * missing))
            best = near.filter("may").groupBy(F.col("_key").alias("_group")).agg(
                F.min(F.struct(F.abs(size - missing).alias("left"), F.col("mark"), F.col("number"), F.col("row"))).alias("best")
            )
            best = stored(best.select("_group", F.col("best.row").alias("chosen")), "mix-errors")
            near = near.join(best, near["_key"].eqNullSafe(best["_group"]), "left")
            move = F.col("may") & (F.col("row") == F.col("chosen"))
        moved = F.col("copies") + F.when(F.coalesce(move, F.lit(False)), F.signum("missing")).otherwise(0)
        now = stored(near.select(*kept, moved.cast("int").alias("copies")), "copies")
    return now


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (3.0, 1.0, 2.0),
    share: float = 1.5,
    most: int = 2,
    id_column: str = "doc_id",
    text_column: str = "text",
    group_column: str = "source",
    margins: dict[str, DataFrame] | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Copies of every row so that the sources' words come near their targets.

    One row per row of ``docs``: the id, ``size`` (words), ``source_size``, ``target`` (its source's), ``rate``
    (exponentially tilted), ``copies`` (0 to ``most``), ``taken`` (``copies * size``). ``margins``: further
    columns of ``docs`` with tables of (that column, ``target``), which tilt the rates as well. Null and empty
    texts have size 0 and count for nothing; null sources are one group, after all others; an empty table gives no rows.
    A row's chance comes from its id, text and source, and from a number among the rows that are equal in all three: rows
    without an id and rows of one id are drawn each for itself. Reruns give the same copies, however rows are dealt: which of
    several equal rows has which number makes no difference. ``keep``: further columns of ``docs`` that are returned too.
    """
    extra = list(margins or {})
    rows = docs.select(
        F.col(id_column).alias("id"), F.col(group_column).alias("_source"), *[F.col(c).alias(f"_m_{c}") for c in extra],
        *[F.col(c).alias(f"_k_{c}") for c in keep], word_count(F.col(text_column)).alias("size"),
        F.xxhash64(F.col(id_column), F.lit(0), F.col(text_column), F.lit(0), F.col(group_column)).alias("mark"),
    ).withColumn("row", F.monotonically_increasing_id())
    first = stored(rows, "mix-rows")
    rows = stored(numbered(first), "mix-rows")
    release(first)
    keys = ["_source", *[f"_m_{c}" for c in extra]]
    cells = stored(rows.groupBy(*keys).agg(F.sum("size").cast("double").alias("size")), "mix-cells")
    sizes = cells.groupBy("_source").agg(F.sum("size").alias("size"))
    targets = stored(share_targets(sizes, "_source", "size", weights, share, float(most)), "mix-targets")
    tables = {"_source": targets, **{f"_m_{c}": t.select(F.col(c).alias(f"_m_{c}"), F.col("target").cast("double")) for c, t in (margins or {}).items()}}
    rates = stored(balance(cells, tables, "size", float(most)).select(*[F.col(k).alias(f"{k}_key") for k in keys], "rate"), "mix-rates")
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(rates[f"{k}_key"]) for k in keys])
    kept = [f"_k_{c}" for c in keep]
    rated = rows.join(rates, same, "left").select("row", "mark", "number", "id", *kept, "size", "_source", "rate")
    copies = to_copies(rated, targets.select("_source", "target"), "_source", most)
    about = targets.select(F.col("_source").alias("_key"), F.col("size").alias("source_size"), "target")
    out = copies.join(about, copies["_source"].eqNullSafe(about["_key"]), "left")
    return out.select(
        F.col("id").alias(id_column),
        F.col("size").cast("long").alias("size"),
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        "rate",
        "copies",
        (F.col("copies") * F.col("size")).cast("long").alias("taken"),
        *[F.col(f"_k_{c}").alias(c) for c in keep],
    )
