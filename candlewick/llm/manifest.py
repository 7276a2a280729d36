"""Merkle manifest of a dataset: leaf digests of rows, trees per group, one root, and a proof of every leaf.

Checkpoint and recompute: of a group's tree only the leaves and every ``every``-th level are written.
A proof needs the siblings on the leaf's way to the root; the levels between two written ones are made
again for each aligned subtree (``2 ** every`` nodes that share a written ancestor) from its stored
lowest nodes, give their siblings, and are gone with the row. So storage is little more than the
leaves, and no task holds more than one subtree.

Digests are lowercase hex SHA-256; an inner node is the digest of its children's hex texts, one or two
after another. DataFrame operations only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import stored

#: Levels from one written level to the next: an aligned subtree has 2 ** EVERY lowest nodes.
EVERY = 8
#: The registered query tampers with rows whose id's checksum this number divides.
TAMPER = 7
#: The fields of a leaf, in the order in which they are hashed.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_NO_SIBLINGS = "array<struct<left:boolean,node:string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def with_place(rows: DataFrame, group: str, order: Sequence[str]) -> DataFrame:
    """Add ``place``, the 0-based position of a row within its group by ``order``, nulls first.

    Rows are dealt out by ranges of (group, order, a row number), so a hot group or a run of equal rows
    spreads over many tasks; places follow from the row counts per range and group. Rows that are equal in all
    of ``order`` follow one another in any order.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in (group, *order)]
    dealt = rows.withColumn("_n", F.monotonically_increasing_id()).repartitionByRange(parts, *keys, "_n").sortWithinPartitions(*keys, "_n")
    at = F.monotonically_increasing_id()
    dealt = stored(dealt.withColumn("_part", F.shiftright(at, 33)).withColumn("_row", at).drop("_n"), "manifest-order")
    counts = dealt.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_row").alias("_first"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_rows").over(before), F.lit(0)) - F.col("_first")
    starts = stored(counts.select(F.col(group).alias("_group"), F.col("_part").alias("_of"), shift.alias("_shift")), "manifest-starts")
    found = dealt.join(starts, dealt[group].eqNullSafe(starts["_group"]) & (dealt["_part"] == starts["_of"]))
    return found.select(*rows.columns, (F.col("_row") + F.col("_shift")).alias("place"))


def _level_above(nodes: Column) -> Column:
    """Digests of every two consecutive nodes; the last run may have one."""
    runs = F.sequence(F.lit(0), ((F.size(nodes) - 1) / 2).cast("int"))
    return F.transform(runs, lambda i: digest(F.get(nodes, 2 * i), F.coalesce(F.get(nodes, 2 * i + 1), F.lit(""))))


def _up_to(steps: Column) -> Column:
    """0, 1, ... ``steps - 1``."""
    return F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(F.array().cast("array<int>"))


def _levels(lowest: Column, steps: Column) -> Column:
    """A subtree's levels from its lowest nodes up."""
    return F.reduce(_up_to(steps), F.array(lowest), lambda made, _: F.concat(made, F.array(_level_above(F.element_at(made, -1)))))


def _subtrees(nodes: DataFrame, heights: DataFrame, level: int, every: int, keep: Sequence[str] = ()) -> DataFrame:
    """The aligned subtrees over a written level: ``tree``, ``above`` (its ancestor's place), ``members`` by place, ``levels`` made again, ``steps``."""
    found = nodes.withColumn("above", F.shiftright("place", every)).groupBy("tree", "above")
    found = found.agg(F.array_sort(F.collect_list(F.struct("place", "node", *keep))).alias("members"))
    steps = F.greatest(F.least(F.lit(every), F.col("height") - level), F.lit(0))
    found = found.join(heights, "tree").withColumn("steps", steps).drop("height")
    return found.withColumn("levels", _levels(F.transform("members", lambda m: m["node"]), F.col("steps")))


def _ending_at(heights: DataFrame, depth: int, every: int) -> DataFrame:
    """The trees whose top is in the written level ``depth``."""
    return heights.filter((F.col("height") <= depth * every) & (F.col("height") > (depth - 1) * every)).select("tree")


def grow(leaves: DataFrame, every: int = EVERY) -> tuple[list[DataFrame], DataFrame]:
    """The written levels of every tree, and per tree its ``height`` and ``top``.

    ``leaves``: ``tree`` (long), ``place``, ``node``. The top of one leaf is that leaf; otherwise
    levels are halved, rounding up, until one node is left.
    """
    last = leaves.groupBy("tree").agg(F.max("place").alias("last"))
    height = F.when(F.col("last") == 0, 0).otherwise(F.length(F.bin("last")))
    heights = stored(last.select("tree", height.cast("int").alias("height")), "manifest-heights")
    tallest = heights.agg(F.max("height")).first()[0] or 0
    written = [leaves]
    for level in range(0, tallest, every):
        growing = written[-1].join(heights.filter(F.col("height") > level).select("tree"), "tree", "left_semi")
        top = F.get(F.element_at("levels", -1), F.lit(0))
        trees = _subtrees(growing, heights, level, every)
        written.append(stored(trees.select("tree", F.col("above").alias("place"), top.alias("node")), "manifest-level"))
    tops = None
    for depth, nodes in enumerate(written):
        own = nodes.select("tree", F.col("node").alias("top")).join(_ending_at(heights, depth, every), "tree", "left_semi")
        tops = own if tops is None else tops.unionByName(own)
    return written, heights.join(stored(tops, "manifest-tops"), "tree")


def prove(
    written: Sequence[DataFrame], tops: DataFrame, roots: DataFrame | None = None, keep: Sequence[str] = (), every: int = EVERY
) -> DataFrame:
    """``tree``, ``place``, ``node``, the leaves' columns ``keep`` and the ``siblings`` of every leaf from its own level up.

    A sibling has ``left`` (it comes before the node) and ``node``; it is null where a node stood
    alone. From the top down, the subtrees of each written level are made again, and each of their lowest nodes
    has its siblings there and then those of its ancestor. ``roots``: ``tree`` and the ``siblings`` of the tree's top.
    """
    heights = tops.select("tree", "height")
    first = tops.select("tree", F.lit(0).cast("long").alias("above"))
    if roots is None:
        first = first.withColumn("upper", F.array().cast(_NO_SIBLINGS))
    else:
        first = first.join(roots.select("tree", F.col("siblings").alias("upper")), "tree")
    upper = None
    for depth in range(len(written) - 1, -1, -1):
        own = list(keep) if depth == 0 else []
        ending = first.join(_ending_at(heights, depth, every), "tree", "left_semi")
        upper = ending if upper is None else upper.unionByName(ending)
        trees = _subtrees(written[depth], heights, depth * every, every, own).join(upper, ["tree", "above"])

        def siblings(member: Column) -> Column:
            start = (member["place"] - F.shiftleft("above", every)).cast("int")

            def at_step(step: Column) -> Column:
                at = (start / F.pow(F.lit(2.0), step)).cast("int")
                left = at % 2 == 1
                other = F.get(F.get(F.col("levels"), step), F.when(left, at - 1).otherwise(at + 1))
                return F.when(other.isNotNull(), F.struct(left.alias("left"), other.alias("node")))

            return F.concat(F.transform(_up_to(F.col("steps")), at_step), F.col("upper"))

        proofs = F.transform("members", lambda m: F.struct(*[m[c].alias(c) for c in ("place", "node", *own)], siblings(m).alias("siblings")))
        found = trees.select("tree", F.explode(proofs).alias("_m")).select("tree", "_m.*")
        if depth == 0:
            return found
        upper = stored(found.select("tree", F.col("place").alias("above"), F.col("siblings").alias("upper")), "manifest-proofs")


def fold(leaf: Column, siblings: Column) -> Column:
    """The root that a leaf and its siblings lead to."""

    def up(node: Column, other: Column) -> Column:
        return F.when(other.isNull(), digest(node)).when(other["left"], digest(other["node"], node)).otherwise(digest(node, other["node"]))

    return F.reduce(siblings, leaf, up)


def manifest(
    docs: DataFrame,
    fields: Sequence[str] = FIELDS,
    id_column: str = "doc_id",
    group_column: str = "lang",
    altered: Mapping[str, Column] | None = None,
    every: int = EVERY,
) -> DataFrame:
    """Every row's leaf, its group's subroot, the root of all, its proof, and whether the row now at hand leads to the root.

    Columns: the id, ``leaf``, ``subroot``, ``root``, ``siblings``, ``folded_root`` (from the row with the columns ``altered``
    in place of its own, and the original siblings), ``verified``. Leaves ascend by id within a group, null ids first,
    rows of one id by leaf; equal rows have equal leaves, so their order is of no matter, but each has its
    own place and proof. Groups ascend by the bytes of their text, null first; a null group is one like any other.
    Null fields count as ``-`` and empty ones as ``0:``. Other columns are not read. An empty table gives no rows.
    """
    altered = dict(altered or {})
    leaf = digest(*[framed(F.col(c)) for c in fields])
    now = digest(*[framed(altered.get(c, F.col(c))) for c in fields])
    rows = docs.select(F.col(id_column).alias("id"), F.col(group_column).cast("string").alias("group"), leaf.alias("node"), now.alias("now"))
    placed = with_place(stored(rows, "manifest-rows"), "group", ["id", "node"])
    groups = placed.select("group").distinct().withColumn("all", F.lit(0))
    trees = stored(with_place(groups, "all", ["group"]).select(F.col("group").alias("_group"), F.col("place").alias("tree")), "manifest-groups")
    leaves = placed.join(trees, placed["group"].eqNullSafe(trees["_group"])).select("tree", "place", "node", "id", "now")
    leaves = stored(leaves, "manifest-leaves")
    written, tops = grow(leaves.select("tree", "place", "node"), every)
    above, summit = grow(tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.col("top").alias("node")), every)
    root = (summit.first() or {"top": None})["top"]
    roots = prove(above, summit, every=every).select(F.col("place").alias("tree"), "siblings")
    proofs = prove([leaves, *written[1:]], tops, stored(roots, "manifest-roots"), ["id", "now"], every)
    found = proofs.join(tops.select("tree", F.col("top").alias("subroot")), "tree")
    found = found.withColumn("root", F.lit(root).cast("string")).withColumn("folded_root", fold(F.col("now"), F.col("siblings")))
    return found.select(
        F.col("id").alias(id_column),
        F.col("node").alias("leaf"),
        "subroot",
        "root",
        "siblings",
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
