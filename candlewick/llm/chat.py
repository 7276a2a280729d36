"""Reply trees to formatted conversations, in DataFrame operations only.

A table of messages with parents is a forest. Self-joins that double the distance to the ancestor
each time find every message's root and the score of its path; the leaves of a tree are ranked by
that score; only the chosen leaves' paths are then spelled out, again in doubling steps, and each
becomes one formatted conversation with its loss mask.

Template: a message is ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash, ``#`` and ``<``
(in roles also ``:``) are written as a backslash and a letter, so no part of a marker can occur in a
text and reading back is exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from candlewick.session import stored

END = "</turn>\n"


# What stands for each marked character; the backslash comes first when writing, last when reading.
_ESCAPES = (("\\", "\\b"), ("#", "\\h"), ("<", "\\l"))
_COLON = (":", "\\c")


def escape(text: Column, role: bool = False) -> Column:
    for plain, mark in (*_ESCAPES, _COLON) if role else _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescape(text: Column) -> Column:
    for plain, mark in reversed((*_ESCAPES, _COLON)):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def _climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Ancestors at distance 1, 2, 4, ...: tables of (node, up); and per node its root, depth and path score."""
    known = nodes.select(F.col("node").alias("up"))
    parents = nodes.select("node", F.col("parent").alias("up"), "score")
    present = parents.join(known, "up", "left_semi").select("node", F.col("up").alias("found"))
    state = parents.join(present, "node", "left").select(
        "node", F.col("found").alias("up"), "score", F.lit(1).cast("long").alias("depth"), F.col("node").alias("top")
    )
    state = stored(state, "reply-trees")
    jumps = []
    # No path is longer than the table: what has not met its root after so many doublings is in a cycle.
    for _ in range(nodes.count().bit_length()):
        open_ends = state.filter("up IS NOT NULL")
        if open_ends.isEmpty():
            break
        jumps.append(open_ends.select("node", "up"))
        above = state.select(
            F.col("node").alias("up"), F.col("up").alias("up_2"), F.col("score").alias("score_2"), F.col("depth").alias("depth_2"),
            F.col("top").alias("top_2"),
        )
        climbed = open_ends.join(above, "up").select(
            "node", F.col("up_2").alias("up"), (F.col("score") + F.col("score_2")).alias("score"),
            (F.col("depth") + F.col("depth_2")).alias("depth"), F.col("top_2").alias("top"),
        )
        state = stored(state.filter("up IS NULL").unionByName(climbed), "reply-trees")
    return jumps, state.filter("up IS NULL").select("node", F.col("top").alias("root"), "depth", "score")


def branches(nodes: DataFrame, best: int = 1) -> DataFrame:
    """Messages of the ``best`` highest-scoring root-to-leaf paths of every tree.

    ``nodes``: ``node`` (unique), ``parent`` (null or unknown for a root), ``score`` (null counts as 0). Result:
    ``root``, ``leaf``, ``rank`` (1 is best; of equal scores the least leaf), ``node``, ``place`` (0 is the root).
    Messages in or below a cycle have no root and are in no path.
    """
    nodes = stored(nodes.select("node", "parent", F.coalesce("score", F.lit(0)).cast("double").alias("score")), "replies")
    jumps, paths = _climb(nodes)
    parents = nodes.filter("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct()
    leaves = paths.join(parents, "node", "left_anti").withColumnRenamed("node", "leaf")
    by_tree = Window.partitionBy("root").orderBy(F.desc("score"), "leaf")
    chosen = leaves.withColumn("rank", F.row_number().over(by_tree)).filter(F.col("rank") <= best)
    chosen = stored(chosen.select("root", "leaf", "rank", "depth"), "branches")
    steps = chosen.select("leaf", F.col("leaf").alias("node"), F.lit(0).cast("long").alias("above"))
    for k, jump in enumerate(jumps):
        further = steps.join(jump, "node").select("leaf", F.col("up").alias("node"), (F.col("above") + (1 << k)).alias("above"))
        steps = stored(steps.unionByName(further), "branch-steps")
    return steps.join(chosen, "leaf").select("root", "leaf", "rank", "node", (F.col("depth") - 1 - F.col("above")).alias("place"))


def format_paths(messages: DataFrame, assistant: str = "assistant") -> DataFrame:
    """One formatted conversation per ``path``.

    ``messages``: ``path``, ``place`` (order), ``role``, ``text``; null roles and texts count as empty. Result:
    ``path``, ``formatted``, ``loss_mask``: (start, end) code point ranges of the assistant's texts in ``formatted``,
    in order, end exclusive.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    head = F.concat(F.lit("### "), escape(role, role=True), F.lit(": "))
    parts = messages.select("path", "place", (role == assistant).alias("learn"), head.alias("head"), escape(text).alias("body"))
    parts = parts.withColumn("length", (F.length("head") + F.length("body") + len(END)).cast("long"))
    before = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("length").over(before), F.lit(0)) + F.length("head")
    parts = parts.withColumn("start", start).withColumn("piece", F.concat("head", "body", F.lit(END)))
    parts = parts.select("path", F.struct("place", "piece", "learn", "start", (F.col("start") + F.length("body")).alias("end")).alias("part"))
    listed = parts.groupBy("path").agg(F.array_sort(F.collect_list("part")).alias("parts"))
    learned = F.filter("parts", lambda p: p["learn"])
    return listed.select(
        "path",
        F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("formatted"),
        F.transform(learned, lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"))).alias("loss_mask"),
    )


def read_back(formatted: Column) -> Column:
    """The (role, text) list of a formatted conversation."""
    pieces = F.split(formatted, END)
    raw = F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0)))

    def turn(piece):
        body = F.substr(piece, F.lit(len("### ") + 1))
        colon = F.instr(body, ": ")
        return F.struct(
            unescape(F.substr(body, F.lit(1), colon - 1)).alias("role"), unescape(F.substr(body, colon + 2)).alias("text")
        )

    return F.transform(raw, turn)


def masked_texts(formatted: Column, mask: Column) -> Column:
    """The unescaped texts under a loss mask."""
    return F.transform(
        mask, lambda m: unescape(F.substring(formatted, (m["start"] + 1).cast("int"), (m["end"] - m["start"]).cast("int")))
    )


def format_trees(replies: DataFrame, best: int = 1, assistant: str = "assistant") -> DataFrame:
    """The best branches of reply trees as formatted conversations.

    ``replies``: ``node``, ``parent``, ``score``, ``role``, ``text``; other columns are not read. One row per chosen
    branch: ``root``, ``leaf``, ``rank``, ``formatted``, ``loss_mask``. ``node`` must be unique and not null: rows without
    one are in no tree, and repeated nodes would repeat turns. Null roles, texts and scores count as
    empty and 0; an empty table gives no rows; a tree of one message gives a conversation of one turn.
    """
    kept = replies.select("node", "parent", "score", "role", "text").filter("node IS NOT NULL")
    kept = stored(kept, "reply-rows")
    paths = stored(branches(kept, best), "branches")
    spelled = paths.join(kept.select("node", "role", "text"), "node")
    done = format_paths(spelled.withColumn("path", F.struct("root", "leaf", "rank")), assistant)
    return done.select("path.*", "formatted", "loss_mask")


def chained(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns of plain conversations as reply trees in which each message answers the one before it.

    Turns are ordered by number (nulls last), then role and text, so repeated numbers and repeated rows keep every
    row; a null conversation is one of its own.
    """
    rows = turns.select(F.col(conversation).alias("tree"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text"))
    order = Window.partitionBy("tree").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    placed = rows.withColumn("place", F.row_number().over(order))

    def name(place: Column) -> Column:
        return F.concat(F.coalesce(F.col("tree").cast("string"), F.lit("")), F.lit(":"), F.lpad(place.cast("string"), 12, "0"))

    parent = F.when(F.col("place") > 1, name(F.col("place") - 1))
    return placed.select("tree", name(F.col("place")).alias("node"), parent.alias("parent"), F.lit(0.0).alias("score"), "role", "text")
