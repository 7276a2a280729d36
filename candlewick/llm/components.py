"""Connected components of a table of links, by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` for every node of ``links`` (two columns of long node numbers).

    The component's number is one of its nodes. Each round every node takes the least label among
    itself and its neighbours, follows that label one step further, and the links move to the labels;
    links whose ends agree go away. All steps are hash aggregations that combine before the shuffle,
    and joins of two stored tables, which adaptive execution splits where one node has many links.
    Rounds grow with the logarithm of a component's diameter. Links with a null end and links of a
    node with itself only name their nodes; an empty table gives no rows.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b"))
    both = links.filter("a IS NOT NULL AND b IS NOT NULL")
    nodes = links.select(F.explode(F.array("a", "b")).alias("node")).filter("node IS NOT NULL").distinct()
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    edges = stored(both.filter("a <> b").distinct(), "links")
    while not edges.isEmpty():
        ends = edges.select(F.explode(F.array(F.struct(F.col("a"), F.col("b")), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e"))
        least = ends.groupBy(F.col("e.a").alias("node")).agg(F.min("e.b").alias("next"))
        step = stored(least.select("node", F.least("node", "next").alias("next")), "labels")
        further = step.select(F.col("node").alias("next"), F.col("next").alias("last"))
        jump = stored(step.join(further, "next").select("node", F.col("last").alias("to")), "labels")
        labels = stored(
            labels.join(jump, labels["component"] == jump["node"], "left").select(
                labels["node"], F.coalesce("to", "component").alias("component")
            ),
            "labels",
        )
        moved = edges.join(jump.toDF("a", "to_a"), "a").join(jump.toDF("b", "to_b"), "b").filter("to_a <> to_b")
        edges = stored(moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b")).distinct(), "links")
    return labels
