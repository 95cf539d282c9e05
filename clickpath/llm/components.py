"""Connected components of a table of links, by contraction.

Every node points to its smallest neighbour if that is smaller than itself. Pointers lead to ever smaller
nodes, so they form trees; they are followed to the roots by joining the table with itself. Links between
the roots are what is left, and the same is done with them until there are none. Each step is a grouping
or a join on nodes and each state a written table. Nothing is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpath.storage import stored


def _roots(links: DataFrame) -> DataFrame:
    """(node, label): the root that each node's pointers lead to."""
    both = links.select(F.col("a").alias("node"), F.col("b").alias("label")).union(links.select("b", "a"))
    pointers = stored(both.groupBy("node").agg(F.least(F.col("node"), F.min("label")).alias("label")), "pointers")
    while True:
        further = pointers.select(F.col("node").alias("label"), F.col("label").alias("further"))
        jumped = stored(pointers.join(further, "label", "left").select("node", "label", F.coalesce("further", "label").alias("to")), "jumped")
        moved = jumped.where("to <> label").limit(1).count()
        pointers = jumped.select("node", F.col("to").alias("label"))
        if not moved:
            return pointers


def components(links: DataFrame) -> DataFrame:
    """(node, label) for the nodes of the links (a, b): label is the smallest node reachable."""
    labels = None
    while True:
        roots = _roots(links)
        if labels is None:
            labels = roots
        else:
            next_roots = roots.select(F.col("node").alias("label"), F.col("label").alias("root"))
            labels = stored(
                labels.join(next_roots, "label", "left").select("node", F.coalesce("root", "label").alias("label")), "labels"
            )
        a = roots.select(F.col("node").alias("a"), F.col("label").alias("root_a"))
        b = roots.select(F.col("node").alias("b"), F.col("label").alias("root_b"))
        links = stored(
            links.join(a, "a").join(b, "b").where("root_a <> root_b")
            .select(F.col("root_a").alias("a"), F.col("root_b").alias("b")).distinct(),
            "root-links",
        )
        if links.isEmpty():
            return labels
