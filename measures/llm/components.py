"""Connected components of links, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from measures.llm.common import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """links (a, b) -> (node, label): the least node reachable, per node.

    Each round every node takes the least label around it, then the label of
    its label; labels only fall, so the rounds end.  Both sides of each join
    are plain shuffles by key, which the skew rule can split for a node with
    very many links.
    """
    both = cut_lineage(links.select("a", "b").union(links.select("b", "a")).distinct())
    labels = cut_lineage(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("label")))
    while True:
        around = (both.hint("merge").join(labels, both.b == labels.node)
                  .groupBy("a").agg(F.min("label").alias("m")))
        near = cut_lineage(labels.join(around, labels.node == around.a)
                           .select("node", F.least("label", "m").alias("label"),
                                   F.col("label").alias("was")))
        above = near.select(F.col("node").alias("up"), F.col("label").alias("top"))
        new = cut_lineage(near.hint("merge").join(above, near.label == above.up)
                          .select("node", F.least("label", "top").alias("label"), "was"))
        changed = new.where("label <> was").limit(1).count()
        labels = new.select("node", "label")
        if not changed:
            return labels
