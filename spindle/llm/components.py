"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spindle.llm.common import keep


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); a component is named by its least node.

    Each round every node points to the least node around it, pointers are followed one
    step further, and the links are drawn anew between the nodes pointed to.  Links
    inside a merged part vanish, so rounds shrink fast (a star is done in one), and
    pointers double, so long paths take a logarithmic number of rounds.  Each round is
    written to the shared folder.
    """
    edges = keep(links.select("a", "b").filter("a != b").distinct(), "cc-edges")
    ends = links.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    labels = keep(ends.withColumn("component", F.col("node")), "cc-labels")
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        near = both.groupBy("node").agg(F.least("node", F.min("other")).alias("to"))
        near = keep(near, "cc-near")
        further = near.select(F.col("node").alias("to"), F.col("to").alias("root"))
        to = keep(near.join(further, "to").select("node", "root"), "cc-pointers")
        labels = keep(labels.join(to.withColumnRenamed("node", "component"), "component", "left")
                      .select("node", F.coalesce("root", "component").alias("component")), "cc-labels")
        edges = keep(edges.join(to.toDF("a", "root_a"), "a").join(to.toDF("b", "root_b"), "b")
                     .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
                     .filter("a != b").distinct(), "cc-edges")
    return labels
