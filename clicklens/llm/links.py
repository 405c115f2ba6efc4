"""Connected components of a graph that stays in Spark: hooking and pointer jumping over an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clicklens.llm.lineage import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long): root is the smallest node that it reaches.

    Each round hooks the parents of linked nodes onto the smallest grandparent seen across an edge, hooks the
    nodes themselves, and halves the paths; all three are one grouped minimum. The depth of the trees falls
    by about half each round, so rounds grow with the logarithm of the longest path. Parents are cut from
    their lineage with ``checkpoint()`` each round; a popular root is a popular join key, which an adaptive
    join splits, and a grouped minimum is combined before its shuffle: the task of a popular root reads one row
    of each map task at most, however many nodes point at it.
    """
    both = edges.where("a <> b").select("a", "b")
    both = cut(both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    parent = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("p")).select(F.col("a").alias("node"), "p")
    parent = cut(parent)
    while True:
        up = parent.select(F.col("node").alias("p"), F.col("p").alias("gp"))
        grand = parent.join(up, "p").select("node", "p", "gp")
        seen = both.join(grand.select(F.col("node").alias("b"), F.col("gp").alias("over")), "b").select("a", "over")
        least = seen.groupBy("a").agg(F.min("over").alias("over")).withColumnRenamed("a", "node")
        own = grand.join(least, "node").select("node", "p", F.least("gp", "over").alias("to"))
        hooks = (own.select("node", "to").unionByName(own.select(F.col("p").alias("node"), "to"))
                 .groupBy("node").agg(F.min("to").alias("p")))
        new = cut(parent.join(hooks.withColumnRenamed("p", "to"), "node")
                  .select("node", F.least("p", "to").alias("p"), (F.col("to") < F.col("p")).alias("moved")))
        parent = new.select("node", "p")
        if new.where("moved").limit(1).count() == 0:
            return parent.withColumnRenamed("p", "root")
