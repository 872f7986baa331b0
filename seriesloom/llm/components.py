"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seriesloom.staging import stage


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); the root is the smallest node of its component.

    Every node points to its smallest neighbour if that is smaller, pointers are followed once more, and the links are
    redrawn between the nodes pointed to, until none is left.  Each round is a staged table, so lost
    executors cost one round; nothing of the graph is held by the driver.
    """
    ends = stage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a != b").distinct(), "ends")
    roots = stage(ends.select(F.col("a").alias("node")).distinct().select("node", F.col("node").alias("root")), "roots")
    while ends.take(1):
        smallest = stage(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("from"), F.least("a", "b").alias("to")), "pointers")
        further = smallest.select(F.col("from").alias("via"), F.col("to").alias("on"))
        pointers = stage(smallest.join(further, F.col("to") == F.col("via"), "left").select("from", F.coalesce("on", "to").alias("to")), "jumps")
        roots = stage(
            roots.join(pointers, F.col("root") == F.col("from"), "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        )
        heads = pointers.select(F.col("from").alias("b"), F.col("to").alias("new_b"))
        redrawn = ends.join(pointers.select(F.col("from").alias("a"), F.col("to").alias("new_a")), "a").join(heads, "b")
        ends = stage(redrawn.where("new_a != new_b").select(F.col("new_a").alias("a"), F.col("new_b").alias("b")).distinct(), "ends")
    return roots
