"""Connected components of a table of links, by hooking to the smallest neighbour and jumping to its label."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from wayfare.llm.anchors import anew, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component`` (its smallest node) for every node that has a link; null nodes have none.

    A round hooks every node to the least label around it, then to that
    label's own label, so paths shrink by half or better.  Each round is
    written to the shared folder: the plan stays short and a lost executor
    repeats one round at most.  Only counts reach the driver.
    """
    links = links.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a != b")
    both = written(links.union(links.select("b", "a")).distinct(), "links")
    rows = both.count()
    least = both.groupBy("a").agg(F.min("b").alias("b"))
    labels = written(least.select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels", rows)
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        hooked = labels.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.least("component", "near").alias("component"), F.col("component").alias("before")
        )
        hooked = written(hooked, "hooked", rows)
        jumps = hooked.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = written(hooked.join(jumps, "component").select(
            "node", F.col("further").alias("component"), (F.col("further") != F.col("before")).alias("changed")
        ), "labels", rows)
        labels = moved.select("node", "component")
        if not moved.where("changed").limit(1).count():
            return labels


def from_heads(links: DataFrame) -> DataFrame:
    """``node`` and ``component`` from rows of ``head`` and ``node``, a few for each node.

    The heads of one node are one component.  Only links between heads are
    followed further: a group of any size with a few heads is a few links.
    Heads that are not nodes themselves are not returned.
    """
    links = links.groupBy("node").agg(F.collect_set("head").alias("heads"))
    met = written(links.select("node", "heads", F.array_min("heads").alias("least")), "heads")
    pairs = met.select(F.col("least").alias("a"), F.explode(F.filter("heads", lambda h: h != F.col("least"))).alias("b"))
    joined = components(pairs.distinct()).withColumnRenamed("node", "least").withColumn("half", F.xxhash64("least"))
    found = met.select("node", "least", F.xxhash64("least").alias("half")).join(anew(joined, "half"), ["half", "least"], "left")
    return found.select("node", F.coalesce("component", "least").alias("component"))
