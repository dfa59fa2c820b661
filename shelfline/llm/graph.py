"""Connected components of a graph given by its links, as joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.scratch import remove, written


def _ordered(links: DataFrame) -> DataFrame:
    return (
        links.filter("a <> b")
        .select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every id in `links` (a, b): the smallest id reachable.

    Each round maps every node to the smallest neighbour of its smallest neighbour and replaces it
    by that in the links, which at least halves the nodes that still have links. Links to
    themselves, repeated links and nulls are passed over; no links give no rows. The minima combine
    before the shuffle, and joins on a hub are of the kind that adaptive execution splits.
    """
    left = written(_ordered(links))
    nodes = left.select(F.explode(F.array("hi", "lo")).alias("id")).distinct().withColumn("component", F.col("id"))
    first, maps = left, []
    while not left.isEmpty():
        hooks = left.groupBy("hi").agg(F.min("lo").alias("to"))
        further = hooks.select(F.col("hi").alias("to"), F.col("to").alias("to2"))
        step = written(hooks.join(further, "to", "left").select("hi", F.coalesce("to2", "to").alias("to")))
        maps.append(step)
        low = step.select(F.col("hi").alias("lo"), F.col("to").alias("lo_to"))
        moved = left.join(step, "hi").join(low, "lo", "left")
        rest = written(_ordered(moved.select(F.col("to").alias("a"), F.coalesce("lo_to", "lo").alias("b"))))
        if left is not first:
            remove(left)
        left = rest
    for step in maps:
        to = step.select(F.col("hi").alias("component"), "to")
        nodes = nodes.join(to, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return written(nodes)
