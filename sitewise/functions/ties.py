"""Keys that belong together because something names both: connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.session import release, settle


def connected(links: DataFrame) -> DataFrame:
    """``node, root`` for every key that a link ``a, b`` names; the root is the least key of the component.

    The links are contracted round by round: every key that is still linked goes to the neighbour (or
    itself) of the least rank, a hash that changes from round to round, so that most keys go and chains
    stay short whatever the shape. Chains are followed to their ends before the links are rewritten.
    Each round is stored and takes the place of the one before. Links with a NULL end say nothing.
    """
    rest = settle(
        links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    nodes = settle(rest.select(F.col("a").alias("node")).unionByName(rest.select(F.col("b").alias("node"))).distinct().withColumn("at", F.col("node")))
    turn = 0
    while not rest.isEmpty():
        both = rest.unionByName(rest.select(F.col("b").alias("a"), F.col("a").alias("b")))
        rank = F.struct(F.xxhash64(F.lit(turn), "b").alias("rank"), F.col("b").alias("key"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("rank"), F.col("a").alias("key"))
        steps = settle(both.groupBy("a").agg(F.least(F.min(rank), F.first(own))["key"].alias("next")))
        steps = _followed(steps)
        moved = settle(nodes.join(steps, nodes["at"] == steps["a"], "left").select("node", F.coalesce("next", "at").alias("at")))
        to = steps.select(F.col("a").alias("b"), F.col("next").alias("end"))
        left = rest.join(steps, "a").join(to, "b").select(F.least("next", "end").alias("a"), F.greatest("next", "end").alias("b"))
        fewer = settle(left.where("a <> b").distinct())
        for done in (rest, nodes, steps):
            release(done)
        rest, nodes, turn = fewer, moved, turn + 1
    release(rest)
    least = nodes.groupBy("at").agg(F.min("node").alias("root"))
    found = settle(nodes.join(least, "at").select("node", "root"))
    release(nodes)
    return found


def _followed(steps: DataFrame) -> DataFrame:
    """``a, next`` with ``next`` at the end of the chain of steps that starts at ``a``; an end steps to itself."""
    while True:
        ahead = steps.select(F.col("a").alias("next"), F.col("next").alias("far"))
        longer = settle(steps.join(ahead, "next").select("a", F.col("far").alias("next"), (F.col("far") != F.col("next")).alias("went")))
        release(steps)
        steps = longer
        if steps.where("went").isEmpty():
            return steps.select("a", "next")
