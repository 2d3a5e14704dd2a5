"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.session import release, settle


def _towards_least(links: DataFrame, keep) -> DataFrame:
    """For each u with neighbours v: the least of u and all v, and the links to it that ``keep`` asks for.

    A minimum per node is combined before the shuffle; the join back is an ordinary one that
    Spark can split where one node has very many links.
    """
    least = links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return keep(links.join(least, "u"), least).where("u <> v").distinct()


def components(links: DataFrame) -> DataFrame:
    """``u, root`` for every node of the links ``a, b`` that is not the least of its component.

    Null ends and loops are no links; repeated links count once. No links: no rows. Each
    round is written to the shared folder, so lineage stays short, and takes the place of the one
    before; rounds grow with the logarithm of the longest chain.
    """
    edges = links.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = settle(edges), None
    while True:
        # Large star: every neighbour above u is hung on the least neighbour of u.
        before = edges
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        edges = _towards_least(both, lambda j, _: j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        # Small star: u and its lesser neighbours are hung on the least of them.
        edges = settle(
            _towards_least(
                edges,
                lambda j, least: j.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))),
            )
        )
        release(before)
        new = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if new == state:
            return edges.select("u", F.col("v").alias("root"))
        state = new
