"""A change feed over the whole test line table.

What happens to a line follows from its line number: 1 it is deleted, 2 its quantity
becomes 51 less it, 3 its product changes (within its category where it was returned,
else from category 35 to 50 or back; other categories keep it, an update without
effect), 4 its discount grows by 0.01, 5 it is new, 6 its quantity turns negative, 7 nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.relations import lookup
from sitewise.schema import CHANGES, RATE
from sitewise.functions.prefix import row_numbers
from sitewise.functions.relations import conform
from sitewise.session import settle
from sitewise.sources.tables import Tables, as_lines, load_test_tables, numbered_lines, raw, store_tables

DELETED, FLIPPED, MOVED, DISCOUNTED, NEW, NEGATED = range(1, 7)
CATEGORIES = (35, 50)


def _new_products(spark: SparkSession, sf_dir: str, numbered: DataFrame) -> DataFrame:
    """Adds ``target``: the product that a moved line changes to, NULL for no change."""
    part = raw(spark, sf_dir, "part").where(F.col("p_size").isin(*CATEGORIES))
    low, high = CATEGORIES
    # Stored: a small share of the products, which is known only then.
    part = settle(part.select(F.col("p_partkey").alias("l_partkey"), "p_size"))
    smallest = part.groupBy("p_size").agg(F.min("l_partkey").alias("smallest"))
    same = smallest.select("p_size", F.lit(True).alias("returned"), F.col("smallest").alias("target"))
    other = smallest.select(
        (F.lit(low + high) - F.col("p_size")).alias("p_size"),
        F.lit(False).alias("returned"),
        F.col("smallest").alias("target"),
    )
    # Two categories, returned or not: four rows at any scale.
    targets = F.broadcast(same.unionByName(other))
    sized = lookup(numbered, part, "l_partkey", ["p_size"])
    return sized.withColumn("returned", F.col("l_returnflag") == "R").join(targets, ["p_size", "returned"], "left")


def change_feed(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> DataFrame:
    """The feed, from the stored lines where there are some."""
    number = F.col("l_linenumber")
    numbered = numbered_lines(spark, sf_dir) if numbered is None else numbered
    touched = _new_products(spark, sf_dir, numbered.where(number <= NEGATED))
    quantity = F.col("l_quantity").cast("bigint")
    discount = F.col("l_discount").cast(RATE)
    op = F.when(number == DELETED, "D").when(number == NEW, "I").otherwise("U")
    old, new = op != "I", op != "D"
    new_product = F.when(number == MOVED, F.coalesce("target", "l_partkey")).otherwise(F.col("l_partkey"))
    new_quantity = F.when(number == FLIPPED, 51 - quantity).when(number == NEGATED, -quantity).otherwise(quantity)
    new_discount = F.when(number == DISCOUNTED, discount + F.lit("0.01").cast(RATE)).otherwise(discount)
    feed = touched.select(
        F.col("id_ligne_commande").alias("seq"),
        op.alias("op"),
        "id_ligne_commande",
        F.col("l_orderkey").alias("id_commande"),
        F.when(old, F.col("l_partkey")).alias("old_id_produit"),
        F.when(old, quantity).alias("old_quantite"),
        F.when(old, discount).alias("old_remise"),
        F.when(new, new_product).alias("new_id_produit"),
        F.when(new, new_quantity).alias("new_quantite"),
        F.when(new, new_discount).alias("new_remise"),
    )
    return conform(feed, CHANGES)


def later_changes(feed: DataFrame) -> DataFrame:
    """The feed and, after it, one more change to every line: a deleted line comes back as it
    was, a new line goes again, any other line gets 1 more piece."""
    op = F.col("op")
    names = ("id_produit", "quantite", "remise")
    more = {
        "id_produit": F.col("new_id_produit"),
        "quantite": F.col("new_quantite") + 1,
        "remise": F.col("new_remise"),
    }
    second = feed.select(
        (F.col("seq") * 2 + 1).alias("seq"),
        F.when(op == "D", "I").when(op == "I", "D").otherwise("U").alias("op"),
        "id_ligne_commande",
        "id_commande",
        *[F.when(op != "D", F.col(f"new_{c}")).alias(f"old_{c}") for c in names],
        *[
            F.when(op == "D", F.col(f"old_{c}")).when(op == "U", more[c]).cast(CHANGES[f"new_{c}"].dataType).alias(f"new_{c}")
            for c in names
        ],
    )
    return feed.withColumn("seq", F.col("seq") * 2).unionByName(second)


def moved_changes(spark: SparkSession, sf_dir: str, feed: DataFrame, numbered: DataFrame | None = None) -> DataFrame:
    """``later_changes``, but a deleted line that was returned comes back under its client's next order, where there is one."""
    orders = raw(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    placed = settle(row_numbers(orders, ["o_custkey"], ["o_orderkey"], "place"))
    following = placed.select("o_custkey", F.col("o_orderkey").alias("next"), (F.col("place") - 1).alias("place"))
    pairs = placed.join(following, ["o_custkey", "place"]).select(F.col("o_orderkey").alias("l_orderkey"), "next")
    numbered = numbered_lines(spark, sf_dir) if numbered is None else numbered
    returned = numbered.where((F.col("l_linenumber") == DELETED) & (F.col("l_returnflag") == "R"))
    target = returned.join(pairs, "l_orderkey").select("id_ligne_commande", "next")
    every = later_changes(feed)
    # Only these can move; all other changes are passed on where they lie.
    back = (F.col("op") == "I") & (F.col("seq") % 2 == 1)
    moved = every.where(back).join(target, "id_ligne_commande", "left").withColumn("id_commande", F.coalesce("next", "id_commande"))
    return conform(moved, CHANGES).unionByName(conform(every.where(~back), CHANGES))


def tables_before(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> Tables:
    """The tables before the feed: without the lines that it brings. From stored lines all derived tables are stored."""
    tables = load_test_tables(spark, sf_dir, numbered)
    if numbered is not None:
        tables = store_tables(tables)
    present = (numbered_lines(spark, sf_dir) if numbered is None else numbered).where(F.col("l_linenumber") != NEW)
    return {**tables, "lignes_commandes": conform(as_lines(present), tables["lignes_commandes"].schema)}
