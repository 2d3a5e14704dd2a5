"""Which site a line belongs to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.relations import lookup
from sitewise.rules import NOWHERE, ByQuery, Rule


def with_category(lines: DataFrame, products: DataFrame, product: str = "id_produit", name: str = "id_categorie") -> DataFrame:
    """Category of the line's product; NULL where the product is unknown."""
    named = products.select(F.col("id_produit").alias(product), F.col("id_categorie").alias(name))
    return lookup(lines, named, product, [name])


def route(lines: DataFrame, products: DataFrame, rule: Rule) -> DataFrame:
    """Every line with its ``site``, 0 for none."""
    if not isinstance(rule, ByQuery):
        return lines.withColumn("site", rule.site(F.col("quantite")))
    return (
        with_category(lines, products, name="_category")
        .withColumn("site", rule.site(F.col("quantite"), F.col("_category")))
        .drop("_category")
    )


def placed(lines: DataFrame, products: DataFrame, rule: Rule) -> DataFrame:
    """Only the lines a first load puts on a site.

    By query, the quantity test runs before the join and only the products of the
    rule's categories are joined.
    """
    if not isinstance(rule, ByQuery):
        sited = lines.withColumn("site", rule.load_site(F.col("quantite")))
        return sited.where(F.col("site") != NOWHERE)
    candidates = lines.where(F.col("quantite") > rule.guard_above)
    named = products.where(F.col("id_categorie").isin(rule.categories)).select(
        "id_produit", F.col("id_categorie").alias("_category")
    )
    return (
        candidates.join(named, "id_produit")
        .withColumn("site", rule.load_site(F.col("quantite"), F.col("_category")))
        .where(F.col("site") != NOWHERE)
        .select(*lines.columns, "site")
    )
