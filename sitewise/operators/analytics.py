"""Joins and aggregates over the global tables and over the union of the sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.functions.columns import units, year_extract, year_range
from sitewise.functions.relations import sort_desc
from sitewise.sources.snapshots import Frags
from sitewise.sources.tables import Tables


def line_product(lines: DataFrame, products: DataFrame) -> DataFrame:
    return lines.join(products, "id_produit")


def line_order(lines: DataFrame, orders: DataFrame) -> DataFrame:
    return lines.join(orders, "id_commande")


def order_client(orders: DataFrame, clients: DataFrame) -> DataFrame:
    """Orders with their client; orders of no or an unknown client drop out."""
    return orders.join(clients, "id_client")


def with_category_name(totals: DataFrame, categories: DataFrame) -> DataFrame:
    return totals.join(categories.select("id_categorie", "nom_categorie"), "id_categorie")


def line_detail(lines: DataFrame, products: DataFrame, orders: DataFrame, year: int | None = None) -> DataFrame:
    """Lines with all columns of their product and order, each key named once."""
    if year is not None:
        orders = orders.where(year_range(F.col("date_commande"), year))
    own = [c for c in orders.columns if c not in lines.columns or c == "id_commande"]
    return line_product(line_order(lines, orders.select(*own)), products)


def purge_predicate(keys: dict[str, Sequence[int] | int]) -> Column:
    """Rows to purge: any column equal to, or among, the given values."""
    chosen = F.lit(False)
    for column, values in keys.items():
        one = F.col(column) == values if isinstance(values, int) else F.col(column).isin(list(values))
        chosen = chosen | one
    return chosen


def orders_per_client(tables: Tables, year: int, named: bool = False, extract: bool = False) -> DataFrame:
    """Orders of a year per client; with the client's company, largest count first."""
    test = year_extract if extract else year_range
    dated = tables["commandes"].where(test(F.col("date_commande"), year))
    if not named:
        return dated.groupBy("id_client").agg(F.count(F.lit(1)).alias("nb_commandes"))
    # Count per client before the join: the join then carries one row per client, however
    # many orders it has. The client is a key, so the company adds no further group.
    counted = dated.groupBy("id_client").agg(F.count("id_commande").alias("nb_commandes"))
    companies = tables["clients"].select("id_client", "societe")
    return sort_desc(order_client(counted, companies).select("id_client", "societe", "nb_commandes"), "nb_commandes")


def sum_two_level(sited: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Sum per site, then over the sites, in one pass."""
    per_site = sited.groupBy("site", *keys).agg(F.sum(column).alias(column))
    return per_site.groupBy(*keys).agg(F.sum(column).alias(column))


def _dated_lines(lines: DataFrame, orders: DataFrame, test: Column) -> DataFrame:
    """Lines of the orders of a year; each line meets its own site's copy of the order."""
    on = ["site", "id_commande"] if "site" in orders.columns else ["id_commande"]
    kept = lines.select("site", "id_commande", "id_produit", "quantite", "remise")
    return kept.join(orders.where(test).select(*on), on)


def revenue_by_category(frags: Frags, tables: Tables, year: int, discount: str = "rate") -> DataFrame:
    """Revenue of a year per category over the union of the sites, largest first.

    ``absolute``: discount is an amount, summed per site with the site's products, no
    rounding. ``rate``: discount is a rate, all sites' lines with the global products,
    two decimals. Orders and products without a ``site`` column stand for all sites.

    Lines are totalled per product before they meet the products: price is a factor of
    all lines of a product, so the decimal result is the same, and a product sold very
    often is one row by then. Terms with a missing part stay out of the sum.
    """
    lines, orders = frags["lignes_commandes"], frags["commandes"]
    quantity, off, price = F.col("quantite"), F.col("remise"), F.col("prix_unitaire")
    date = F.col("date_commande")
    if discount == "absolute":
        whole = quantity.isNotNull() & off.isNotNull()
        sold = _dated_lines(lines, orders, year_range(date, year)).groupBy("site", "id_produit").agg(
            F.sum(F.when(whole, units(quantity))).cast("decimal(20,0)").alias("sold"),
            F.sum(F.when(whole, off)).cast("decimal(24,4)").alias("off"),
        )
        products = frags["produits"]
        on = ["site", "id_produit"] if "site" in products.columns else ["id_produit"]
        term = (F.col("sold") * price - F.col("off")).cast("decimal(38,4)")
        terms = sold.join(products.select(*on, "id_categorie", "prix_unitaire"), on).select(
            "site", "id_categorie", term.alias("chiffre_affaires")
        )
        total = sum_two_level(terms, ["id_categorie"], "chiffre_affaires")
    else:
        net = units(quantity) * (F.lit(1).cast("decimal(1,0)") - off)
        sold = _dated_lines(lines, orders, year_range(date, year)).groupBy("id_produit").agg(
            F.sum(net).cast("decimal(22,4)").alias("sold")
        )
        products = tables["produits"].select("id_produit", "id_categorie", "prix_unitaire")
        total = line_product(sold, products).groupBy("id_categorie").agg(
            F.round(F.sum(F.col("sold") * price), 2).alias("chiffre_affaires")
        )
    named = with_category_name(total, tables["categories"])
    return sort_desc(named.select("id_categorie", "nom_categorie", "chiffre_affaires"), "chiffre_affaires")
