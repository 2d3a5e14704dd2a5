"""Products that change category: the change fanned out to their lines, as moves between the sites.

Under the by-query rule a line's site follows from its product's category, but a change of the product
reaches no line by itself. Here the lines of the changed products are placed anew, and those that are
elsewhere now are inserted, deleted or moved by the same procedures as any change, with what that pulls in
and takes along. A product with very many lines is no group anywhere: its lines meet the few changed
products in a join that splits, and go on line by line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.relations import semi
from sitewise.operators.maintain import _LINE, _VALUES, _meet, _pulled, _run
from sitewise.operators.routing import route
from sitewise.rules import NOWHERE, ByQuery, Rule
from sitewise.schema import KEYS
from sitewise.session import settle
from sitewise.sources.snapshots import Delta, Frags, apply_deltas, merge
from sitewise.sources.tables import Tables


def _renewed(products: DataFrame, moves: DataFrame) -> DataFrame:
    """Products with their new categories; those without a change as they are."""
    new = moves.select("id_produit", F.col("id_categorie").alias("_category"), F.lit(True).alias("_moved"))
    category = F.when(F.col("_moved"), F.col("_category")).otherwise(F.col("id_categorie"))
    return products.join(new, "id_produit", "left").withColumn("id_categorie", category).select(products.columns)


def line_moves(tables: Tables, frags: Frags, moves: DataFrame, rule: Rule) -> DataFrame:
    """The lines of changed products that are not where the new categories put them, with ``site_from``,
    ``site_to`` (0 for none) and ``kind``: I insert, D delete, M move."""
    lines = semi(tables["lignes_commandes"], moves, "id_produit")
    expected = route(lines, _renewed(semi(tables["produits"], moves, "id_produit"), moves), rule).withColumnRenamed("site", "site_to")
    actual = semi(frags["lignes_commandes"], lines, _LINE).select(_LINE, F.col("site").alias("site_from"))
    placed = expected.join(actual, _LINE, "left").withColumn("site_from", F.coalesce("site_from", F.lit(NOWHERE)))
    kind = F.when(F.col("site_from") == NOWHERE, "I").when(F.col("site_to") == NOWHERE, "D").otherwise("M")
    return placed.where(F.col("site_from") != F.col("site_to")).select(
        F.col(_LINE).alias("seq"), _LINE, "id_commande", *_VALUES, "site_from", "site_to", kind.alias("kind")
    )


def change_categories(tables: Tables, frags: Frags, moves: DataFrame, rule: Rule) -> tuple[Tables, Frags, DataFrame | None]:
    """Tables and fragments after products (``id_produit, id_categorie``, each product once) got new categories, and
    the moves that were refused (None where the rule does not ask for categories).

    The sites' own copies of the products change too, and their new categories are pulled in.
    """
    after = {**tables, "produits": _renewed(tables["produits"], moves)}
    copies = settle(_renewed(semi(frags["produits"], moves, "id_produit"), moves))
    changed = Delta(copies.select("site", "id_produit"), copies)
    categories = _pulled(tables["categories"], frags["categories"], copies, "id_categorie")
    nothing = frags["categories"].select("site", "id_categorie").where(F.lit(False))
    deltas, refused = {"produits": changed, "categories": Delta(nothing, categories)}, None
    if isinstance(rule, ByQuery):
        rows = settle(line_moves(tables, frags, moves, rule))
        outcome = _run(frags, after, _meet(frags, rows, rows), rule.policy)
        own, refused = outcome.deltas, outcome.rejected
        both = own["categories"].added.unionByName(categories).dropDuplicates(["site", KEYS["categories"]])
        deltas = {**own, "produits": merge(changed, own["produits"]), "categories": Delta(nothing, both)}
    return after, apply_deltas(frags, deltas), refused
