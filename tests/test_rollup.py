"""Revenue kept up with versions against revenue from scratch."""

import datetime as dt
import random

import pytest
from store import change, feed, line, order, product
from test_parts import small_store
from test_replay import make_tables, random_store

from sitewise.operators import analytics as A
from sitewise.operators import rollup as RU
from sitewise.rules import by_query, by_volume
from sitewise.sources import snapshots
from sitewise.streaming import feed as ST


def both(spark, root, tables, discount):
    """From scratch and as kept, over all years."""
    sites = snapshots.read_version(spark, f"{root}/sites")
    parts = RU.keep_revenue(spark, f"{root}/sites", f"{root}/revenue-{discount}", tables, discount)
    for year in (2026, 2027):
        want = {tuple(r) for r in A.revenue_by_category(sites, tables, year, discount).collect()}
        assert {tuple(r) for r in RU.revenue_of(parts, tables["categories"], year, discount).collect()} == want
    return want


@pytest.mark.parametrize("rule", [by_query(), by_volume()], ids=lambda r: r.name)
def test_batches(spark, tmp_path, rule):
    rows, changes = random_store(5)
    pick = random.Random(5)
    for o in rows["commandes"]:
        o["date_commande"] = dt.datetime(pick.choice([2026, 2027]), 1, 1)
    for i, c in enumerate(rows["categories"]):
        c["nom_categorie"] = f"n{i}"
    tables, root = make_tables(spark, **rows), str(tmp_path / "store")
    ST.begin(root, tables, rule)
    discount = RU.ABSOLUTE if rule.name == "by_query" else RU.RATE
    both(spark, root, tables, discount)
    for version, k in enumerate(range(0, 60, 20)):
        ST.apply_version(feed(spark, changes[k : k + 20]), root, tables, rule, version)
        if version != 1:  # one version is passed over
            both(spark, root, tables, discount)


def test_orders_and_products_that_move(spark, tmp_path):
    """An order of another year and a product of another category or price take their unchanged lines along."""
    tables, root = small_store(spark), str(tmp_path / "store")
    ST.begin(root, tables, by_query())
    first = both(spark, root, tables, RU.ABSOLUTE)
    sites = snapshots.read_version(spark, f"{root}/sites")
    orders, products = sites["commandes"], sites["produits"]
    moved = snapshots.Delta(orders.where("id_commande = 1").select("site", "id_commande"), orders.where("id_commande = 1").selectExpr(*[
        "TIMESTAMP_NTZ '2027-05-05' AS date_commande" if c == "date_commande" else c for c in orders.columns]))
    dearer = snapshots.Delta(products.where("id_produit = 1").select("site", "id_produit"), products.where("id_produit = 1").selectExpr(*[
        "CAST(99 AS DECIMAL(12,4)) AS prix_unitaire" if c == "prix_unitaire" else c for c in products.columns]))
    snapshots.write_deltas(sites, {"commandes": moved, "produits": dearer}, f"{root}/sites", 1)
    assert both(spark, root, tables, RU.ABSOLUTE) != first
