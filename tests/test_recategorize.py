"""Products that change category take their lines along."""

import pytest
from store import keys_at, make_tables
from test_replay import random_store

from sitewise.operators import fragments as FR
from sitewise.operators.quality import audit, check_fk
from sitewise.operators.recategorize import change_categories, line_moves
from sitewise.rules import by_query, by_volume
from sitewise.session import settle


@pytest.mark.parametrize("seed", [1, 6])
def test_lines_follow_their_products(spark, seed):
    rule = by_query()
    rows, _ = random_store(seed)
    # No procedure takes an id of 0 or a discount below it.
    ids = ("id_ligne_commande", "id_commande", "id_produit")
    rows["lignes_commandes"] = [r for r in rows["lignes_commandes"] if all(r[c] for c in ids) and (r["remise"] or 0) >= 0]
    for o in rows["commandes"]:  # all can be pulled in
        o["id_client"], o["id_employe"] = o["id_client"] or 1, o["id_employe"] or 1
    tables = make_tables(spark, **rows)
    frags = {name: settle(df) for name, df in FR.derive(tables, rule).items()}
    was = {p["id_produit"]: p["id_categorie"] for p in rows["produits"]}
    moves = spark.createDataFrame([(p, {35: 50, 50: 9, 9: 35}[c]) for p, c in was.items() if p % 3] + [(777, 50)], "id_produit long, id_categorie long")
    assert len({r.kind for r in line_moves(tables, frags, moves, rule).collect()}) >= 2
    after, sites, refused = change_categories(tables, frags, moves, rule)
    sites = {name: settle(df) for name, df in sites.items()}
    assert refused.isEmpty() and audit(after, sites, rule).isEmpty()
    want, got = keys_at(FR.derive(after, rule)), keys_at(sites)
    for name in ("lignes_commandes", "commandes", "clients"):
        assert got[name] == want[name], name
    assert {r.orphans for r in check_fk(sites, per_site=True).collect()} == {0}
    held = {(r.id_produit, r.id_categorie) for r in sites["produits"].collect()}
    assert held <= {(r.id_produit, r.id_categorie) for r in after["produits"].collect()}


def test_no_line_moves_by_volume(spark):
    rows, _ = random_store(2)
    tables = make_tables(spark, **rows)
    frags = FR.derive(tables, by_volume())
    after, sites, refused = change_categories(tables, frags, spark.createDataFrame([(1, 9), (2, 9)], "id_produit long, id_categorie long"), by_volume())
    assert refused is None and keys_at(sites)["lignes_commandes"] == keys_at(frags)["lignes_commandes"]
    assert {r.id_categorie for r in sites["produits"].where("id_produit IN (1, 2)").collect()} == {9}
    assert {r.orphans for r in check_fk(sites, per_site=True).collect()} == {0}
