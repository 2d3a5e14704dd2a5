"""Placement and transitions, value by value."""

import pytest
from store import change, feed, line, make_tables, product

from sitewise.operators import changes as CH
from sitewise.operators.routing import placed, route
from sitewise.rules import by_query, by_volume

PRODUCTS = [product(1, 50), product(2, 35), product(3, 9), product(4, None)]


def sites(df) -> dict:
    return {r.id_ligne_commande: r.site for r in df.collect()}


@pytest.fixture(scope="module")
def boundary(spark):
    quantities = [49, 50, 51, 99, 100, 101, None]
    rows = [line(i * 10 + p, 1, p, q, 0.05) for i, q in enumerate(quantities) for p in (1, 2, 3, 4, 5)]
    return make_tables(spark, produits=PRODUCTS, lignes_commandes=rows), rows


def test_by_query(boundary):
    tables, rows = boundary

    def expected(row):
        q = row["quantite"]
        if q is not None and row["id_produit"] == 1 and q > 100:
            return 1
        return 2 if q is not None and row["id_produit"] == 2 and q > 50 else 0

    wanted = {r["id_ligne_commande"]: expected(r) for r in rows}
    assert sites(route(tables["lignes_commandes"], tables["produits"], by_query())) == wanted
    held = {i: s for i, s in wanted.items() if s}
    assert sites(placed(tables["lignes_commandes"], tables["produits"], by_query())) == held


def test_by_volume_treats_missing_quantity_by_occasion(boundary):
    tables, rows = boundary
    wanted = {
        r["id_ligne_commande"]: 1 if r["quantite"] is not None and r["quantite"] >= 100 else 2 for r in rows
    }
    assert sites(route(tables["lignes_commandes"], tables["produits"], by_volume())) == wanted
    # The first load puts a line without a quantity nowhere.
    loaded = {r["id_ligne_commande"]: wanted[r["id_ligne_commande"]] for r in rows if r["quantite"] is not None}
    assert sites(placed(tables["lignes_commandes"], tables["produits"], by_volume())) == loaded


def test_nine_transitions_by_query(spark):
    tables = make_tables(spark, produits=PRODUCTS)
    at = {1: (1, 150), 2: (2, 75), 0: (3, 75)}
    rows, wanted = [], {}
    kinds = {(1, 1): "U", (2, 2): "U", (1, 2): "M", (2, 1): "M", (1, 0): "D", (2, 0): "D", (0, 1): "I", (0, 2): "I", (0, 0): "N"}
    for seq, ((old, new), kind) in enumerate(kinds.items(), 1):
        before, after = line(seq, 1, *at[old], 0.05), line(seq, 1, at[new][0], at[new][1] + 1, 0.05)
        rows.append(change(seq, "U", before, after))
        wanted[seq] = (old, new, kind)
    named = CH.classify(feed(spark, rows), tables["produits"], by_query())
    assert {r.seq: (r.old_site, r.new_site, r.kind) for r in named.collect()} == wanted
    actions = [
        (r.seq, r.step, r.action, r.site)
        for r in CH.to_actions(named).orderBy("seq", "step").collect()
        if wanted[r.seq][2] == "M"
    ]
    assert actions == [(3, 1, "DELETE", 1), (3, 2, "INSERT", 2), (4, 1, "DELETE", 2), (4, 2, "INSERT", 1)]


def test_update_to_missing_quantity_changes_site_by_volume(spark):
    rows = [
        change(1, "U", line(1, 1, 1, 150, 0), line(1, 1, 1, None, 0)),
        change(2, "U", line(2, 1, 1, 50, 0), line(2, 1, 1, None, 0)),
        change(3, "U", line(3, 1, 1, None, 0), line(3, 1, 1, 50, 0)),
        change(4, "D", line(4, 1, 1, None, 0), None),
    ]
    tables = make_tables(spark, produits=PRODUCTS)
    named = CH.classify(feed(spark, rows), tables["produits"], by_volume())
    assert {r.seq: (r.old_site, r.new_site) for r in named.collect()} == {1: (1, 2), 2: (2, 1), 3: (2, 2), 4: (2, 0)}


def test_guard(spark):
    rows = [
        change(1, "U", line(1, 1, 1, 150, 0), line(1, 1, 1, 150, 0)),  # nothing altered
        change(2, "U", line(2, 1, 1, 30, 0), line(2, 1, 1, 50, 0)),  # below on both sides
        change(3, "U", line(3, 1, 1, 30, 0), line(3, 1, 1, 51, 0)),
        change(4, "U", line(4, 1, 1, 51, 0), line(4, 1, 1, None, 0)),
        change(5, "I", None, line(5, 1, 1, 50, 0)),
        change(6, "I", None, line(6, 1, 1, None, 0)),
        change(7, "D", line(7, 1, 1, 51, 0), None),
        change(8, "U", line(8, 1, 1, 60, None), line(8, 1, 1, 60, 0)),
    ]
    df = feed(spark, rows)
    assert {r.seq for r in CH.guard(df, by_query()).collect()} == {3, 4, 7, 8}
    assert {r.seq for r in CH.guard(df, by_volume()).collect()} == {2, 3, 4, 5, 6, 7, 8}


def test_compact(spark):
    a, b, c = line(1, 1, 1, 60, 0), line(1, 1, 2, 70, 0), line(1, 1, 2, 80, 0)
    of = lambda i, row: {**row, "id_ligne_commande": i}
    rows = [
        change(1, "U", a, b), change(2, "U", b, c),
        change(3, "I", None, of(2, a)), change(4, "U", of(2, a), of(2, b)),
        change(5, "I", None, of(3, a)), change(6, "D", of(3, a), None),
        change(7, "U", of(4, a), of(4, b)), change(8, "D", of(4, b), None),
        change(9, "D", of(5, a), None), change(10, "I", None, of(5, b)),
    ]
    folded = {
        r.id_ligne_commande: (r.seq, r.op, r.old_quantite, r.new_quantite) for r in CH.compact(feed(spark, rows)).collect()
    }
    assert folded == {1: (2, "U", 60, 80), 2: (4, "I", None, 70), 4: (8, "D", 60, None), 5: (10, "U", 60, 70)}
