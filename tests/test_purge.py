"""Deleting along the references."""

import pytest
from store import client, keys_at, line, make_tables, order, product
from test_parts import small_store

from sitewise.operators import fragments as FR
from sitewise.operators.purge import closure, parents_first, purge_closure
from sitewise.operators.quality import check_fk
from sitewise.rules import by_query, by_volume
from sitewise.schema import KEYS


def ids(spark, table, *keys):
    return spark.createDataFrame([(k,) for k in keys], f"{KEYS[table]} long")


def test_order_of_tables(spark):
    order_of = parents_first(make_tables(spark))
    assert order_of.index("lignes_commandes") == 6 and order_of.index("produits") > order_of.index("categories")


def test_global_closure(spark):
    tables = make_tables(
        spark,
        fournisseurs=[{"id_fournisseur": i} for i in (1, 2)],
        categories=[{"id_categorie": i} for i in (35, 50)],
        employes=[{"id_employe": 1}],
        clients=[client(i) for i in (1, 2, 3)],
        produits=[product(1, 35, 1), product(2, 50, 2), product(3, None, None)],
        commandes=[order(1, 1), order(2, 2), order(3, None, None)],
        lignes_commandes=[line(1, 1, 2, 1, 0), line(2, 2, 1, 1, 0), line(3, 2, 2, 1, 0), line(4, 3, 3, 1, 0), line(5, None, None, 1, 0), line(6, 3, 1, 1, 0)],
    )
    gone = closure(tables, {"clients": ids(spark, "clients", 1, 99), "categories": ids(spark, "categories", 35)})
    assert list(gone)[0] == "lignes_commandes"  # children first
    found = {name: {r[0] for r in df.collect()} for name, df in gone.items()}
    assert found == {"clients": {1}, "categories": {35}, "commandes": {1}, "produits": {1}, "lignes_commandes": {1, 2, 6}}
    after = purge_closure(tables, {"lignes_commandes": ids(spark, "lignes_commandes", 3)})
    assert after["lignes_commandes"].count() == 5 and after["commandes"].count() == 3
    with pytest.raises(ValueError, match="no such table"):
        closure(tables, {"nothing": ids(spark, "clients", 1)})


@pytest.mark.parametrize("rule", [by_query(), by_volume()], ids=lambda r: r.name)
def test_no_orphan_is_left(spark, rule):
    frags = FR.derive(small_store(spark), rule)
    before = keys_at(frags)
    for table in ("clients", "employes", "fournisseurs", "categories", "produits", "commandes"):
        some = {key for _, key in before[table]}
        after = purge_closure(frags, {table: ids(spark, table, min(some))})
        assert {r.orphans for r in check_fk(after, per_site=True).collect()} == {0}
        held = keys_at(after)
        assert not {k for _, k in held[table]} & {min(some)} and held != before
