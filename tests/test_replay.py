"""Batches against the row-at-a-time store, on random feeds that meet every refusal."""

import random

import pytest
from store import RowStore, change, client, feed, keys_at, line, make_tables, order, product

from sitewise.operators import fragments as FR
from sitewise.operators.maintain import apply_batch
from sitewise.rules import by_query, by_volume
from sitewise.session import settle

QUANTITIES = [None, -5, 0, 30, 50, 51, 60, 60, 99, 100, 101, 120, 150, 150]
DISCOUNTS = [None, "0.0500", "0.1000", "0.0000", "-0.1000"]


def random_store(seed: int):
    pick = random.Random(seed)
    tables = {
        "fournisseurs": [{"id_fournisseur": i} for i in (1, 2)],
        "categories": [{"id_categorie": i} for i in (35, 50, 9)],
        "employes": [{"id_employe": i} for i in (1, 2)],
        "clients": [client(i) for i in (1, 2, 3)],
        "produits": [product(i, pick.choice([35, 50, 50, 35, 9]), pick.choice([1, 2])) for i in range(8)],
        "commandes": [
            order(i, pick.choice([1, 2, 3, 3, None]), pick.choice([1, 2, 2, None])) for i in range(10)
        ],
    }

    def values(i, order_id=None):
        return line(
            i,
            pick.randrange(10) if order_id is None else order_id,
            pick.randrange(8),
            pick.choice(QUANTITIES),
            pick.choice(DISCOUNTS),
        )

    lines = {i: values(i) for i in range(0, 45)}
    # What is stored at the start is sound; a first load does not check, but the store is then kept sound.
    for row in lines.values():
        row["quantite"] = abs(row["quantite"] or 0) + 1 if pick.random() < 0.9 else None
    tables["lignes_commandes"] = list(lines.values())
    changes = []
    order_of_change = list(range(0, 60))
    pick.shuffle(order_of_change)
    for seq, i in enumerate(order_of_change):
        if i >= 45 or (i < 45 and pick.random() < 0.05):
            new = values(i)
            if pick.random() < 0.1:
                new[pick.choice(["id_commande", "id_produit"])] = 777
            changes.append(change(seq, "I", None, new))
            continue
        old = lines[i]
        if pick.random() < 0.4:
            changes.append(change(seq, "D", old, None))
        else:
            new = {**values(i, old["id_commande"])}
            for column in ("id_produit", "quantite", "remise"):
                if pick.random() < 0.3:
                    new[column] = old[column]
            if pick.random() < 0.05:
                new["id_produit"] = 777
            changes.append(change(seq, "U", old, new))
    return tables, changes


@pytest.mark.parametrize(
    "rule, seed",
    [(by_query(), 1), (by_query(), 4), (by_volume(), 1), (by_volume(), 2), (by_volume(), 4)],
    ids=lambda x: getattr(x, "name", x),
)
def test_batch_equals_row_by_row(spark, rule, seed):
    rows, changes = random_store(seed)
    tables = make_tables(spark, **rows)
    frags = {name: settle(df) for name, df in FR.derive(tables, rule).items()}
    expected = RowStore(rule.name, rows, keys_at(frags))
    for c in changes:
        expected.change(c)

    hot_rows = 3 if seed == 4 else 1000  # the last seed takes the way for hot orders
    after, sites, rejected = apply_batch(tables, frags, feed(spark, changes), rule, hot_rows=hot_rows)

    refused = [(r.seq, r.error_code) for r in rejected.collect()]
    assert sorted(refused) == sorted(expected.refused)
    assert keys_at(sites) == expected.state()
    cols = ["id_ligne_commande", "id_commande", "id_produit", "quantite", "remise"]
    lines = {tuple(r) for r in after["lignes_commandes"].select(*cols).collect()}
    assert lines == {tuple(r[c] for c in cols) for r in expected.lines.values()}


@pytest.mark.parametrize("seed", [7, 8])
@pytest.mark.parametrize("rule", [by_query(), by_volume()], ids=lambda r: r.name)
def test_lines_that_change_several_times(spark, rule, seed):
    """A feed in turns equals the row store, also after a refused change."""
    rows, changes = random_store(seed)
    pick = random.Random(seed)
    kept, again = changes[:25], []
    for seq, c in enumerate(pick.sample(kept, 10), 100):
        new = line(c["id_ligne_commande"], c["id_commande"], pick.randrange(8), pick.choice(QUANTITIES), "0.05")
        again.append(change(seq, pick.choice("IUUD"), None, new))
    tables = make_tables(spark, **rows)
    frags = {name: settle(df) for name, df in FR.derive(tables, rule).items()}
    expected = RowStore(rule.name, rows, keys_at(frags))
    for c in kept + again:
        expected.change(c)
    after, sites, rejected = apply_batch(tables, frags, feed(spark, kept + again), rule)
    assert sorted((r.seq, r.error_code) for r in rejected.collect()) == sorted(expected.refused)
    assert keys_at(sites) == expected.state()
    held = {tuple(r) for r in after["lignes_commandes"].collect()}
    assert held == {tuple(r[c] for c in after["lignes_commandes"].columns) for r in expected.lines.values()}


def test_random_feeds_meet_every_strict_refusal():
    """The feeds above are worth their while: the row store refuses for many reasons."""
    codes = set()
    for seed in (1, 2, 3, 4):
        rows, changes = random_store(seed)
        sites = {"commandes": {(s, o["id_commande"]) for s in (1, 2) for o in rows["commandes"]}}
        store = RowStore("by_volume", rows, sites)
        for c in changes:
            store.change(c)
        codes |= {code for _, code in store.refused}
    assert {-1, -20001, -20004, -20005, -20006} <= codes
