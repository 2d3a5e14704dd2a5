"""The site procedures: demonstrations, refusals, what is pulled in and what is cleaned up."""

from decimal import Decimal

import pytest
from store import change, client, feed, frame, keys_at, line, make_frags, make_tables, order, product
from pyspark.sql import types as T

from sitewise import schema as S
from sitewise.operators import maintain as M
from sitewise.operators.changes import apply_changes_global
from sitewise.rules import HYDRATE, STRICT, by_query, by_volume

CALL = T.StructType([T.StructField("seq", T.LongType()), T.StructField("site", T.IntegerType()), *S.SCHEMAS["lignes_commandes"].fields])

PARENTS = {
    "fournisseurs": [{"id_fournisseur": 9999}],
    "categories": [{"id_categorie": c} for c in (35, 50, 77)],
    "clients": [client(9999)],
    "employes": [{"id_employe": 9999}],
    "commandes": [order(9999, 9999, 9999)],
}


def calls(spark, rows):
    return frame(spark, rows, CALL)


def call(seq, site, *values):
    return {"seq": seq, "site": site, **line(*values)}


def run(spark, rule, tables, frags, *statements):
    """One batch per statement, as each is its own transaction. Gives the refusal codes too."""
    codes = []
    for op, i, change_to in statements:
        lines = {r.id_ligne_commande: r.asDict() for r in tables["lignes_commandes"].collect()}
        old = lines.get(i)
        new = None if op == "D" else {**(old or {}), **change_to, "id_ligne_commande": i}
        tables, frags, rejected = M.apply_batch(tables, frags, feed(spark, [change(1, op, old, new)]), rule)
        codes.append([r.error_code for r in rejected.collect()])
        frags = {n: frame(spark, [r.asDict() for r in df.collect()], df.schema) for n, df in frags.items()}
        tables = {**tables, "lignes_commandes": frame(spark, [r.asDict() for r in tables["lignes_commandes"].collect()], S.SCHEMAS["lignes_commandes"])}
    return tables, frags, codes


def test_by_query_demonstration(spark):
    tables = make_tables(spark, **PARENTS, produits=[product(9999, 50, 9999), product(8888, 35, 9999)])
    frags = make_frags(spark, True)
    new = line(99001, 9999, 9999, 150, "0.05")
    tables, frags, codes = run(
        spark, by_query(), tables, frags,
        ("I", 99001, new),
        ("U", 99001, {"id_produit": 8888, "quantite": 80}),
    )
    held = keys_at(frags)
    assert held["lignes_commandes"] == {(2, 99001, 9999, 8888, 80, Decimal("0.05"), 9999)}
    # The delete at site 1 took order and client along; product, supplier, category, employee stay.
    assert held["commandes"] == {(2, 9999)} and held["clients"] == {(2, 9999)}
    assert held["produits"] == {(1, 9999), (2, 8888)} and held["employes"] == {(1, 9999), (2, 9999)}
    assert held["categories"] == {(1, 50), (2, 35)} and held["fournisseurs"] == {(1, 9999), (2, 9999)}
    tables, frags, more = run(spark, by_query(), tables, frags, ("U", 99001, {"quantite": 30}))
    assert codes + more == [[], [], []]
    assert keys_at(frags)["lignes_commandes"] == set() and keys_at(frags)["commandes"] == set()
    assert [r.quantite for r in tables["lignes_commandes"].collect()] == [30]


def test_by_volume_demonstration(spark):
    """A line that leaves site 1 takes its order along, so it cannot come back."""
    both = [{**order(9999, 9999, 9999), "site": s} for s in (1, 2)]
    products = [product(9999, 77, 9999), product(8888, 77, 9999)]
    tables = make_tables(spark, **PARENTS, produits=products)
    frags = make_frags(
        spark, False, commandes=both, clients=[{**client(9999), "site": s} for s in (1, 2)],
        produits=[{**p, "site": s} for p in products for s in (1, 2)],
    )
    tables, frags, codes = run(
        spark, by_volume(), tables, frags,
        ("I", 88001, line(88001, 9999, 9999, 150, "0.05")),
        ("U", 88001, {"quantite": 80}),
        ("U", 88001, {"quantite": 120}),
        ("D", 88001, {}),
    )
    assert codes == [[], [], [S.NO_ORDER], []]
    held = keys_at(frags)
    # The last delete took the order off site 2 too.
    assert held["lignes_commandes"] == held["commandes"] == held["clients"] == set()
    assert len(held["produits"]) == 4


@pytest.fixture(scope="module")
def strict_store(spark):
    tables = make_tables(spark, **PARENTS, produits=[product(1, 77, 9999)])
    frags = make_frags(
        spark, False, commandes=[{**order(9999, 9999, 9999), "site": 1}], produits=[{**product(1, 77, 9999), "site": 1}],
        lignes_commandes=[{**line(10, 9999, 1, 150, "0.05"), "site": 1}, {**line(11, 9999, 1, 150, "0.05"), "site": 1}],
    )
    return tables, frags


def test_strict_insert_refusals_in_order(spark, strict_store):
    tables, frags = strict_store
    rows = [
        call(1, 1, 20, 9999, 1, -10, 0),
        call(2, 1, 10, 9999, 1, 150, 0),
        call(3, 1, 21, 777, 1, 120, 0),
        call(4, 1, 22, 9999, 777, 120, 0),
        call(5, 1, 23, 777, 777, 0, "-0.10"),
        call(6, 1, 24, 9999, 1, None, None),  # missing values are not refused
        call(7, 1, 25, 9999, 1, 5, 0),
        call(8, 1, 25, 9999, 1, 6, 0),  # there by now
        call(9, 2, 26, 9999, 1, 5, 0),  # the order is on site 1 only
        call(10, 1, 25, 777, 777, 5, 0),  # that it is there is found first
    ]
    after, rejected = M.insert_lines(frags, tables, calls(spark, rows), STRICT)
    codes = {r.seq: r.error_code for r in rejected.collect()}
    assert codes == {1: -20001, 2: -20002, 3: -20003, 4: -20004, 5: -20001, 8: -20002, 9: -20003, 10: -20002}
    held = {r.id_ligne_commande: r.quantite for r in after["lignes_commandes"].collect()}
    assert held == {10: 150, 11: 150, 24: None, 25: 5}


def test_strict_update_refusals(spark, strict_store):
    tables, frags = strict_store
    rows = [
        call(1, 1, 99, None, None, 100, None),
        call(2, 1, 10, None, 777, 100, None),
        call(3, 1, 11, None, None, None, "-0.10"),
    ]
    after, rejected = M.update_lines(frags, tables, calls(spark, rows).drop("id_commande"), STRICT)
    found = {r.seq: (r.error_code, r.error_message) for r in rejected.collect()}
    assert {seq: code for seq, (code, _) in found.items()} == {1: -20006, 2: -20007, 3: -20008}
    assert found[1][1] == "FAILED: Ligne Commande ID 99 not found."
    assert found[2][1] == "FAILED: Product ID 777 does not exist in the database."
    assert keys_at(after) == keys_at(frags)


def test_update_keeps_what_it_does_not_name(spark, strict_store):
    tables, frags = strict_store
    rows = [call(1, 1, 10, None, None, 7, None)]
    after, rejected = M.update_lines(frags, tables, calls(spark, rows).drop("id_commande"), STRICT)
    assert rejected.isEmpty()
    assert (1, 10, 9999, 1, 7, Decimal("0.05")) in keys_at(after)["lignes_commandes"]


@pytest.mark.parametrize("policy, codes", [(STRICT, [-20005]), (HYDRATE, [])])
def test_delete_of_unknown_line(spark, strict_store, policy, codes):
    tables, frags = strict_store
    if policy == HYDRATE:
        frags = {**frags, "lignes_commandes": frags["lignes_commandes"].selectExpr("*", "CAST(9999 AS BIGINT) AS id_client")}
    after, rejected = M.delete_lines(frags, tables, calls(spark, [call(1, 1, 999999, None, None, None, None)]).select("seq", "site", "id_ligne_commande"), policy)
    assert [r.error_code for r in rejected.collect()] == codes
    assert keys_at(after) == keys_at(frags)


def test_hydrating_insert_needs_whole_parents(spark):
    """An order without client or employee, or a product without supplier, cannot be pulled in."""
    tables = make_tables(
        spark, **{**PARENTS, "commandes": [order(1, 9999, 9999), order(2, None, 9999), order(3, 9999, None)]},
        produits=[product(1, 50, 9999), product(2, 50, None)],
    )
    frags = make_frags(spark, True)
    rows = [call(n, 1, n, o, p, 150, 0) for n, (o, p) in enumerate([(1, 1), (2, 1), (3, 1), (1, 2), (4, 1), (1, 5)], 1)]
    after, rejected = M.insert_lines(frags, tables, calls(spark, rows), HYDRATE)
    assert {r.seq: r.error_code for r in rejected.collect()} == {n: S.NO_DATA_FOUND for n in (2, 3, 4, 5, 6)}
    held = keys_at(after)
    assert held["lignes_commandes"] == {(1, 1, 1, 1, 150, Decimal("0"), 9999)}
    assert held["commandes"] == {(1, 1)} and held["produits"] == {(1, 1)} and held["employes"] == {(1, 9999)}


def test_hydrating_update_drops_product_without_lines(spark):
    tables = make_tables(spark, **PARENTS, produits=[product(1, 50, 9999), product(2, 50, 9999), product(3, 50, 9999)])
    line_of = lambda i, p: {**line(i, 9999, p, 150, 0), "id_client": 9999, "site": 1}
    frags = make_frags(
        spark, True, commandes=[{**order(9999, 9999, 9999), "site": 1}], clients=[{**client(9999), "site": 1}],
        produits=[{**product(p, 50, 9999), "site": 1} for p in (1, 2)],
        lignes_commandes=[line_of(1, 1), line_of(2, 1), line_of(3, 2)],
    )
    rows = [call(1, 1, 1, None, 3, None, None), call(2, 1, 3, None, 3, None, None)]
    after, _ = M.update_lines(frags, tables, calls(spark, rows).drop("id_commande"), HYDRATE)
    # Line 2 is still on product 1; product 2 lost its only line.
    assert keys_at(after)["produits"] == {(1, 1), (1, 3)}


def test_batch_may_fail_as_a_whole(spark, strict_store):
    tables, frags = strict_store
    bad = feed(spark, [change(1, "I", None, line(50, 777, 1, 150, 0))])
    with pytest.raises(M.RejectedChanges):
        M.apply_batch(tables, frags, bad, by_volume(), on_reject=M.FAIL)


def test_turns(spark, strict_store):
    tables, frags = strict_store
    lines = frags["lignes_commandes"].drop("site")
    tables = {**tables, "lignes_commandes": lines}
    a, b = line(10, 9999, 1, 150, "0.05"), line(10, 9999, 1, 160, "0.05")
    twice = feed(spark, [change(1, "U", a, b), change(2, "D", line(11, 9999, 1, 150, "0.05"), None), change(3, "D", b, None)])
    parts = M.turns(M._grouped(twice, [lines]))
    assert [sorted(r.seq for r in part.collect()) for part in parts] == [[1, 2], [3]]
    _, after, rejected = M.apply_batch(tables, frags, twice, by_volume())
    assert rejected.isEmpty() and keys_at(after)["lignes_commandes"] == set() and keys_at(after)["commandes"] == set()


def test_orders_are_cut_by_themselves(spark, strict_store):
    """Fifty lines of fifty orders that change twice in a row take two turns; a line that names two orders ties all."""
    none = strict_store[0]["lignes_commandes"]
    rows = []
    for i in range(50):
        a, b = line(100 + i, i, 1, 150, 0), line(100 + i, i, 1, 160, 0)
        rows += [change(2 * i, "U", a, b), change(2 * i + 1, "D", b, None)]
    parts = [sorted(r.seq for r in p.collect()) for p in M.turns(M._grouped(feed(spark, rows), [none]))]
    assert parts == [list(range(0, 100, 2)), list(range(1, 100, 2))]
    a, b = line(100, 0, 1, 150, 0), line(101, 1, 1, 150, 0)
    tied = [change(1, "D", a, None), change(2, "D", b, None), change(3, "I", None, line(100, 1, 1, 5, 0)), change(4, "I", None, b)]
    parts = [sorted(r.seq for r in p.collect()) for p in M.turns(M._grouped(feed(spark, tied), [none]))]
    assert parts == [[1, 2], [3, 4]]


@pytest.mark.parametrize("policy, codes", [(STRICT, {2: -20005, 3: -20005}), (HYDRATE, {})])
def test_repeated_deletes(spark, strict_store, policy, codes):
    """The second delete of a line finds nothing; the order stays, as its other line does."""
    tables, frags = strict_store
    if policy == HYDRATE:
        frags = {**frags, "lignes_commandes": frags["lignes_commandes"].selectExpr("*", "CAST(9999 AS BIGINT) AS id_client")}
    named = calls(spark, [call(n, 1, 10, None, None, None, None) for n in (1, 2, 3)]).select("seq", "site", "id_ligne_commande")
    after, rejected = M.delete_lines(frags, tables, named, policy)
    assert {r.seq: r.error_code for r in rejected.collect()} == codes
    assert {r[1] for r in keys_at(after)["lignes_commandes"]} == {11} and keys_at(after)["commandes"] == {(1, 9999)}


def test_repeated_updates(spark, strict_store):
    """Each update builds on the one before; a refused one between them changes nothing."""
    tables, frags = strict_store
    rows = [call(1, 1, 10, None, None, 7, None), call(2, 1, 10, None, None, -1, None), call(3, 1, 10, None, None, None, "0.20")]
    after, rejected = M.update_lines(frags, tables, calls(spark, rows).drop("id_commande"), STRICT)
    assert [(r.seq, r.error_code) for r in rejected.collect()] == [(2, -20008)]
    found = [r for r in keys_at(after)["lignes_commandes"] if r[1] == 10]
    assert found == [(1, 10, 9999, 1, 7, Decimal("0.20"))]


def test_replicate_and_purge(spark, strict_store):
    tables, frags = strict_store
    new = M.replicate_parents(frags, tables, {"commandes": tables["commandes"], "clients": tables["clients"]})
    assert keys_at(new)["commandes"] == {(1, 9999), (2, 9999)} and keys_at(new)["clients"] == {(1, 9999), (2, 9999)}
    from sitewise.operators.analytics import purge_predicate

    left = M.purge(new, {"commandes": purge_predicate({"id_client": [1, 9999]}), "clients": purge_predicate({"id_client": 5})})
    assert keys_at(left)["commandes"] == set() and len(keys_at(left)["clients"]) == 2


def test_apply_changes_global(spark):
    tables = make_tables(spark, lignes_commandes=[line(i, 1, 1, i, 0) for i in (1, 2, 3)])
    accepted = feed(spark, [
        change(1, "D", line(1, 1, 1, 1, 0), None),
        change(2, "U", line(2, 1, 1, 2, 0), line(2, 1, 1, 20, None)),
        change(3, "I", None, line(4, 1, 1, 4, 0)),
    ])
    after = apply_changes_global(tables["lignes_commandes"], accepted).collect()
    assert {(r.id_ligne_commande, r.quantite, r.remise) for r in after} == {
        (2, 20, None), (3, 3, Decimal("0")), (4, 4, Decimal("0")),
    }
