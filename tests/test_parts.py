"""Sources, sinks, running totals, analytics, checks."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from store import client, frame, keys_at, line, make_frags, make_tables, order, product

from sitewise import schema as S
from sitewise.functions import columns as C
from sitewise.functions import relations as R
from sitewise.functions.prefix import row_numbers, running_sums
from sitewise.operators import analytics as A
from sitewise.operators import fragments as FR
from sitewise.operators import quality as Q
from sitewise.rules import by_query, by_volume
from sitewise.sources import layout, snapshots
from sitewise.sources.ingest import seed_ingest
from sitewise.sources.keys import assign_surrogate_key
from sitewise.sources.tables import load_global, save_global

JAN = dt.datetime(2026, 1, 1)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def small_store(spark):
    return make_tables(
        spark,
        fournisseurs=[{"id_fournisseur": i} for i in (1, 2, 3)],
        categories=[{"id_categorie": c, "nom_categorie": f"n{c}"} for c in (35, 50, 9)],
        employes=[{"id_employe": i} for i in (1, 2)],
        clients=[client(i) for i in (1, 2, 3)],
        produits=[product(1, 50, 1, "2.5"), product(2, 35, 2, "4.0"), product(3, 9, 3), product(4, 50, 2)],
        commandes=[
            order(1, 1, 1, JAN),
            order(2, 2, 1, dt.datetime(2026, 12, 31, 23, 59, 59)),
            order(3, 3, 2, dt.datetime(2027, 1, 1)),
            order(4, None, 2, JAN),
        ],
        lignes_commandes=[
            line(1, 1, 1, 150, "0.10"),
            line(2, 1, 2, 60, "0.50"),
            line(3, 2, 2, 70, None),
            line(4, 3, 1, 150, "0.10"),
            line(5, 4, 3, 150, "0.10"),
            line(6, 2, 1, None, "0.10"),
            line(7, 4, 1, 101, "0.00"),
        ],
    )


# ---------------------------------------------------------------- running totals


@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_running_totals_with_a_hot_key(spark, hot_rows):
    """Key 0 holds a third of all rows; the way through chunks gives the same totals."""
    rows = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50 + 1).alias("k"),
        ((F.col("id") * 7919) % 900).alias("o"),
        (F.col("id") % 5 - 2).alias("v"),
    )
    got = running_sums(rows, ["k"], ["o"], {"total": "v"}, hot_rows).toPandas().sort_values(["k", "o"])
    assert len(got) == 900
    assert (got.groupby("k")["v"].cumsum() == got["total"]).all()
    numbers = row_numbers(rows, ["k"], ["o"], "n", hot_rows).toPandas().sort_values(["k", "o"])
    assert (numbers.groupby("k").cumcount() + 1 == numbers["n"]).all()


@pytest.mark.parametrize("hot_rows", [10_000, 20])
def test_running_totals_with_missing_keys_and_values(spark, hot_rows):
    """A missing key is a key; a missing value adds nothing, and nothing but missing values has no total."""
    rows = spark.range(300).select(
        F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"),
        F.col("id").alias("o"),
        F.when((F.col("id") > 90) & (F.col("id") % 2 == 0), F.col("id")).alias("v"),
    )
    got = {(r.k, r.o): r.total for r in running_sums(rows, ["k"], ["o"], {"total": "v"}, hot_rows).collect()}
    expected, totals = {}, {}
    for r in rows.orderBy("o").collect():
        if r.v is not None:
            totals[r.k] = (totals.get(r.k) or 0) + r.v
        expected[r.k, r.o] = totals.get(r.k)
    assert got == expected
    numbers = row_numbers(rows, ["k"], ["o"], "n", hot_rows).collect()
    assert all(r.n == r.o // 3 + 1 for r in numbers) and len(numbers) == 300


def test_row_numbers_over_copies(spark):
    """Equal rows get different numbers, also where they are too many for one task."""
    rows = spark.range(500).select(F.lit(1).alias("k"), F.lit(7).alias("o"))
    got = row_numbers(rows, ["k"], ["o"], "n", hot_rows=50)
    assert sorted(r.n for r in got.collect()) == list(range(1, 501))


def test_surrogate_keys_are_dense_and_ordered(spark):
    rows = spark.range(1000).select((F.col("id") * 37 % 1000).alias("x"))
    got = sorted((r.x, r.key) for r in assign_surrogate_key(rows, [], ["x"], "key").collect())
    assert got == [(x, x + 1) for x in range(1000)]


# ---------------------------------------------------------------- sources and sinks


def test_ingest(spark):
    raw = spark.createDataFrame(
        [
            ("1", "25", "15.647", "a", "0"),
            ("2", "", "94.64749", "b", ""),
            ("3", "x", "1", "c", "1"),
            ("4", "2.5", "1e", "d", "1"),
        ],
        "id_produit string, id_fournisseur string, prix_unitaire string, designation string, indisponible string",
    )
    good, bad = seed_ingest(raw, S.SCHEMAS["produits"])
    rows = {r.id_produit: r for r in good.collect()}
    assert rows[1].prix_unitaire == Decimal("15.6470") and rows[1].indisponible == 0
    assert rows[2].id_fournisseur is None and rows[2].prix_unitaire == Decimal("94.6475")
    assert {r.id_produit: r.bad_columns for r in bad.collect()} == {"3": "id_fournisseur", "4": "prix_unitaire"}
    days = spark.createDataFrame([("03/10/2021",), ("3/1/2021",), ("31/02/2021",), (" ",)], "date_naissance string")
    good, bad = seed_ingest(days, S.SCHEMAS["employes"])
    assert [r[0] for r in good.collect()] == [dt.datetime(2021, 10, 3), dt.datetime(2021, 1, 3), None]
    assert [r.date_naissance for r in bad.collect()] == ["31/02/2021"]
    half = spark.createDataFrame([("12.5",)], "frais_port string")
    assert seed_ingest(half, S.SCHEMAS["commandes"])[0].first()[0] == Decimal("13")


def test_ingest_keeps_discount_amounts(spark):
    raw = spark.createDataFrame([("1", "15"), ("3", "0.1200000"), ("4", "999999.9999"), ("5", "1000000")], "id_ligne_commande string, remise string")
    good, bad = seed_ingest(raw, S.SCHEMAS["lignes_commandes"])
    kept = {r.id_ligne_commande: r.remise for r in good.collect()}
    assert kept == {1: Decimal("15.0000"), 3: Decimal("0.1200"), 4: Decimal("999999.9999")}
    assert {r.id_ligne_commande: r.bad_columns for r in bad.collect()} == {"5": "remise"}


def test_revenue_of_large_quantities_is_exact(spark):
    row = spark.createDataFrame([(9_999_999_999_999, Decimal("12.3456"), Decimal("0.1234"))], "q long, p decimal(12,4), d decimal(10,4)")
    got = row.select(C.net_rate(F.col("q"), F.col("p"), F.col("d"))).first()[0]
    assert got == Decimal(9_999_999_999_999) * Decimal("12.3456") * Decimal("0.8766")


def test_global_tables_round_trip(spark, tmp_path):
    tables = small_store(spark)
    save_global(tables, str(tmp_path))
    back = load_global(spark, str(tmp_path))
    for name in tables:
        assert back[name].schema.names == S.SCHEMAS[name].names
        assert back[name].exceptAll(tables[name]).isEmpty() and tables[name].exceptAll(back[name]).isEmpty()


def test_versions(spark, tmp_path):
    root = str(tmp_path / "s")
    assert snapshots.last_version(spark, root) is None
    frags = FR.load_sites(small_store(spark), by_query(), root)
    before = keys_at(frags)
    assert keys_at(snapshots.read_version(spark, root)) == before

    gone = frame(spark, [{"site": 1, "id_client": 1}], frags["clients"].select("site", "id_client").schema)
    added = frame(spark, [{**client(7), "site": 2}], frags["clients"].schema)
    none = frags["clients"].where("false")
    delta = snapshots.Delta
    snapshots.write_deltas(frags, {"clients": delta(gone, added)}, root, 1)
    snapshots.write_deltas(frags, {"clients": delta(added, frame(spark, [{**client(1), "site": 1}], added.schema))}, root, 2)
    assert keys_at(snapshots.read_version(spark, root, 0)) == before
    assert keys_at(snapshots.read_version(spark, root, 1))["clients"] == before["clients"] - {(1, 1)} | {(2, 7)}
    assert keys_at(snapshots.read_version(spark, root))["clients"] == before["clients"]
    # A version that was written but not committed is not there.
    snapshots.write_table(none, root, "clients", 3)
    assert snapshots.last_version(spark, root) == 2
    with pytest.raises(FileNotFoundError):
        snapshots.read_version(spark, root, 3)

    local = snapshots.fragment_read(spark, root, site=2, views=True)
    assert "site" not in local["clients"].columns
    assert spark.table("lignes_commandes_2").count() == local["lignes_commandes"].count()
    one = spark.read.parquet(f"{root}/full/commandes/v=0").where("site = 1")
    assert "PartitionFilters: [isnotnull(site" in plan(one)


def test_year_layout_prunes(spark, tmp_path):
    path = str(tmp_path / "o")
    layout.layout_by_year(small_store(spark)["commandes"], path)
    read = layout.read_year(spark, path, 2026)
    assert {r.id_commande for r in read.collect()} == {1, 2, 4}
    text = plan(read)
    assert "(order_year#" in text.split("PartitionFilters")[1][:120]
    assert "GreaterThanOrEqual(date_commande" in text


# ---------------------------------------------------------------- fragments


def test_by_query_fragments(spark):
    held = keys_at(FR.derive(small_store(spark), by_query()))
    # The order without a client is there, its line without one.
    assert {row[:2] for row in held["lignes_commandes"]} == {(1, 1), (1, 4), (1, 7), (2, 2), (2, 3)}
    assert held["commandes"] == {(1, 1), (1, 3), (1, 4), (2, 1), (2, 2)}
    assert held["clients"] == {(1, 1), (1, 3), (2, 1), (2, 2)}
    assert held["employes"] == {(1, 1), (1, 2), (2, 1)}
    # Products by category, ordered or not, and their suppliers.
    assert held["produits"] == {(1, 1), (1, 4), (2, 2)} and held["fournisseurs"] == {(1, 1), (1, 2), (2, 2)}
    assert held["categories"] == {(1, 50), (2, 35)}


def test_by_volume_fragments(spark):
    held = keys_at(FR.derive(small_store(spark), by_volume()))
    assert {row[:2] for row in held["lignes_commandes"]} == {(1, 1), (2, 2), (2, 3), (1, 4), (1, 5), (1, 7)}
    assert held["produits"] == {(1, 1), (1, 3), (2, 2)}
    assert held["categories"] == {(1, 50), (1, 9), (2, 35)} and held["fournisseurs"] == {(1, 1), (1, 3), (2, 2)}


def test_second_load_adds_nothing_and_stored_load_is_the_same(spark, tmp_path):
    tables = small_store(spark)
    for rule in (by_query(), by_volume()):
        frags = FR.load_sites(tables, rule, str(tmp_path / rule.name))
        assert keys_at(frags) == keys_at(FR.derive(tables, rule))
        assert keys_at(FR.load_missing(tables, rule, frags)) == keys_at(frags)
        assert FR.fragment(tables, rule, "commandes", existing=frags).isEmpty()


def test_reconstruct_by_volume(spark):
    tables = small_store(spark)
    sited = FR.derive(tables, by_volume())["lignes_commandes"]
    rebuilt = FR.reconstruct([sited.where(F.col("site") == s) for s in (1, 2)])
    gaps = FR.reconstruction_gaps(rebuilt.where("quantite IS NULL OR quantite <> 70").union(rebuilt.limit(1)), tables["lignes_commandes"])
    # Line 6 has no quantity and so no site; line 3 was taken out here, and one row doubled.
    found = sorted((r.gap, r.id_ligne_commande) for r in gaps.collect())
    assert found[1:] == [("lost", 3), ("lost", 6)] and found[0][0] == "extra"
    known = tables["lignes_commandes"].where("quantite IS NOT NULL")
    assert rebuilt.exceptAll(known).isEmpty() and known.exceptAll(rebuilt).isEmpty()


def test_replicas_hold_all_parents(spark):
    held = keys_at(FR.full_replica_load(small_store(spark), by_query()))
    assert len(held["clients"]) == 6 and len(held["commandes"]) == 8 and len(held["lignes_commandes"]) == 5


# ---------------------------------------------------------------- analytics


def test_revenue_leaves_out_missing_terms(spark):
    tables = small_store(spark)
    query = A.revenue_by_category(FR.derive(tables, by_query()), tables, 2026, "absolute")
    # Category 50: 150 × 2.5 − 0.10 and 101 × 2.5; category 35: 60 × 4 − 0.50, the line without discount out.
    assert [tuple(r) for r in query.collect()] == [(50, "n50", Decimal("627.4000")), (35, "n35", Decimal("239.5000"))]
    rate = A.revenue_by_category(FR.derive(tables, by_volume()), tables, 2026, "rate")
    # 150 × 10 × 0.9; 150 × 2.5 × 0.9 + 101 × 2.5; 60 × 4 × 0.5.
    assert [(r[0], r[2]) for r in rate.collect()] == [(9, Decimal("1350.00")), (50, Decimal("590.00")), (35, Decimal("120.00"))]


def test_category_of_only_missing_terms_comes_first(spark):
    tables = small_store(spark)
    only = {**tables, "lignes_commandes": tables["lignes_commandes"].where("id_ligne_commande IN (1, 3)")}
    rows = A.revenue_by_category(FR.derive(only, by_query()), only, 2026, "absolute").collect()
    assert [r[0] for r in rows] == [35, 50] and rows[0][2] is None


def test_orders_per_client(spark):
    tables = small_store(spark)
    assert {tuple(r) for r in A.orders_per_client(tables, 2026).collect()} == {(1, 1), (2, 1), (None, 1)}
    assert {r.id_client for r in A.orders_per_client(tables, 2026, named=True).collect()} == {1, 2}
    extract = A.orders_per_client(tables, 2026, extract=True)
    assert extract.exceptAll(A.orders_per_client(tables, 2026)).isEmpty()


def test_year_range_reaches_the_scan_and_extract_does_not(spark, tmp_path):
    path = str(tmp_path / "c")
    small_store(spark)["commandes"].write.parquet(path)
    orders = spark.read.parquet(path)
    pushed = plan(orders.where(C.year_range(F.col("date_commande"), 2026))).split("PushedFilters")[1]
    assert "GreaterThanOrEqual(date_commande" in pushed and "LessThan(date_comm" in pushed
    extracted = plan(orders.where(C.year_extract(F.col("date_commande"), 2026))).split("PushedFilters")[1]
    assert "GreaterThanOrEqual" not in extracted


def test_small_relations(spark):
    left = spark.createDataFrame([(1, 5), (2, None), (3, 7), (3, 7)], "k bigint, v bigint")
    right = spark.createDataFrame([(1,), (1,), (3,)], "k bigint")
    assert [r.k for r in R.semi(left, right, "k").orderBy("k").collect()] == [1, 3, 3]
    assert [r.k for r in R.anti(left, right, "k").collect()] == [2]
    assert {(r.k, r.there) for r in R.exists_flag(left, right, "k", "there").collect()} == {(1, True), (2, False), (3, True)}
    assert [r.v for r in R.sort_desc(left, "v").collect()] == [None, 7, 7, 5]
    assert R.dedupe(left).count() == 3
    assert R.tagged(left, "SITE_1", ["k"]).first().db == "SITE_1"
    found = R.lookup(left, spark.createDataFrame([(1, "a")], "k bigint, name string"), "k", ["name"])
    assert {(r.k, r.name) for r in found.collect()} == {(1, "a"), (2, None), (3, None)}


def test_scalar_functions(spark):
    row = spark.range(1).select(
        C.blank_to_null(F.lit("")).alias("blank"),
        C.nvl(F.lit(None).cast("bigint"), F.lit(4)).alias("nvl"),
        C.parse_day(F.lit("03/10/2021")).alias("day"),
        F.round(C.net_rate(F.lit(1), F.lit("2.0050").cast("decimal(12,4)"), F.lit("0").cast("decimal(5,4)")), 2).alias("half"),
        C.net_absolute(F.lit(3), F.lit("2").cast("decimal(12,4)"), F.lit("0.5").cast("decimal(5,4)")).alias("net"),
    ).first()
    assert (row.blank, row.nvl, row.day) == (None, 4, dt.datetime(2021, 10, 3))
    assert row.half == Decimal("2.01") and row.net == Decimal("5.5")


# ---------------------------------------------------------------- checks


def test_domain_rules_pass_what_is_unknown(spark):
    tables = make_tables(
        spark,
        clients=[{**client(1), "code_postal": "12345678901"}, {**client(2), "societe": None}, {**client(3), "ville": "v" * 101}],
        produits=[{**product(1, 50), "indisponible": 2}, {**product(2, 50), "indisponible": None}],
        commandes=[
            {**order(1, 1, 1, JAN), "date_livraison": None},
            {**order(2, 1, 1, JAN), "date_livraison": JAN},
            {**order(3, 1, 1, JAN), "date_livraison": dt.datetime(2025, 12, 31)},
        ],
    )
    broken = {(r.tbl, r.rule): r.violations for r in Q.check_domain(tables).collect() if r.violations}
    assert broken == {
        ("clients", "code_postal length"): 1,
        ("clients", "societe not null"): 1,
        ("clients", "ville length"): 1,
        ("produits", "indisponible flag"): 1,
        ("commandes", "livraison not before commande"): 1,
    }


def test_keys_and_references(spark):
    tables = small_store(spark)
    lines = [line(1, 1, 1, 1, 0), line(1, 1, 1, 1, 0), line(None, 1, 1, 1, 0), line(2, 77, None, 1, 0), line(3, 77, 88, 1, 0)]
    tables = {**tables, "lignes_commandes": make_tables(spark, lignes_commandes=lines)["lignes_commandes"]}
    keys = {r.tbl: (r.repeated_keys, r.missing_keys) for r in Q.check_pk(tables).collect()}
    assert keys.pop("lignes_commandes") == (1, 1) and set(keys.values()) == {(0, 0)}
    orphans = {(r.child, r.reference): r.orphans for r in Q.check_fk(tables).collect() if r.orphans}
    assert orphans == {("lignes_commandes", "id_commande"): 2, ("lignes_commandes", "id_produit"): 1}


def test_fragments_hold_their_references(spark):
    frags = FR.derive(small_store(spark), by_query())
    checked = Q.check_fk(frags, per_site=True).collect()
    assert len(checked) == 7 and all(r.orphans == 0 for r in checked)
    assert all((r.repeated_keys, r.missing_keys) == (0, 0) for r in Q.check_pk(frags, per_site=True).collect())


def test_audit_finds_a_product_that_changed_category(spark):
    tables = small_store(spark)
    frags = FR.derive(tables, by_query())
    assert Q.audit(tables, frags, by_query()).isEmpty()
    moved = tables["produits"].withColumn("id_categorie", F.when(F.col("id_produit") == 1, 35).otherwise(F.col("id_categorie")))
    found = Q.audit({**tables, "produits": moved}, frags, by_query()).collect()
    assert {(r.id_ligne_commande, r.expected, r.actual) for r in found} == {(1, 2, 1), (4, 2, 1), (7, 2, 1)}


def test_site_counts(spark):
    frags = make_frags(spark, False, clients=[{**client(1), "site": 1}, {**client(2), "site": 1}, {**client(1), "site": 2}])
    assert {tuple(r) for r in Q.site_counts(frags).collect()} == {("clients", 1, 2), ("clients", 2, 1)}
