"""What must not grow faster than the input: rows dealt out once, lines numbered once, nothing sorted by one task."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from store import change, client, feed, keys_at, line, make_frags, make_tables, order, product

from sitewise import schema as S
from sitewise.functions import prefix
from sitewise.operators import fragments as FR
from sitewise.operators import maintain as M
from sitewise.plans import feed as FD
from sitewise.rules import by_query, by_volume
from sitewise.sources import scripts, snapshots
from sitewise.sources.tables import load_test_tables, stored_lines
from sitewise.streaming import ordered as OR

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def shuffled(spark):
    """Joins as between large tables."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def exchanges(df):
    return [row for row in df._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in row]


def test_tables_of_stored_lines_number_them_once(spark):
    numbered = stored_lines(spark, SMALL)
    stored, lazy = FD.tables_before(spark, SMALL, numbered), FD.tables_before(spark, SMALL)
    for name in stored:
        assert stored[name].exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(stored[name]).isEmpty(), name
        assert "Window" not in stored[name]._jdf.queryExecution().executedPlan().toString()
    for name in ("commandes", "produits"):  # what a join derives is written down too
        assert not exchanges(stored[name])


def test_rows_meet_the_sites_lines_by_id_alone(spark, tmp_path, shuffled):
    lines = spark.createDataFrame(
        [(1, 10, 5, 3, None, 1), (1, 10, 5, 4, None, 2), (2, 11, 6, 7, None, 2)],
        "id_ligne_commande long, id_commande long, id_produit long, quantite long, remise decimal(10,4), site int",
    )
    calls = "seq long, id_ligne_commande long, id_commande long, id_produit long, quantite long, remise decimal(10,4), site_from int, site_to int"
    rows = spark.createDataFrame([(1, 1, None, None, None, None, 2, 1), (2, 2, None, None, None, None, 1, 2), (3, 9, 4, 5, 1, None, 0, 1)], calls)
    met = M._with_lines(lines, rows)
    found = {r.seq: (r.id_commande, r.cur_quantite, r.at_from, r.at_to) for r in met.collect()}
    assert found == {1: (10, 4, True, True), 2: (None, None, False, True), 3: (4, None, False, False)}
    assert exchanges(met) and not any("site" in e for e in exchanges(met))


def test_only_lines_that_come_back_look_for_their_order(spark, shuffled):
    moved = FD.moved_changes(spark, SMALL, FD.change_feed(spark, SMALL))
    assert not any("op#" in e for e in exchanges(moved))


def test_a_single_version_holds_last_states(spark, tmp_path):
    root = str(tmp_path)
    line = "id_ligne_commande long, id_commande long, id_produit long, quantite long, remise decimal(10,4), site int"
    lines = spark.createDataFrame([(1, 1, 1, 1, None, 0), (2, 1, 1, 1, None, 0), (3, 1, 1, 1, None, 0)], line)
    snapshots.fragment_write({"lignes_commandes": lines}, root, 0)
    put = spark.createDataFrame([(2, 1, 1, 9, None, 0), (4, 1, 1, 1, None, 0)], line)
    gone = spark.createDataFrame([(0, 2), (0, 3)], "site int, id_ligne_commande long")
    snapshots.write_deltas({"lignes_commandes": lines}, {"lignes_commandes": snapshots.Delta(gone, put)}, root, 1)
    old, new = snapshots.changed_rows(spark, root, "lignes_commandes", 0, 1)
    assert sorted((r.id_ligne_commande, r.quantite) for r in old.collect()) == [(2, 1), (3, 1)]
    assert sorted((r.id_ligne_commande, r.quantite) for r in new.collect()) == [(2, 9), (4, 1)]
    assert "Join" not in new._jdf.queryExecution().executedPlan().toString()
    now = snapshots.read_version(spark, root, 1)["lignes_commandes"]
    assert sorted((r.id_ligne_commande, r.quantite) for r in now.collect()) == [(1, 1), (2, 9), (4, 1)]


def test_a_script_of_many_pieces_is_cut_into_ranges(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s.sql")
    with open(path, "w") as out:
        out.writelines(f"INSERT INTO T (A, B) VALUES ({i}, 'x;{i}');\n" for i in range(40))
    found = {r.statement for r in scripts.statements(spark, path).collect()}
    ranged = []
    whole = prefix._ranged
    monkeypatch.setattr(prefix, "_ranged", lambda *a: ranged.append(a) or whole(*a))
    monkeypatch.setattr(scripts, "FILE_PIECES", 10)
    assert {r.statement for r in scripts.statements(spark, path).collect()} == found and len(found) == 40
    assert ranged


def test_arrivals_are_stored_once_and_leave_as_the_clock_passes(spark, tmp_path):
    begin = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)

    def batch(*minutes, clock=None):
        rows = [(m, "U", begin + dt.timedelta(minutes=m)) for m in minutes] + ([] if clock is None else [(None, None, begin + dt.timedelta(minutes=clock))])
        some = spark.createDataFrame(rows, "seq long, op string, at timestamp")
        return some.select(*[F.col(f.name) if f.name in some.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in OR.TIMED.fields])

    def run(rows, number):
        late, due = OR.arrive(rows, number, str(tmp_path), dt.timedelta(minutes=10))
        return sorted(r.seq for r in late.collect()), sorted(r.seq for r in due.collect())

    assert run(batch(20, 12), 0) == ([], [])
    for _ in range(2):  # run again, it gives the same
        assert run(batch(11, 25, 30), 1) == ([], [11, 12, 20])
    assert run(batch(5, 21, clock=31), 2) == ([5], [21])
    assert run(batch(22, clock=90), 3) == ([], [22, 25, 30])
    assert run(batch(80, 85), 4) == ([80], [])
    assert not (tmp_path / "arrived" / "batch=0").exists()  # passed whole
    with pytest.raises(ValueError, match="without a time"):
        OR.arrive(batch(95).withColumn("at", F.lit(None).cast("timestamp")), 5, str(tmp_path), dt.timedelta(minutes=10))


# Order 7 loses its only line at site 2, so that the insert after it is refused; line 3 goes to the other site.
REPLAYED = [
    change(1, "U", line(1, 7, 1, 3, 0), line(1, 7, 1, 500, 0)),
    change(2, "I", None, line(9, 7, 1, 4, 0)),
    change(3, "U", line(3, 8, 1, 6, 0), line(3, 8, 1, 7, 0)),
]


def replayed(spark, hot_rows=1000):
    orders, lines = [order(7, 1, 1), order(8, 1, 1)], [line(1, 7, 1, 3, 0), line(2, 7, 1, 900, 0), line(3, 8, 1, 6, 0)]
    tables = make_tables(spark, commandes=orders, lignes_commandes=lines, produits=[product(1, 1, 1)], clients=[client(1)])
    sites = {
        "commandes": [{**o, "site": s} for o, s in ((orders[0], 1), (orders[0], 2), (orders[1], 2))],
        "lignes_commandes": [{**x, "site": s} for x, s in zip(lines, (2, 1, 2))],
        "produits": [{**product(1, 1, 1), "site": s} for s in (1, 2)],
        "clients": [{**client(1), "site": s} for s in (1, 2)],
    }
    frags = make_frags(spark, False, **sites)
    after, held, rejected = M.apply_batch(tables, frags, feed(spark, REPLAYED), by_volume(100), hot_rows=hot_rows)
    refused = [(r.seq, r.site, r.error_code) for r in rejected.collect()]
    return keys_at(held), sorted(r.id_ligne_commande for r in after["lignes_commandes"].collect()), refused


def test_a_batch_is_dealt_out_once_by_line_and_once_by_order(spark, shuffled, monkeypatch):
    dealt, settle = [], M.settle

    def watched(df, *args, **more):
        dealt.extend(exchanges(df))
        return settle(df, *args, **more)

    monkeypatch.setattr(M, "settle", watched)
    held, lines, refused = replayed(spark)
    assert refused == [(2, 2, S.NO_ORDER)] and lines == [1, 2, 3]
    assert {row[:2] for row in held["commandes"]} == {(1, 7), (2, 8)}
    assert dealt and not any("seq#" in e for e in dealt)


@pytest.mark.parametrize("hot_rows, many", [(1, 1000), (1000, 0)])
def test_large_batches_give_what_small_ones_give(spark, monkeypatch, hot_rows, many):
    usual = replayed(spark)
    monkeypatch.setattr(M, "MANY", many)
    assert replayed(spark, hot_rows) == usual


def test_sites_by_query_place_lines_by_few_stored_products(spark, tmp_path, monkeypatch):
    met, lines = [], FR.lines

    def watched(tables, rule):
        met.append(tables["produits"])
        return lines(tables, rule)

    monkeypatch.setattr(FR, "lines", watched)
    tables = load_test_tables(spark, SMALL)
    FR.load_sites(tables, by_query(50, 40, 35, 20), str(tmp_path), wanted=[])
    assert met[0].columns == ["id_produit", "id_categorie"] and all("/settled-" in f for f in met[0].inputFiles())
    assert met[0].where("id_categorie NOT IN (35, 50)").isEmpty()
