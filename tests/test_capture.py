"""Tied orders, captured changes and sequences."""

import random

import pytest
from store import RowStore, change, feed, keys_at, line
from test_parts import small_store
from test_replay import QUANTITIES, make_tables, random_store

from sitewise.functions.ties import connected
from sitewise.operators import fragments as FR
from sitewise.operators import maintain as M
from sitewise.operators.capture import capture_between, capture_changes
from sitewise.operators.changes import apply_changes_global
from sitewise.rules import by_query, by_volume
from sitewise.session import settle, together
from sitewise.sources import sequences as SQ
from sitewise.sources.tables import load_test_tables, numbered_lines, raw
from sitewise.streaming import feed as ST

COLS = ["id_ligne_commande", "id_commande", "id_produit", "quantite", "remise"]


def plain_components(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        if a is not None and b is not None and a != b:
            one, other = sorted((find(a), find(b)))
            root[other] = one
    return {(x, find(x)) for x in root}


@pytest.mark.parametrize("shape", ["chain", "star", "random", "pairs", "none"])
def test_connected(spark, shape):
    rnd = random.Random(3)
    links = {
        "chain": [(i, i + 1) for i in rnd.sample(range(60), 60)],
        "star": [(30, i) for i in range(60)],
        "random": [(rnd.randrange(150), rnd.randrange(150)) for _ in range(110)] + [(None, 1), (4, None), (7, 7)],
        "pairs": [(2 * i, 2 * i + 1) for i in range(40)] * 2,
        "none": [(None, None), (3, 3)],
    }[shape]
    found = connected(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in found.collect()} == plain_components(links) and found.count() == len(plain_components(links))


@pytest.mark.parametrize("rule", [by_query(), by_volume()], ids=lambda r: r.name)
def test_lines_that_tie_orders_equal_row_by_row(spark, rule):
    rows, changes = random_store(11)
    pick = random.Random(11)
    kept, again = changes[:20], []
    for seq, c in enumerate(pick.sample(kept, 9), 100):
        # Every third comes back under another order.
        order = pick.randrange(10) if seq % 3 == 0 else c["id_commande"]
        again.append(change(seq, pick.choice("IUUD"), None, line(c["id_ligne_commande"], order, pick.randrange(8), pick.choice(QUANTITIES), "0.05")))
    tables = make_tables(spark, **rows)
    frags = {name: settle(df) for name, df in FR.derive(tables, rule).items()}
    expected = RowStore(rule.name, rows, keys_at(frags))
    for c in kept + again:
        expected.change(c)
    after, sites, rejected = M.apply_batch(tables, frags, feed(spark, kept + again), rule)
    assert sorted((r.seq, r.error_code) for r in rejected.collect()) == sorted(expected.refused)
    assert keys_at(sites) == expected.state()
    held = {tuple(r) for r in after["lignes_commandes"].collect()}
    assert held == {tuple(r[c] for c in after["lignes_commandes"].columns) for r in expected.lines.values()}


def test_a_tie_costs_other_orders_no_turn(spark):
    """One line names two orders: its group takes the turns it needs, the six other orders two."""
    many = [change(10 * i + k, "U", None, line(i, i, 1, 100 + k, "0.1")) for i in range(1, 7) for k in (1, 2)]
    tie = [change(70 + k, "U", None, line(9, order, 1, 100 + k, "0.1")) for k, order in enumerate((20, 21, 20))]
    changes = feed(spark, many + tie)
    lines = feed(spark, []).select("id_ligne_commande", "id_commande")
    parts = [{(r.id_ligne_commande, r.seq) for r in part.collect()} for part in M.turns(settle(M._grouped(changes, [lines])))]
    assert len(parts) == 3
    assert parts[0] == {(i, 10 * i + 1) for i in range(1, 7)} | {(9, 70)} and parts[2] == {(9, 72)}


def state(spark, rows):
    return feed(spark, [change(i, "U", None, r) for i, r in enumerate(rows)]).selectExpr(*COLS[:2], *[f"new_{c} AS {c}" for c in COLS[2:]])


def test_capture_of_two_states(spark):
    old = state(spark, [line(1, 1, 1, 5, "0.1"), line(2, 1, None, 5, None), line(3, 2, 1, 7, "0"), line(4, 2, 1, 7, "0"), line(5, None, 1, 1, "0"), line(None, 1, 1, 1, "0")])
    new = state(spark, [line(1, 1, 1, 5, "0.1"), line(2, 1, 3, 5, None), line(4, 3, 1, 7, "0"), line(5, None, 1, None, "0"), line(6, 2, 2, 2, "0")])
    found = capture_changes(old, new, first_seq=7)
    shown = [(r.seq, r.op, r.id_ligne_commande, r.id_commande, r.old_quantite, r.new_quantite) for r in found.orderBy("seq").collect()]
    assert shown == [(7, "U", 2, 1, 5, 5), (8, "D", 3, 2, 7, None), (9, "D", 4, 2, 7, None), (10, "I", 4, 3, None, 7), (11, "U", 5, None, 1, None), (12, "I", 6, 2, None, 2)]
    # Applied in order, as in the store: what goes goes first, then what comes.
    goes, comes = found.where("op = 'D'"), found.where("op <> 'D'")
    after = apply_changes_global(apply_changes_global(old.where("id_ligne_commande IS NOT NULL"), goes), comes)
    assert sorted(map(tuple, after.select(*COLS).collect()), key=repr) == sorted(map(tuple, new.collect()), key=repr)
    assert capture_changes(old, old).isEmpty()


def test_capture_between_versions(spark, tmp_path):
    """What versions between touched, also through a whole version; nothing where nothing changed."""
    tables, root, rule = small_store(spark), str(tmp_path / "store"), by_query()
    ST.begin(root, tables, rule)
    batches = [
        [change(1, "U", None, line(1, 1, 1, 160, "0.10")), change(2, "D", line(2, 1, 2, 60, "0.50"), None)],
        [change(3, "I", None, line(8, 3, 2, 75, "0.00")), change(4, "U", None, line(1, 1, 1, 150, "0.10"))],
        [change(5, "D", line(8, 3, 2, 75, "0.00"), None), change(6, "I", None, line(2, 1, 2, 61, "0.50"))],
    ]
    ST.apply_version(feed(spark, batches[0]), root, tables, rule, 0)
    ST.make_whole(spark, root, tables)
    for k in (1, 2):
        ST.apply_version(feed(spark, batches[k]), root, tables, rule, k + 1)

    def held(version):
        return {tuple(r) for r in ST.state(spark, root, tables, version)[0]["lignes_commandes"].select(*COLS).collect()}

    for earlier, later in [(0, 1), (0, 4), (1, 3), (2, 4), (1, 2), (3, 3)]:
        found = capture_between(spark, f"{root}/global", earlier, later)
        rows = found.collect()
        assert {r.id_ligne_commande for r in rows} == {x[0] for x in held(earlier) ^ held(later)}
        old = ST.state(spark, root, tables, earlier)[0]["lignes_commandes"]
        assert {tuple(r) for r in apply_changes_global(old, found).select(*COLS).collect()} == held(later)
    with pytest.raises(ValueError):
        capture_between(spark, f"{root}/global", 2, 1)


def test_sequences_go_on(spark, tmp_path):
    root = str(tmp_path / "sequences")
    rows = spark.range(40).withColumnRenamed("id", "x")
    first = SQ.number_load(rows.where("x < 15"), root, "t", "a", ["x"], "key", start=100, step=2)
    second = SQ.number_load(rows.where("x >= 15"), root, "t", "b", ["x"], "key")
    again = SQ.number_load(rows.where("x < 15").repartition(7), root, "t", "a", ["x"], "key")
    assert [r.key for r in first.orderBy("x").collect()] == list(range(100, 130, 2))
    assert [r.key for r in second.orderBy("x").collect()] == list(range(130, 180, 2))
    assert sorted(again.collect()) == sorted(first.collect())
    assert SQ.lease(spark, root, "t", "none", 0).first == 180 and SQ.lease(spark, root, "t", "c", 1).first == 180
    assert SQ.lease(spark, root, "other", "a", 3).first == 1
    with pytest.raises(ValueError, match="15 keys"):
        SQ.lease(spark, root, "t", "a", 16)


def test_two_loads_at_a_time(spark, tmp_path):
    root = str(tmp_path / "sequences")
    taken = together(spark, [lambda k=k: SQ.lease(spark, root, "t", f"load{k}", 10 + k) for k in range(8)])
    ranges = sorted((x.first, x.after) for x in taken)
    assert ranges[0][0] == 1 and all(a[1] == b[0] for a, b in zip(ranges, ranges[1:]))
    assert len(SQ.leases(spark, root, "t")) == 8


def test_no_job_runs_while_tables_are_named(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("naming", "naming tables")
    tables = load_test_tables(spark, "/root/testdata/sf0.001")
    tables["lignes_commandes"].select("id_ligne_commande")
    jobs = tracker.getJobIdsForGroup("naming")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs


def test_too_many_lines_for_their_ids_fail(spark, tmp_path):
    lines = raw(spark, "/root/testdata/sf0.001", "lineitem").limit(1)
    lines.crossJoin(spark.range(1000)).drop("id").write.parquet(str(tmp_path / "lineitem.parquet"))
    with pytest.raises(Exception, match="too many lines"):
        numbered_lines(spark, str(tmp_path)).select("id_ligne_commande").collect()
