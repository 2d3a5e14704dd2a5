"""Maintenance of the fragments: validated inserts, updates and cascading deletes.

Each procedure runs over a whole batch as set algebra. Row-at-a-time processing decides
whether a change is accepted by the state it meets; here that state is worked out in
closed form:

* Whether a line is at a site, and whether parents are there or can be pulled in, is
  looked up once: a batch holds at most one change per line, so no other change of the
  batch alters the answer.
* What other changes can alter is the order: it goes with its last line. Under the strict
  policy (and for an order that cannot be pulled in again) it then stays away, so all
  that matters is *when* it went, one ``seq`` per order and site. Until the first of its
  sites is lost every sound change is accepted, so a running line count finds that
  moment; from there on inserts and moves to the lost site are refused, and a second
  running count over the remaining changes finds the moment of the other site.

Only the changed ids travel to the large tables (as semi joins, which Spark broadcasts
while they are small); what follows is the size of the batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise import schema as S
from sitewise.functions.columns import error_message
from sitewise.functions.prefix import HOT_ROWS, find_hot, running_sums
from sitewise.functions.relations import anti, exists_flag, semi
from sitewise.functions.ties import connected
from sitewise.operators.changes import classify
from sitewise.operators.fragments import named_by, union_sites
from sitewise.rules import NOWHERE, SITES, STRICT, ByQuery, Rule
from sitewise.session import settle, together
from sitewise.sources.snapshots import Delta, Deltas, Frags, apply_deltas, merge
from sitewise.sources.tables import Tables

QUARANTINE = "quarantine"
FAIL = "fail"

MANY = 2_000_000  # keys that Spark would not broadcast

_LINE = "id_ligne_commande"
_GROUP = "_group"
_VALUES = ("id_produit", "quantite", "remise")
_MOVES = [f"_move{s}" for s in SITES]
_REJECTED = ["seq", "kind", _LINE, "id_commande", "id_produit", "site", "error_code"]


class RejectedChanges(Exception):
    """A batch that must not contain rejected changes did."""


@dataclass
class Outcome:
    """What a batch does to the sites' tables, what it refuses, every change with its verdict,
    and the last change that took a line off a product (None where products are never removed)."""

    deltas: Deltas
    rejected: DataFrame
    decided: DataFrame
    taken: DataFrame | None


@dataclass
class BatchOutcome:
    """What a feed does to the sites and to the global line table, and what it refuses."""

    deltas: Deltas
    lines: Delta | None
    rejected: DataFrame
    taken: DataFrame | None


def _holds(condition: Column) -> Column:
    """A comparison with a missing value does not hold."""
    return F.coalesce(condition, F.lit(False))


def bad_input() -> Column:
    tests = [F.col("quantite") <= 0, F.col("remise") < 0]
    tests += [F.col(key) <= 0 for key in (_LINE, "id_commande", "id_produit")]
    found = F.lit(False)
    for test in tests:
        found = found | _holds(test)
    return found


def bad_values() -> Column:
    return (F.coalesce(F.col("quantite"), F.lit(1)) <= 0) | (F.coalesce(F.col("remise"), F.lit(0)) < 0)


def validate(rows: DataFrame) -> DataFrame:
    """Adds the error code of an action's own values (NULL if sound). A delete has none."""
    code = F.when((F.col("action") == "INSERT") & bad_input(), F.lit(S.BAD_INPUT)).when(
        (F.col("action") == "UPDATE") & bad_values(), F.lit(S.BAD_VALUES)
    )
    return rows.withColumn("error_code", code)


def _pick(site: Column, name: str) -> Column:
    """The column of the chosen site: ``name1`` or ``name2``."""
    chosen = None
    for s in SITES:
        column = F.col(f"{name}{s}")
        chosen = F.when(site == s, column) if chosen is None else chosen.when(site == s, column)
    return chosen


def _order_states(frags: Frags, tables: Tables, named: DataFrame | None, strict: bool) -> DataFrame:
    """Per order (of those named, or all): presence, line count and client at each site, and what the global row says.
    Orders and lines are totalled together, so that each order is dealt out once."""
    sources = {"here": frags["commandes"], "n": frags["lignes_commandes"], "revivable": tables["commandes"]}
    if strict:
        del sources["revivable"]
    if named is not None:
        wanted = named.distinct()
        sources = {name: semi(df, wanted, "id_commande") for name, df in sources.items()}
    at, none = F.col("site"), F.lit(None).cast("bigint")

    def rows(name: str) -> DataFrame:
        whole = name == "revivable"
        return sources[name].select(
            "id_commande",
            *[((at == s) if name == "here" else F.lit(False)).alias(f"here{s}") for s in SITES],
            *[(F.when(at == s, F.col("id_client")) if name == "here" else none).alias(f"client{s}") for s in SITES],
            *[((at == s).cast("bigint") if name == "n" else F.lit(0).cast("bigint")).alias(f"n{s}") for s in SITES],
            (F.col("id_client") if whole else none).alias("client_g"),
            (F.col("id_client").isNotNull() & F.col("id_employe").isNotNull() if whole else F.lit(False)).alias("revivable"),
        )

    both = union_sites([rows(name) for name in sources])
    return both.groupBy("id_commande").agg(
        *[F.max(f"here{s}").alias(f"here{s}") for s in SITES],
        *[F.sum(f"n{s}").alias(f"n{s}") for s in SITES],
        *[F.max(f"client{s}").alias(f"client{s}") for s in SITES],
        F.max("client_g").alias("client_g"),
        F.max("revivable").alias("revivable"),
    )


def _with_states(met: DataFrame, states: DataFrame) -> DataFrame:
    """Changes with the state of their order; one that is nowhere has no lines. What names no order has no state."""
    nothing = {"revivable": False, **{f"here{s}": False for s in SITES}, **{f"n{s}": 0 for s in SITES}}
    named = F.col("id_commande").isNotNull()
    found = met.join(states, "id_commande", "left")
    return found.withColumns({c: F.when(named, F.coalesce(c, F.lit(value))) for c, value in nothing.items()})


def _lines_named(named: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Gives of lines those that stored rows name, for a join with these by id. Beyond ``MANY`` rows it gives all: the
    ids would be shuffled, and the lines as well, only to leave out what the join passes over anyway."""
    many = named.count() > MANY
    return lambda lines: lines if many else semi(lines, named, _LINE)


def _with_lines(lines: DataFrame, rows: DataFrame, named: DataFrame | None = None) -> DataFrame:
    """Rows with the line as it is at ``site_from``, and whether it is at ``site_to``. The lines of each site meet them
    by id alone, so that rows and lines are dealt out once. ``named``: stored rows that name the same lines."""
    of_rows = _lines_named(rows if named is None else named)
    columns = ["id_commande", *_VALUES, *(["id_client"] if "id_client" in lines.columns else [])]
    met = rows
    for s in SITES:
        own = of_rows(lines.where(F.col("site") == s))
        met = met.join(own.select(_LINE, *[F.col(c).alias(f"_{c}{s}") for c in columns], F.lit(True).alias(f"_at{s}")), _LINE, "left")
    at_from = F.col("site_from")
    order_there = _pick(at_from, "_id_commande")
    if "kind" in rows.columns:  # what goes nowhere keeps the order it names
        order_there = F.when(F.col("kind") != "N", order_there)
    return met.select(
        *[c for c in rows.columns if c != "id_commande"],
        F.coalesce(order_there, "id_commande").alias("id_commande"),
        *[_pick(at_from, f"_{c}").alias(f"cur_{c}") for c in _VALUES],
        (_pick(at_from, "_id_client") if "id_client" in columns else F.lit(None).cast("bigint")).alias("cur_client"),
        _holds(_pick(at_from, "_at")).alias("at_from"),
        _holds(_pick(F.col("site_to"), "_at")).alias("at_to"),
    )


def _at(site: Column) -> Column:
    return F.coalesce(site, F.lit(NOWHERE)).alias("_at")


def _unknown_products(frags: Frags, tables: Tables, rows: DataFrame, strict: bool) -> DataFrame:
    """``id_produit`` and site (``_at``) that rows name and that are neither at that site nor (unless strict) to be had from the
    global table. Stored: few as a rule, and then the rows need not be dealt out by product."""
    on = ["id_produit", "_at"]
    pairs = rows.select("id_produit", _at(F.col("site_to"))).where(F.col("id_produit").isNotNull()).distinct()
    unknown = pairs.join(frags["produits"].select("id_produit", _at(F.col("site"))), on, "left_anti")
    if not strict:
        whole = tables["produits"].where(F.col("id_fournisseur").isNotNull() & F.col("id_categorie").isNotNull())
        unknown = unknown.join(whole.select("id_produit"), "id_produit", "left_anti")
    return settle(unknown)


def _meet(frags: Frags, rows: DataFrame, named: DataFrame, repeats: bool = False) -> DataFrame:
    """Every change with the line it meets, stored; with ``repeats`` also how many changes name its line at its site, ``_calls``."""
    for code in ("pre_code", "post_code"):
        if code not in rows.columns:
            rows = rows.withColumn(code, F.lit(None).cast("int"))
    met = _with_lines(frags["lignes_commandes"], rows, named)
    if repeats:
        met = met.withColumn("_calls", F.count(F.lit(1)).over(W.partitionBy(_LINE, "site_to")))
    return settle(met, dense=True)


def _stage(frags: Frags, tables: Tables, met: DataFrame, policy: str) -> DataFrame:
    """Every change with the state it meets and the code that no other change can alter."""
    strict = policy == STRICT
    unknown = _unknown_products(frags, tables, met, strict)
    wanted = None if met.count() > MANY else met.select("id_commande").where(F.col("id_commande").isNotNull())
    met = _with_states(met, _order_states(frags, tables, wanted, strict))
    met = met.withColumn("here_to", _holds(_pick(F.col("site_to"), "here")))
    met = exists_flag(met.withColumn("_at", _at(F.col("site_to"))), unknown, ["id_produit", "_at"], "_unknown", unique=True)

    product_known = F.col("id_produit").isNotNull() & ~F.col("_unknown")
    insert = (
        F.when(bad_input(), F.lit(S.BAD_INPUT))
        .when(F.col("at_to"), F.lit(S.DUPLICATE_LINE))
        .when(~(F.col("here_to") | F.col("revivable")), F.lit(S.NO_ORDER if strict else S.NO_DATA_FOUND))
        .when(~product_known, F.lit(S.NO_PRODUCT if strict else S.NO_DATA_FOUND))
    )
    no_line = F.when(~F.col("at_from"), F.lit(S.NO_LINE_TO_DELETE)) if strict else F.lit(None).cast("int")
    update = (
        F.when(~F.col("at_from"), F.lit(S.NO_LINE_TO_UPDATE))
        .when(
            F.col("id_produit").isNotNull() & ~product_known, F.lit(S.NO_NEW_PRODUCT if strict else S.NO_DATA_FOUND)
        )
        .when(bad_values(), F.lit(S.BAD_VALUES))
    )
    kind = F.col("kind")
    at_site = (
        F.when(kind == "I", insert)
        .when(kind == "D", no_line)
        .when(kind == "U", update)
        .when(kind == "M", F.coalesce(no_line, insert))
    )
    return met.withColumn("error_code", F.coalesce("pre_code", at_site, "post_code")).drop("_unknown", "_at")


def _repeat_inserts(staged: DataFrame) -> DataFrame:
    """Of several sound inserts of one line at one site the first counts; the line is there for the rest."""
    sound = staged.where(F.col("error_code").isNull())
    first = sound.groupBy(_LINE, "site_to").agg(F.min("seq").alias("_first"))
    late = _holds(F.col("seq") > F.col("_first")) & F.coalesce(F.col("error_code") != S.BAD_INPUT, F.lit(True))
    several = F.col("_calls") > 1
    judged = (
        staged.where(several)
        .join(first, [_LINE, "site_to"], "left")
        .withColumn("error_code", F.when(late, F.lit(S.DUPLICATE_LINE)).otherwise(F.col("error_code")))
        .drop("_first")
    )
    return staged.where(~several).unionByName(judged).drop("_calls")


def _open_to() -> Column:
    """Changes that bring a line to a site and that the loss of its order would refuse."""
    return F.col("kind").isin("I", "M") & (
        F.col("error_code").isNull() | F.col("error_code").isin(S.NO_PRODUCT, S.PARENT_NOT_FOUND)
    )


def _late_refused(staged: DataFrame, refused: int) -> DataFrame:
    """Changes that come after their order was lost, refused; where no order has very many changes.

    The same two running counts as in ``_losses``, as windows over the order by which the changes
    met its state, so that they are dealt out by order once for all of it.
    """
    order = W.partitionBy("id_commande")
    until = order.orderBy("seq").rowsBetween(W.unboundedPreceding, W.currentRow)
    counts = F.col("error_code").isNull() & ~F.col("revivable") & F.col("kind").isin("I", "D", "M")
    frm, to, seq = F.col("_from"), F.col("_to"), F.col("seq")

    def off(count: str) -> Column:
        """The last line of an order goes off a site."""
        return _holds((frm != NOWHERE) & (_pick(frm, "n") + _pick(frm, count) == 0))

    def change(s: int) -> Column:
        return (to == s).cast("bigint") - (frm == s).cast("bigint")

    rows = staged.withColumns(
        {
            "_from": F.when(counts & F.col("at_from"), F.col("site_from")).otherwise(F.lit(NOWHERE)),
            "_to": F.when(counts & (F.col("kind") != "D"), F.col("site_to")).otherwise(F.lit(NOWHERE)),
        }
    )
    rows = rows.withColumns({f"_c{s}": F.sum(change(s)).over(until) for s in SITES})
    rows = rows.withColumn("_first", F.min(F.when(off("_c"), F.struct("seq", "_from"))).over(order))
    t1, s1 = F.col("_first.seq"), F.col("_first._from")
    left = _holds((seq <= t1) | (to != s1))
    rows = rows.withColumns({f"_e{s}": F.sum(F.when(left, change(s))).over(until) for s in SITES})
    second = F.when(left & (seq > t1) & (frm != s1) & off("_e"), seq)
    rows = rows.withColumn("_second", F.min(second).over(order))
    late = _open_to() & _holds(seq > F.when(s1 == F.col("site_to"), t1).otherwise(F.col("_second")))
    rows = rows.withColumn("error_code", F.when(late, F.lit(refused)).otherwise(F.col("error_code")))
    return _marked_moves(rows).select(*staged.columns, *_MOVES)


def _marked_moves(judged: DataFrame) -> DataFrame:
    """One change of every order with what becomes of the order at each site: 0 it loses its last line, 1 it comes, else NULL."""
    order = W.partitionBy("id_commande")
    ok, kind = F.col("error_code").isNull(), F.col("kind")
    one = F.row_number().over(order.orderBy("seq")) == 1

    def move(s: int) -> Column:
        lost = F.count_if(ok & kind.isin("D", "M") & F.col("at_from") & (F.col("site_from") == s)).over(order)
        won = F.count_if(ok & kind.isin("I", "M") & (F.col("site_to") == s)).over(order)
        here, left = F.col(f"here{s}"), F.col(f"n{s}") + won - lost
        return F.when(one & here & (lost > 0) & (left == 0), F.lit(0)).when(one & ~here & (won > 0) & (left > 0), F.lit(1))

    return judged.withColumns({name: move(s) for name, s in zip(_MOVES, SITES)})


def _losses(staged: DataFrame, hot_rows: int) -> DataFrame | None:
    """When an order that cannot come back was lost: ``gone1``, ``gone2`` per order.
    None where no change concerns such an order."""
    frm, to = F.col("_from"), F.col("_to")
    events = (
        staged.where(F.col("error_code").isNull() & ~F.col("revivable") & F.col("kind").isin("I", "D", "M"))
        .select(
            "id_commande",
            "seq",
            F.when(F.col("at_from"), F.col("site_from")).otherwise(F.lit(NOWHERE)).alias("_from"),
            F.when(F.col("kind") != "D", F.col("site_to")).otherwise(F.lit(NOWHERE)).alias("_to"),
            *[f"n{s}" for s in SITES],
        )
        .withColumns({f"d{s}": (to == s).cast("bigint") - (frm == s).cast("bigint") for s in SITES})
    )

    if events.isEmpty():
        return None

    def emptied(rows: DataFrame) -> DataFrame:
        """Changes that take the last line of an order off a site."""
        counted = running_sums(rows, ["id_commande"], ["seq"], {f"c{s}": f"d{s}" for s in SITES}, hot_rows)
        left = _pick(frm, "n") + _pick(frm, "c")
        return counted.where((frm != NOWHERE) & (left == 0))

    first = emptied(events).groupBy("id_commande").agg(F.min(F.struct("seq", "_from")).alias("first"))
    first = settle(first.select("id_commande", F.col("first.seq").alias("t1"), F.col("first._from").alias("s1")))
    after = events.join(first, "id_commande").where((F.col("seq") <= F.col("t1")) | (to != F.col("s1")))
    second = (
        emptied(after)
        .where((F.col("seq") > F.col("t1")) & (frm != F.col("s1")))
        .groupBy("id_commande")
        .agg(F.min("seq").alias("t2"))
    )
    lost = first.join(second, "id_commande", "left")
    return lost.select(
        "id_commande", *[F.when(F.col("s1") == s, F.col("t1")).otherwise(F.col("t2")).alias(f"gone{s}") for s in SITES]
    )


def _no_hot_order(met: DataFrame, hot_rows: int) -> bool:
    """Whether no order has more than ``hot_rows`` changes. Orders are counted by crowds first: where no crowd has so
    many, none of its orders has, and the changes need not be counted by order."""
    rows = met.count()
    if rows <= hot_rows:
        return True
    crowd = F.pmod(F.xxhash64("id_commande"), F.lit(max(1000, 4 * rows // hot_rows))).alias("crowd")
    return any(find_hot(met.select(key), [name], hot_rows).isEmpty() for key, name in ((crowd, "crowd"), (F.col("id_commande"), "id_commande")))


def _decide(
    frags: Frags, tables: Tables, met: DataFrame, policy: str, repeats: bool = False, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Every change with its final code, NULL where it is accepted."""
    staged = _stage(frags, tables, met, policy)
    if repeats:
        return settle(_repeat_inserts(settle(staged)))
    refused = S.NO_ORDER if policy == STRICT else S.NO_DATA_FOUND
    if _no_hot_order(met, hot_rows):
        return settle(_late_refused(staged, refused), dense=True)
    staged = settle(staged)
    lost = _losses(staged, hot_rows)
    if lost is None:
        return staged
    open_to = _open_to()
    # Changes that come too late are few as a rule: stored, they are marked without dealing out the rest again.
    named = F.coalesce(_LINE, F.lit(0)).alias("_named")
    judged = staged.where(open_to).select("seq", named, "id_commande", "site_to").join(lost, "id_commande")
    late = settle(judged.where(F.col("seq") > _pick(F.col("site_to"), "gone")).select("seq", "_named").distinct())
    if late.isEmpty():
        return staged
    marked = exists_flag(staged.withColumn("_named", named), late, ["seq", "_named"], "_late", unique=True)
    hit = open_to & F.col("_late")
    return settle(
        marked.withColumn("error_code", F.when(hit, F.lit(refused)).otherwise(F.col("error_code"))).drop("_late", "_named")
    )


def _written(ok: DataFrame, lines: DataFrame) -> DataFrame:
    """Line rows that accepted changes write: updates keep what they do not name."""
    with_client = "id_client" in lines.columns
    updates = ok.where(F.col("kind") == "U").select(
        _LINE,
        "id_commande",
        *[F.coalesce(c, f"cur_{c}").alias(c) for c in _VALUES],
        *([F.col("cur_client").alias("id_client")] if with_client else []),
        F.col("site_from").alias("site"),
    )
    client = F.when(F.col("here_to"), _pick(F.col("site_to"), "client")).otherwise(F.col("client_g"))
    inserts = ok.where(F.col("kind").isin("I", "M")).select(
        _LINE,
        "id_commande",
        *_VALUES,
        *([client.alias("id_client")] if with_client else []),
        F.col("site_to").alias("site"),
    )
    return updates.unionByName(inserts)


def _order_moves(decided: DataFrame) -> DataFrame:
    """Orders that lose their last line at a site, and (``gained``) orders that come to a site."""
    if set(_MOVES) <= set(decided.columns):  # found while the changes lay by order
        at = F.array(*[F.struct(F.lit(s).alias("site"), F.col(f"client{s}").alias("id_client"), F.col(f"_move{s}").alias("move")) for s in SITES])
        marked = decided.where(F.coalesce(*_MOVES).isNotNull()).select("id_commande", F.explode(at).alias("at"))
        gained = (F.col("at.move") == 1).alias("gained")
        return marked.where(F.col("at.move").isNotNull()).select("at.site", "id_commande", "at.id_client", gained)
    ok = decided.where(F.col("error_code").isNull())
    lost, won = (F.col("kind").isin("D", "M") & F.col("at_from")), F.col("kind").isin("I", "M")
    totals = ok.groupBy("id_commande").agg(
        *[F.count_if(lost & (F.col("site_from") == s)).alias(f"lost{s}") for s in SITES],
        *[F.count_if(won & (F.col("site_to") == s)).alias(f"won{s}") for s in SITES],
        *[F.max(f"{name}{s}").alias(f"{name}{s}") for name in ("n", "here", "client") for s in SITES],
    )
    per_site = totals.select(
        "id_commande",
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(s).alias("site"),
                        *[F.col(f"{name}{s}").alias(name) for name in ("lost", "won", "n", "here", "client")],
                    )
                    for s in SITES
                ]
            )
        ).alias("at"),
    ).select("id_commande", "at.*")
    left = F.col("n") + F.col("won") - F.col("lost")
    emptied = F.col("here") & (F.col("lost") > 0) & (left == 0)
    gained = ~F.col("here") & (F.col("won") > 0) & (left > 0)
    moved = per_site.where(emptied | gained)
    return moved.select("site", "id_commande", F.col("client").alias("id_client"), gained.alias("gained"))


def _unused(candidates: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Candidate (site, key) pairs that no child names; the candidates are the small side."""
    on = ["site", key]
    return anti(candidates, semi(children.select(*on), candidates, on), on)


def _pulled(table: DataFrame, have: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Global rows for the wanted (site, key) pairs that a site does not hold."""
    pairs = wanted.select("site", key).where(F.col(key).isNotNull()).distinct()
    known = semi(have.select("site", key), pairs, ["site", key])
    return named_by(table, pairs.join(known, ["site", key], "left_anti"), key)


def _deltas(frags: Frags, tables: Tables, decided: DataFrame, policy: str) -> Deltas:
    """What the accepted changes take out of each table and put in. Products only come here;
    ``_without_unused`` takes out those that no line names any more."""
    ok = decided.where(F.col("error_code").isNull())
    lines = frags["lignes_commandes"]
    touched = ok.where(F.col("kind").isin("D", "M", "U") & F.col("at_from")).select(
        F.col("site_from").alias("site"), _LINE
    )
    deltas = {"lignes_commandes": Delta(touched, _written(ok, lines))}

    moves = settle(_order_moves(decided))
    emptied = moves.where(~F.col("gained")).select("site", "id_commande", "id_client")
    wanted = ok.where(F.col("kind").isin("I", "M", "U")).select(F.col("site_to").alias("site"), "id_produit")
    # What is pulled in is the size of the batch and names further parents: found once, in
    # one pass over the global orders and products.
    if policy == STRICT:
        pulled_orders = named_by(tables["commandes"], moves.where(F.lit(False)), "id_commande")
    else:
        gained = moves.where(F.col("gained"))
        pulled_orders, pulled_products = together(
            lines.sparkSession,
            [
                lambda: settle(named_by(tables["commandes"], gained, "id_commande")),
                lambda: settle(_pulled(tables["produits"], frags["produits"], wanted, "id_produit")),
            ],
        )
    deltas["commandes"] = Delta(emptied.select("site", "id_commande"), pulled_orders)
    after = apply_deltas(frags, deltas)

    candidates = emptied.where(F.col("id_client").isNotNull()).select("site", "id_client").distinct()
    deltas["clients"] = Delta(
        _unused(candidates, after["commandes"], "id_client"),
        _pulled(tables["clients"], frags["clients"], pulled_orders, "id_client"),
    )
    if policy == STRICT:
        return deltas

    deltas["produits"] = Delta(pulled_products.select("site", "id_produit").where(F.lit(False)), pulled_products)
    for parent, key, children in (
        ("employes", "id_employe", pulled_orders),
        ("fournisseurs", "id_fournisseur", pulled_products),
        ("categories", "id_categorie", pulled_products),
    ):
        added = _pulled(tables[parent], frags[parent], children, key)
        deltas[parent] = Delta(added.select("site", key).where(F.lit(False)), added)
    return deltas


def _last_taken(decided: DataFrame) -> DataFrame:
    """Per site and product, the last accepted change that took a line off it."""
    moved_off = (F.col("kind") == "U") & _holds(F.col("id_produit") != F.col("cur_id_produit"))
    took = decided.where(F.col("error_code").isNull() & F.col("at_from") & (F.col("kind").isin("D", "M") | moved_off))
    return took.groupBy(F.col("site_from").alias("site"), F.col("cur_id_produit").alias("id_produit")).agg(
        F.max("seq").alias("seq"), F.max_by("kind", "seq").alias("by")
    )


def _without_unused(frags: Frags, deltas: Deltas, taken: DataFrame | None) -> Deltas:
    """A product goes when a same-site update takes its last line off it. A delete leaves it.

    Of a product that no line names in the end, the last change that took a line off it
    took the last one, whatever the order in which the changes were worked out.
    """
    if taken is None:
        return deltas
    last = taken.groupBy("site", "id_produit").agg(F.max_by("by", "seq").alias("by"))
    lines = apply_deltas(frags, {"lignes_commandes": deltas["lignes_commandes"]})["lignes_commandes"]
    dropped = settle(_unused(last.where(F.col("by") == "U").select("site", "id_produit"), lines, "id_produit"))
    nothing = deltas["produits"].added.where(F.lit(False))
    return {**deltas, "produits": merge(deltas["produits"], Delta(dropped, nothing))}


def _rejected(decided: DataFrame, policy: str) -> DataFrame:
    at_target = (F.col("site_to") != NOWHERE) & (F.col("error_code") != S.NO_LINE_TO_DELETE)
    site = F.when(at_target, F.col("site_to")).otherwise(F.col("site_from"))
    messages = S.STRICT_MESSAGES if policy == STRICT else S.HYDRATE_MESSAGES
    return (
        decided.where(F.col("error_code").isNotNull())
        .withColumn("site", site)
        .select(*_REJECTED)
        .withColumn("error_message", error_message(F.col("error_code"), messages))
    )


def _run(
    frags: Frags, tables: Tables, met: DataFrame, policy: str, repeats: bool = False, hot_rows: int = HOT_ROWS
) -> Outcome:
    """What changes do that have met their lines (``_meet``)."""
    decided = _decide(frags, tables, met, policy, repeats, hot_rows)
    taken = None if policy == STRICT else _last_taken(decided)
    return Outcome(_deltas(frags, tables, decided, policy), _rejected(decided, policy), decided, taken)


def _then(first: Outcome | BatchOutcome | None, more: Outcome | BatchOutcome) -> BatchOutcome:
    """Two parts after each other as one, written down, so that plans do not grow with the parts."""
    lines = more.lines if isinstance(more, BatchOutcome) else None
    if first is None:
        return _settled(BatchOutcome(more.deltas, lines, more.rejected, more.taken))
    return _settled(
        BatchOutcome(
            {name: merge(first.deltas[name], more.deltas[name]) for name in first.deltas},
            None if lines is None else merge(first.lines, lines),
            first.rejected.unionByName(more.rejected),
            None if more.taken is None else first.taken.unionByName(more.taken),
        )
    )


def _in_parts(frags: Frags, tables: Tables, parts: Iterator[DataFrame], policy: str) -> tuple[Frags, DataFrame]:
    """Calls in parts, each on what the parts before it left."""
    first = next(parts)
    total = _run(frags, tables, _meet(frags, first, first), policy)
    for k, part in enumerate(parts):
        total = total if k else _then(None, total)  # written down only where another part reads it
        now = apply_deltas(frags, total.deltas)
        total = _then(total, _run(now, tables, _meet(now, part, part), policy))
    deltas = _without_unused(frags, total.deltas, total.taken)
    return apply_deltas(frags, deltas), total.rejected


def insert_lines(frags: Frags, tables: Tables, rows: DataFrame, policy: str) -> tuple[Frags, DataFrame]:
    """Insert rows (seq, site, line columns) at their sites.

    ``hydrate`` pulls missing parents from the global tables; ``strict`` refuses the row.
    """
    calls = rows.withColumns({"kind": F.lit("I"), "site_from": F.lit(NOWHERE)}).withColumnRenamed("site", "site_to")
    calls = settle(calls)
    outcome = _run(frags, tables, _meet(frags, calls, calls, repeats=True), policy, repeats=True)
    return apply_deltas(frags, outcome.deltas), outcome.rejected


def update_lines(frags: Frags, tables: Tables, rows: DataFrame, policy: str) -> tuple[Frags, DataFrame]:
    """Update rows (seq, site, line id, product, quantity, discount); NULL keeps the value.
    A line named again is updated again, on what the call before left: such calls are taken
    in turns, as many as one line has calls. Of a line, ``seq`` must be unique."""
    calls = rows.withColumns(
        {"kind": F.lit("U"), "site_from": F.col("site"), "id_commande": F.lit(None).cast("bigint")}
    ).withColumnRenamed("site", "site_to")
    calls = settle(calls)
    return _in_parts(frags, tables, turns(calls.withColumn(_GROUP, F.col(_LINE)), (_LINE, "site_from")), policy)


def delete_lines(frags: Frags, tables: Tables, rows: DataFrame, policy: str) -> tuple[Frags, DataFrame]:
    """Delete lines (seq, site, line id); orders without a line and clients without an order
    go with them. An unknown line, or one that an earlier call deleted, is refused (strict)
    or passed over (hydrate). Of a line, ``seq`` must be unique."""
    empty = {c: F.lit(None).cast("bigint") for c in ("id_commande", "id_produit", "quantite")}
    calls = rows.withColumns(
        {"kind": F.lit("D"), "site_to": F.lit(NOWHERE), **empty, "remise": F.lit(None).cast(S.RATE)}
    ).withColumnRenamed("site", "site_from")
    calls = settle(calls)
    on = [_LINE, "site_from"]
    again = _repeats(calls, on)
    if again.isEmpty():
        parts = [calls]
    else:
        marked = calls.join(again.select(*on, "_first"), on, "left")
        late = _holds(F.col("seq") > F.col("_first"))
        parts = [marked.where(~late).drop("_first"), marked.where(late).drop("_first")]
    return _in_parts(frags, tables, iter(parts), policy)


def _against_global(changes: DataFrame, tables: Tables) -> DataFrame:
    """Changes that reach a row, with the row as it is now for the side before, and the codes
    of the global table's own constraints."""
    now = _lines_named(changes)(tables["lignes_commandes"]).select(
        _LINE, *[F.col(c).alias(f"old_{c}") for c in _VALUES], F.lit(True).alias("_known")
    )
    found = changes.drop(*[f"old_{c}" for c in _VALUES]).join(now, _LINE, "left")
    insert, delete = F.col("op") == "I", F.col("op") == "D"
    found = found.where(insert | F.col("_known")).withColumn(
        "pre_code", F.when(insert & _holds(F.col("_known")), F.lit(S.UNIQUE_VIOLATED))
    )
    # Missing parents are few as a rule: stored, they reach the changes without these being dealt out again.
    no_order, no_product = together(
        changes.sparkSession,
        [
            partial(_missing, changes, tables["commandes"], "id_commande", "id_commande"),
            partial(_missing, changes, tables["produits"], "new_id_produit", "id_produit"),
        ],
    )
    found = exists_flag(found, no_order, "id_commande", "_no_order", unique=True)
    found = exists_flag(found, no_product, "new_id_produit", "_no_product", unique=True)
    orphan = F.col("_no_order") | F.col("_no_product")
    return found.withColumn("post_code", F.when(~delete & orphan, F.lit(S.PARENT_NOT_FOUND))).drop(
        "_known", "_no_order", "_no_product"
    )


def _missing(changes: DataFrame, parents: DataFrame, name: str, key: str) -> DataFrame:
    """The parents' keys that changes name and the global table does not hold. Stored."""
    named = changes.where(F.col("op") != "D").select(name).where(F.col(name).isNotNull()).distinct()
    return settle(named.join(parents.select(F.col(key).alias(name)), name, "left_anti"))


def _one_change_per_line(
    tables: Tables, frags: Frags, changes: DataFrame, rule: Rule, hot_rows: int
) -> BatchOutcome:
    products = tables["produits"]
    if isinstance(rule, ByQuery):  # of few categories: known to be small once stored
        products = settle(products.where(F.col("id_categorie").isin(rule.categories)).select("id_produit", "id_categorie"))
    named = classify(_against_global(changes, tables), products, rule, keep_all=True)
    rows = named.select(
        "seq",
        "op",
        _LINE,
        "id_commande",
        *[F.col(f"new_{c}").alias(c) for c in _VALUES],
        F.col("old_site").alias("site_from"),
        F.col("new_site").alias("site_to"),
        "kind",
        "pre_code",
        "post_code",
    )
    # By line, changes meet the global table and the sites in one go, dealt out once.
    met = _meet(frags, rows, changes)
    unsited = met.where(F.col("kind") == "N").withColumn("error_code", F.coalesce("pre_code", "post_code"))
    outcome = _run(frags, tables, met.where(F.col("kind") != "N"), rule.policy, hot_rows=hot_rows)

    written = ["op", _LINE, "id_commande", *_VALUES]
    accepted = (
        outcome.decided.select(*written, "error_code")
        .unionByName(unsited.select(*written, "error_code"))
        .where(F.col("error_code").isNull())
    )
    return BatchOutcome(
        outcome.deltas,
        global_delta(accepted),
        outcome.rejected.unionByName(_rejected(unsited, rule.policy)),
        outcome.taken,
    )


def global_delta(accepted: DataFrame) -> Delta:
    """What accepted changes take out of the global line table and put in (its site is 0)."""
    nowhere = F.lit(NOWHERE).alias("site")
    return Delta(
        accepted.where(F.col("op") != "I").select(nowhere, _LINE),
        accepted.where(F.col("op") != "D").select(_LINE, "id_commande", *_VALUES, nowhere),
    )


def _repeats(changes: DataFrame, on: Sequence[str] = (_LINE,)) -> DataFrame:
    """Lines that change more than once, with their first change."""
    counted = changes.groupBy(*on).agg(F.min("seq").alias("_first"), F.count(F.lit(1)).alias("_n"))
    return counted.where(F.col("_n") > 1)


def line_orders(changes: DataFrame, stores: Sequence[DataFrame]) -> DataFrame:
    """The (line, order) pairs that a feed names, or that the stores hold of its lines. Stored."""
    named = changes.select(_LINE, "id_commande")
    for lines in stores:
        named = named.unionByName(semi(lines, changes, _LINE).select(_LINE, "id_commande"))
    return settle(named.distinct())


def tied_orders(pairs: DataFrame) -> DataFrame:
    """``id_commande, groupe`` of the orders that lines with several orders tie together; ``groupe`` is the least of them."""
    order = F.col("id_commande")
    several = pairs.groupBy(_LINE).agg(F.min(order).alias("a"), F.max(order).alias("top")).where(F.col("a") != F.col("top"))
    links = pairs.join(several.select(_LINE, "a"), _LINE).select("a", order.alias("b"))
    return connected(links).select(F.col("node").alias("id_commande"), F.col("root").alias("groupe"))


def _grouped(changes: DataFrame, stores: Sequence[DataFrame]) -> DataFrame:
    """Changes with the group that must be taken in order: the order of their line, as the feed and the
    stores name it, with the orders that it is tied to by lines that name several."""
    pairs = line_orders(changes, stores)
    order = pairs.groupBy(_LINE).agg(F.min("id_commande").alias("id_commande"))
    found = order.join(tied_orders(pairs), "id_commande", "left")
    return changes.join(found.select(_LINE, F.coalesce("groupe", "id_commande", _LINE).alias(_GROUP)), _LINE)


def turns(changes: DataFrame, on: Sequence[str] = (_LINE,)) -> Iterator[DataFrame]:
    """Changes cut into consecutive parts per group, none of which names a line twice.

    Part k holds the k-th part of every group, so there are as many as the group with most
    parts has; a group is cut only where one of its own lines comes again.
    """
    rest = changes
    while True:
        repeated = settle(_repeats(rest, on))
        if repeated.isEmpty():
            yield rest.drop(_GROUP)
            return
        again = rest.join(repeated, list(on)).where(F.col("seq") > F.col("_first"))
        cuts = settle(again.groupBy(_GROUP).agg(F.min("seq").alias("_cut")))
        if cuts.isEmpty():  # of equal seq: they cannot be told apart
            yield rest.drop(_GROUP)
            return
        marked = rest.join(cuts, _GROUP, "left")
        late = _holds(F.col("seq") >= F.col("_cut"))
        yield marked.where(~late).drop("_cut", _GROUP)
        rest = settle(marked.where(late).drop("_cut"))


def _global_after(lines: DataFrame, delta: Delta) -> DataFrame:
    return lines.join(delta.gone.select(_LINE), _LINE, "left_anti").unionByName(delta.added.drop("site"))


def decide_batch(
    tables: Tables,
    frags: Frags,
    changes: DataFrame,
    rule: Rule,
    on_reject: str = QUARANTINE,
    hot_rows: int = HOT_ROWS,
) -> BatchOutcome:
    """What a feed of changes does, as if row by row in ``seq`` order.

    The row before a change is the one the global table holds then; the feed's own ``old_``
    values are not used. A refused change is undone everywhere and reported.

    Where lines change more than once the feed is taken in turns, each with at most one
    change per line. What a change meets depends on its own order only, and on those that lines with
    several orders tie to it, so every such group is cut by itself: there are at most as many turns
    as one group has changes.
    """
    changes = settle(changes.drop(*[f"old_{c}" for c in _VALUES]), dense=True)
    if changes.groupBy(_LINE).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty():
        total = _one_change_per_line(tables, frags, changes, rule, hot_rows)
    else:
        total = None
        for part in turns(_grouped(changes, [tables["lignes_commandes"], frags["lignes_commandes"]])):
            now, sites = tables, frags
            if total is not None:
                now = {**tables, "lignes_commandes": _global_after(tables["lignes_commandes"], total.lines)}
                sites = apply_deltas(frags, total.deltas)
            total = _then(total, _one_change_per_line(now, sites, part, rule, hot_rows))
    total.deltas = _without_unused(frags, total.deltas, total.taken)
    if on_reject == FAIL and not total.rejected.isEmpty():
        raise RejectedChanges(f"{total.rejected.count()} changes refused")
    return total


def _settled(outcome: BatchOutcome) -> BatchOutcome:
    """Between turns: the changes so far, written down, so that plans do not grow with the turns."""

    def down(delta: Delta) -> Delta:
        return Delta(settle(delta.gone), settle(delta.added))

    names = list(outcome.deltas)
    written = [*outcome.deltas.values()] + ([] if outcome.lines is None else [outcome.lines])
    done = together(outcome.rejected.sparkSession, [partial(down, delta) for delta in written])
    lines = None if outcome.lines is None else done[-1]
    taken = None if outcome.taken is None else settle(outcome.taken)
    return BatchOutcome(dict(zip(names, done)), lines, settle(outcome.rejected), taken)


def apply_batch(
    tables: Tables,
    frags: Frags,
    changes: DataFrame,
    rule: Rule,
    on_reject: str = QUARANTINE,
    hot_rows: int = HOT_ROWS,
) -> tuple[Tables, Frags, DataFrame]:
    """Global tables, fragments and refused changes after a feed; see ``decide_batch``."""
    outcome = decide_batch(tables, frags, changes, rule, on_reject, hot_rows)
    lines = _global_after(tables["lignes_commandes"], outcome.lines)
    return {**tables, "lignes_commandes": lines}, apply_deltas(frags, outcome.deltas), outcome.rejected


def replicate_parents(frags: Frags, tables: Tables, keys: dict[str, DataFrame]) -> Frags:
    """Copy the given parent rows (table → DataFrame of ids) to every site that lacks them."""
    on_all = F.explode(F.array(*[F.lit(site) for site in SITES]))
    new = dict(frags)
    for table, ids in keys.items():
        key = S.KEYS[table]
        wanted = ids.select(key).distinct().withColumn("site", on_all)
        new[table] = frags[table].unionByName(_pulled(tables[table], frags[table], wanted, key))
    return new


def purge(tables: Tables | Frags, predicates: dict[str, Column]) -> Tables | Frags:
    """Delete the rows each predicate selects. A row whose predicate is unknown stays."""
    return {
        name: df.where(~_holds(predicates[name])) if name in predicates else df for name, df in tables.items()
    }
