"""From a feed of row changes on the line table to actions at the sites.

A change carries the row before and after. ``kind`` is what it means for the sites:
I insert at ``site_to``, D delete at ``site_from``, U update in place (both are the
same site), M move from one site to the other, N nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitewise.operators.routing import with_category
from sitewise.rules import NOWHERE, ByQuery, Rule

_VALUES = ("id_produit", "quantite", "remise")


def changed(column: str) -> Column:
    return ~F.col(f"old_{column}").eqNullSafe(F.col(f"new_{column}"))


def fires(rule: Rule) -> Column:
    """Whether a change can touch a site: an update must alter product, quantity or discount,
    and the rule's quantity guard must hold for the row before or after. Never NULL."""
    altered = changed("id_produit") | changed("quantite") | changed("remise")
    old = F.when(F.col("op") != "I", F.col("old_quantite"))
    new = F.when(F.col("op") != "D", F.col("new_quantite"))
    return ((F.col("op") != "U") | altered) & rule.fires(old, new)


def guard(changes: DataFrame, rule: Rule) -> DataFrame:
    return changes.where(fires(rule))


def sited(changes: DataFrame, products: DataFrame, rule: Rule) -> DataFrame:
    """Adds ``old_site`` and ``new_site``, 0 for none. The category is the product's
    present one, also for the row before the change."""
    if isinstance(rule, ByQuery):
        named = products.where(F.col("id_categorie").isin(rule.categories))
        # The side that a change lacks looks up the other side's product; its site is fixed
        # below anyway, and no crowd of NULL keys meets in one partition.
        op = F.col("op")
        changes = changes.withColumn(
            "_old", F.when(op == "I", F.col("new_id_produit")).otherwise(F.col("old_id_produit"))
        ).withColumn("_new", F.when(op == "D", F.col("old_id_produit")).otherwise(F.col("new_id_produit")))
        changes = with_category(changes, named, "_old", "_old_category")
        changes = with_category(changes, named, "_new", "_new_category")
        old_category, new_category = F.col("_old_category"), F.col("_new_category")
    else:
        old_category = new_category = None
    old = F.when(F.col("op") == "I", F.lit(NOWHERE)).otherwise(rule.site(F.col("old_quantite"), old_category))
    new = (
        F.when(F.col("op") == "D", F.lit(NOWHERE))
        .when(F.col("op") == "I", rule.site(F.col("new_quantite"), new_category))
        .otherwise(rule.next_site(F.col("old_site"), F.col("new_quantite"), new_category))
    )
    return changes.withColumn("old_site", old).withColumn("new_site", new).drop(
        "_old", "_new", "_old_category", "_new_category"
    )


def classify(changes: DataFrame, products: DataFrame, rule: Rule, keep_all: bool = False) -> DataFrame:
    """Changes with their sites and ``kind``. Those that the guard stops are left out
    before any join, or, with ``keep_all``, kept as kind N."""
    if not keep_all:
        changes = guard(changes, rule)
    old, new = F.col("old_site"), F.col("new_site")
    kind = (
        F.when(~fires(rule) | ((old == NOWHERE) & (new == NOWHERE)), "N")
        .when(old == NOWHERE, "I")
        .when(new == NOWHERE, "D")
        .when(old == new, "U")
        .otherwise("M")
    )
    return sited(changes, products, rule).withColumn("kind", kind)


def to_actions(classified: DataFrame) -> DataFrame:
    """One row per site action; a move gives a delete and an insert, in that order."""
    delete = F.struct(
        F.lit(1).alias("step"),
        F.lit("DELETE").alias("action"),
        F.col("old_site").alias("site"),
        F.col("old_id_produit").alias("id_produit"),
        F.col("old_quantite").alias("quantite"),
        F.col("old_remise").alias("remise"),
    )

    def write(step: int, action: str) -> Column:
        return F.struct(
            F.lit(step).alias("step"),
            F.lit(action).alias("action"),
            F.col("new_site").alias("site"),
            *[F.col(f"new_{c}").alias(c) for c in _VALUES],
        )

    kind = F.col("kind")
    steps = (
        F.when(kind == "I", F.array(write(1, "INSERT")))
        .when(kind == "D", F.array(delete))
        .when(kind == "U", F.array(write(1, "UPDATE")))
        .when(kind == "M", F.array(delete, write(2, "INSERT")))
    )
    return (
        classified.where(kind != "N")
        .withColumn("_step", F.explode(steps))
        .select("seq", "id_ligne_commande", "id_commande", "_step.*")
    )


def route_changes(changes: DataFrame, products: DataFrame, rule: Rule) -> DataFrame:
    """Site actions (seq, line, order, step, action, site, values) of a feed."""
    return to_actions(classify(changes, products, rule))


def transition_summary(changes: DataFrame, products: DataFrame, rule: Rule) -> DataFrame:
    """Number of updates per (old site, new site)."""
    updates = classify(changes.where(F.col("op") == "U"), products, rule)
    return updates.groupBy("old_site", "new_site").agg(F.count(F.lit(1)).alias("nb"))


def compact(changes: DataFrame) -> DataFrame:
    """Several changes to one line folded into one: the row before the first, after the last.

    Exact where none of the folded changes is rejected on its own. A line both
    inserted and deleted leaves no change.
    """
    before = F.struct("op", *[f"old_{c}" for c in _VALUES])
    after = F.struct("op", "id_commande", *[f"new_{c}" for c in _VALUES])
    folded = changes.groupBy("id_ligne_commande").agg(
        F.max("seq").alias("seq"),
        F.min_by(before, "seq").alias("first"),
        F.max_by(after, "seq").alias("last"),
    )
    was, ends = F.col("first.op") != "I", F.col("last.op") != "D"
    op = F.when(was & ends, "U").when(ends, "I").when(was, "D")
    return folded.withColumn("op", op).where(F.col("op").isNotNull()).select(
        "seq",
        "op",
        "id_ligne_commande",
        F.col("last.id_commande").alias("id_commande"),
        *[F.col(f"first.old_{c}").alias(f"old_{c}") for c in _VALUES],
        *[F.col(f"last.new_{c}").alias(f"new_{c}") for c in _VALUES],
    )


def written_lines(accepted: DataFrame) -> DataFrame:
    """Line rows that inserts and updates write."""
    return accepted.where(F.col("op") != "D").select(
        "id_ligne_commande", "id_commande", *[F.col(f"new_{c}").alias(c) for c in _VALUES]
    )


def apply_changes_global(lines: DataFrame, accepted: DataFrame) -> DataFrame:
    """The global line table after the accepted changes."""
    replaced = accepted.where(F.col("op") != "I").select("id_ligne_commande")
    return lines.join(replaced, "id_ligne_commande", "left_anti").unionByName(written_lines(accepted))
