"""Changes captured from two states of the line table: what users have who keep tables, not feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.relations import conform
from sitewise.schema import CHANGES
from sitewise.sources.keys import assign_surrogate_key
from sitewise.sources.snapshots import changed_rows

_LINE = "id_ligne_commande"
_VALUES = ("id_produit", "quantite", "remise")


def capture_changes(old: DataFrame, new: DataFrame, first_seq: int = 1) -> DataFrame:
    """The feed (``CHANGES``) that turns the lines ``old`` into ``new``, numbered from ``first_seq`` by line.

    Rows meet by line id; values are compared with NULL as a value like any other, so a value that
    becomes NULL, or stops being so, is an update. A line under another order is deleted under the old
    one and then inserted under the new. Lines without an id cannot be named by a change and say nothing.
    Ids must be unique on each side. An equal row gives no change, so equal tables give an empty feed.
    """

    def side(lines: DataFrame, name: str):
        columns = [F.struct("id_commande", *_VALUES).alias(name)]
        return lines.where(F.col(_LINE).isNotNull()).select(_LINE, *columns)

    met = side(old, "old").join(side(new, "new"), _LINE, "full")
    o, n = F.col("old"), F.col("new")
    met = met.where(~o.eqNullSafe(n))
    step = [F.lit(i).alias("step") for i in (0, 1)]
    nothing = F.lit(None).cast(met.schema["old"].dataType)

    def change(at: int, op: str, before, after):
        return F.struct(step[at], F.lit(op).alias("op"), before.alias("before"), after.alias("after"))

    steps = (
        F.when(o.isNull(), F.array(change(1, "I", nothing, n)))
        .when(n.isNull(), F.array(change(0, "D", o, nothing)))
        .when(o["id_commande"].eqNullSafe(n["id_commande"]), F.array(change(0, "U", o, n)))
        .otherwise(F.array(change(0, "D", o, nothing), change(1, "I", nothing, n)))
    )
    rows = met.select(_LINE, F.explode(steps).alias("c")).select(
        _LINE,
        F.col("c.step").alias("step"),
        F.col("c.op").alias("op"),
        F.coalesce("c.after.id_commande", "c.before.id_commande").alias("id_commande"),
        *[F.col(f"c.before.{v}").alias(f"old_{v}") for v in _VALUES],
        *[F.col(f"c.after.{v}").alias(f"new_{v}") for v in _VALUES],
    )
    return conform(assign_surrogate_key(rows, [], [_LINE, "step"], "seq", start=first_seq), CHANGES)


def capture_between(spark: SparkSession, root: str, earlier: int, later: int, first_seq: int = 1) -> DataFrame:
    """The feed between two stored versions of the line table under ``root``.

    Only the change folders of the versions in between say which lines changed and how they ended; how
    they stood before is looked up for those lines, within their range of ids.
    """
    old, new = changed_rows(spark, root, "lignes_commandes", earlier, later)
    return capture_changes(old, new, first_seq)
