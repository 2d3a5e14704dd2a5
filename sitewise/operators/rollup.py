"""Revenue per category and year kept up with the sites: signed partial sums of what a version changed.

Parts hold, per site, category and year of the order, the exact sum of the lines' terms, how many
lines stand behind it and how many of them have a term. What a version takes out is taken back
with the values it had, what it puts in is added, so nothing is summed again that did not change.
A line counts while its site holds its order and its product, as in ``revenue_by_category``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.columns import units
from sitewise.functions.relations import sort_desc
from sitewise.operators.analytics import with_category_name
from sitewise.session import exists
from sitewise.sources.snapshots import Frags, changed_rows, last_version, read_version
from sitewise.sources.tables import Tables

RATE, ABSOLUTE = "rate", "absolute"
_KEYS = ("site", "id_categorie", "annee")
_SUMS = ("montant", "lignes", "termes")
_LINES = "lignes_commandes"
SCHEMA = "site int, id_categorie bigint, annee int, montant decimal(38,8), lignes bigint, termes bigint"


def revenue_parts(frags: Frags, tables: Tables, discount: str = RATE) -> DataFrame:
    """The parts of lines with their orders and products; ``absolute`` goes by the sites' own products."""
    lines, orders = frags[_LINES], frags["commandes"]
    quantity, off, price = F.col("quantite"), F.col("remise"), F.col("prix_unitaire")
    products = (frags if discount == ABSOLUTE else tables)["produits"]
    on = ["site", "id_produit"] if "site" in products.columns else ["id_produit"]
    dated = lines.select("site", "id_commande", "id_produit", "quantite", "remise").join(
        orders.select("site", "id_commande", F.year("date_commande").alias("annee")), ["site", "id_commande"]
    )
    # Per product first: its price is a factor of all its lines, and one sold very often is one row by then.
    whole = quantity.isNotNull() & off.isNotNull()
    net = units(quantity) * (F.lit(1).cast("decimal(1,0)") - off) if discount == RATE else units(quantity)
    sold = dated.groupBy("site", "id_produit", "annee").agg(
        F.sum(F.when(whole, net)).cast("decimal(22,4)").alias("sold"),
        F.sum(F.when(whole, off)).cast("decimal(24,4)").alias("off"),
        F.count(F.lit(1)).alias("lignes"),
        F.count_if(whole).alias("termes"),
    )
    priced = sold.join(products.select(*on, "id_categorie", "prix_unitaire"), on)
    term = F.col("sold") * price if discount == RATE else F.col("sold") * price - F.col("off")
    return _summed(
        priced.select(*_KEYS, term.cast("decimal(38,8)").alias("montant"), "lignes", F.when(price.isNotNull(), F.col("termes")).otherwise(F.lit(0)).alias("termes"))
    )


def _summed(parts: DataFrame) -> DataFrame:
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _SUMS]
    kept = parts.groupBy(*_KEYS).agg(*sums)
    return kept.select(*_KEYS, F.col("montant").cast("decimal(38,8)").alias("montant"), "lignes", "termes")


def merged(parts: DataFrame, moves: DataFrame) -> DataFrame:
    """Parts after signed moves; a part without lines is gone."""
    return _summed(parts.unionByName(moves)).where("lignes <> 0")


def _also(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(site, key) of the rows on both sides that differ in what a term depends on."""
    was, now = (df.select("site", key, F.struct(*columns).alias(name)) for df, name in ((old, "was"), (new, "now")))
    return was.join(now, ["site", key]).where(~F.col("was").eqNullSafe(F.col("now"))).select("site", key)


def revenue_moves(spark: SparkSession, root: str, earlier: int, later: int, tables: Tables, discount: str = RATE) -> DataFrame:
    """Signed parts between two versions of the sites: of the lines that changed, and of those whose
    order or product is there before and after but dated, priced or placed otherwise.

    It is taken that references hold at a site (``check_fk``): an order or product that came had no
    lines there before, and one that went has none after, so those lines are among the changed ones.
    """
    before, after = read_version(spark, root, earlier), read_version(spark, root, later)
    old, new = changed_rows(spark, root, _LINES, earlier, later)
    lines = [old, new]
    shifted = {"id_commande": _also(*changed_rows(spark, root, "commandes", earlier, later), "id_commande", ["date_commande"])}
    if discount == ABSOLUTE:
        moved = _also(*changed_rows(spark, root, "produits", earlier, later), "id_produit", ["id_categorie", "prix_unitaire"])
        shifted["id_produit"] = moved
    named = {key: keys for key, keys in shifted.items() if not keys.isEmpty()}
    if named:
        # Only then lines that did not change are looked up, by the orders and products that did.
        touched = old.select("site", "id_ligne_commande").unionByName(new.select("site", "id_ligne_commande")).distinct()
        more = []
        for frags in (before, after):
            found = None
            for key, keys in named.items():
                some = frags[_LINES].join(keys, ["site", key], "left_semi")
                found = some if found is None else found.unionByName(some).dropDuplicates(["site", "id_ligne_commande"])
            more.append(found.join(touched, ["site", "id_ligne_commande"], "left_anti"))
        lines = [own.unionByName(extra) for own, extra in zip(lines, more)]

    def own_parents(frags: Frags, some: DataFrame) -> Frags:
        """The orders and products that some lines name: what they meet is the size of the batch."""
        own = {_LINES: some}
        for table, key in (("commandes", "id_commande"), ("produits", "id_produit")):
            if table in frags:
                own[table] = frags[table].join(some.select("site", key).distinct(), ["site", key], "left_semi")
        return own

    gone = revenue_parts(own_parents(before, lines[0]), tables, discount)
    come = revenue_parts(own_parents(after, lines[1]), tables, discount)
    back = gone.select(*_KEYS, *[(-F.col(c)).cast(gone.schema[c].dataType).alias(c) for c in _SUMS])
    return _summed(come.unionByName(back))


def keep_revenue(spark: SparkSession, sites: str, home: str, tables: Tables, discount: str = RATE) -> DataFrame:
    """The parts as of the sites' last version, stored under ``home``: those of the last version kept
    there and the moves since; all lines are summed only the first time."""
    version = last_version(spark, sites)
    kept = [v for v in range(version, -1, -1) if exists(spark, f"{home}/v={v}/_SUCCESS")][:1]
    if kept != [version]:
        if kept:
            parts = merged(spark.read.schema(SCHEMA).parquet(f"{home}/v={kept[0]}"), revenue_moves(spark, sites, kept[0], version, tables, discount))
        else:
            parts = revenue_parts(read_version(spark, sites, version), tables, discount)
        parts.write.mode("overwrite").parquet(f"{home}/v={version}")
    return spark.read.schema(SCHEMA).parquet(f"{home}/v={version}")


def revenue_of(parts: DataFrame, categories: DataFrame, year: int, discount: str = RATE) -> DataFrame:
    """Revenue of a year per category over the sites, largest first: ``revenue_by_category`` from the parts."""
    total = parts.where(F.col("annee") == year).groupBy("id_categorie").agg(F.sum("montant").alias("montant"), F.sum("termes").alias("termes"))
    amount = F.when(F.col("termes") > 0, F.col("montant"))
    amount = F.round(amount, 2) if discount == RATE else amount.cast("decimal(38,4)")
    named = with_category_name(total.select("id_categorie", amount.alias("chiffre_affaires")), categories)
    return sort_desc(named.select("id_categorie", "nom_categorie", "chiffre_affaires"), "chiffre_affaires")
