"""Site fragments derived from the global tables, and back.

Parents follow their children bottom-up: lines, orders, clients and employees; products,
suppliers and categories. Each step reduces the children to one row per parent key
first, so a parent named by very many lines still arrives as one row per map task.
Nothing is shuffled by site or category alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.relations import anti
from sitewise.operators.routing import placed
from sitewise.rules import SITES, ByQuery, Rule
from sitewise.schema import KEYS, SCHEMAS
from sitewise.session import settle, together
from sitewise.sources.snapshots import Frags, commit_whole, write_table
from sitewise.sources.tables import Tables


def named_by(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents with each site on which a child names them.

    The children become one row per key, with a flag per site, so they are shuffled by
    the key alone and meet the parents without a second exchange.
    """
    on_sites = children.groupBy(key).agg(*[F.max(F.col("site") == s).alias(f"_on{s}") for s in SITES])
    sites = F.array_compact(F.array(*[F.when(F.col(f"_on{s}"), F.lit(s)) for s in SITES]))
    return parents.join(on_sites, key).select(*parents.columns, F.explode(sites).alias("site"))


def _replicated(rows: DataFrame, rule: ByQuery) -> DataFrame:
    """Rows of the rule's categories, on each site that holds the category."""
    return (
        rows.where(F.col("id_categorie").isin(rule.categories))
        .withColumn("site", F.explode(rule.sites_of_category(F.col("id_categorie"))))
        .select(*rows.columns, "site")
    )


def lines(tables: Tables, rule: Rule) -> DataFrame:
    sited = placed(tables["lignes_commandes"], tables["produits"], rule)
    if not isinstance(rule, ByQuery):
        return sited
    client_of = tables["commandes"].select("id_commande", "id_client")
    return sited.join(client_of, "id_commande").select(*SCHEMAS["lignes_commandes"].names, "id_client", "site")


def _line_parents(tables: Tables, rule: Rule, sited: DataFrame) -> Frags:
    """Orders by line. By query, products come by category, whether ordered or not; by
    volume, only those that a line names."""
    by_category = isinstance(rule, ByQuery)
    products = tables["produits"]
    return {
        "commandes": named_by(tables["commandes"], sited, "id_commande"),
        "produits": _replicated(products, rule) if by_category else named_by(products, sited, "id_produit"),
    }


def _upper_parents(tables: Tables, rule: Rule, orders: DataFrame, products: DataFrame) -> Frags:
    by_category = isinstance(rule, ByQuery)
    categories = tables["categories"]
    return {
        "fournisseurs": named_by(tables["fournisseurs"], products, "id_fournisseur"),
        "categories": _replicated(categories, rule) if by_category else named_by(categories, products, "id_categorie"),
        "employes": named_by(tables["employes"], orders, "id_employe"),
        "clients": named_by(tables["clients"], orders, "id_client"),
    }


def derive(tables: Tables, rule: Rule) -> Frags:
    """All seven tables of all sites, lazily."""
    # The parents need no more of a line than its keys; its client is joined only where it is read.
    sited = placed(tables["lignes_commandes"], tables["produits"], rule)
    middle = _line_parents(tables, rule, sited)
    upper = _upper_parents(tables, rule, middle["commandes"], middle["produits"])
    return {**upper, **middle, "lignes_commandes": lines(tables, rule)}


def load_sites(tables: Tables, rule: Rule, root: str, version: int = 0, wanted: Sequence[str] | None = None) -> Frags:
    """Derive all sites and store them, bottom-up: lines are placed once and stored, their
    parents are found from the stored lines, and those of the orders and products from
    the stored orders and products. ``wanted`` of the lines' parents are enough for some queries."""
    placing = tables
    if isinstance(rule, ByQuery):  # products of few categories: known to be small once stored, the lines then stay where they are
        few = tables["produits"].where(F.col("id_categorie").isin(rule.categories)).select("id_produit", "id_categorie")
        placing = {**tables, "produits": settle(few)}
    sited = write_table(lines(placing, rule), root, "lignes_commandes", version)

    def stored(parents: Frags) -> Frags:
        written = together(sited.sparkSession, [partial(write_table, df, root, name, version) for name, df in parents.items()])
        return dict(zip(parents, written))

    parents = _line_parents(tables, rule, sited)
    middle = stored({name: df for name, df in parents.items() if wanted is None or name in wanted})
    upper = {} if wanted is not None else stored(_upper_parents(tables, rule, middle["commandes"], middle["produits"]))
    frags = {**upper, **middle, "lignes_commandes": sited}
    commit_whole(frags, root, version)
    return frags


def missing_rows(frag: DataFrame, existing: DataFrame, table: str) -> DataFrame:
    """Derived rows that the site does not hold yet; makes a load re-runnable."""
    return anti(frag, existing, ["site", KEYS[table]])


def fragment(tables: Tables, rule: Rule, table: str, existing: Frags | None = None) -> DataFrame:
    """One table of all sites; with ``existing``, only what is not there yet."""
    derived = derive(tables, rule)[table]
    return derived if existing is None else missing_rows(derived, existing[table], table)


def load_missing(tables: Tables, rule: Rule, existing: Frags) -> Frags:
    """Existing fragments and the derived rows they lack."""
    derived = derive(tables, rule)
    return {name: existing[name].unionByName(missing_rows(derived[name], existing[name], name)) for name in derived}


def full_replica_load(tables: Tables, rule: ByQuery) -> Frags:
    """Every parent table whole on every site; lines by the rule, without their client."""
    on_all = F.explode(F.array(*[F.lit(site) for site in SITES]))
    frags = {
        name: tables[name].withColumn("site", on_all) for name in SCHEMAS if name != "lignes_commandes"
    }
    frags["lignes_commandes"] = placed(tables["lignes_commandes"], tables["produits"], rule)
    return frags


def union_sites(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts, duplicates kept."""
    united = parts[0]
    for df in parts[1:]:
        united = united.unionByName(df)
    return united


def reconstruct(parts: list[DataFrame]) -> DataFrame:
    """The global line set from each site's own stored lines."""
    return union_sites([part.select(*SCHEMAS["lignes_commandes"].names) for part in parts])


def reconstruction_gaps(rebuilt: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows that only one of the two holds, each as often as it is short there: ``lost`` rows are
    global and at no site, ``extra`` ones at a site and not global. No row: the sites are complete."""
    whole = lines.select(*SCHEMAS["lignes_commandes"].names)
    lost = whole.exceptAll(rebuilt).withColumn("gap", F.lit("lost"))
    return lost.unionByName(rebuilt.exceptAll(whole).withColumn("gap", F.lit("extra")))


def on_sites(parents: DataFrame, children: DataFrame, key: str) -> DataFrame:
    """Parents with a flag per site, ``on_site_1`` and ``on_site_2``: whether a child is there."""
    flags = [f"on_site_{s}" for s in SITES]
    found = children.groupBy(key).agg(*[F.max(F.col("site") == s).alias(f"on_site_{s}") for s in SITES])
    joined = parents.join(found, key, "left")
    return joined.select(*parents.columns, *[F.coalesce(f, F.lit(False)).alias(f) for f in flags])
