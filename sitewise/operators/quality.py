"""Constraint checks, rejection report, placement audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.operators.fragments import union_sites
from sitewise.operators.routing import placed
from sitewise.rules import NOWHERE, Rule
from sitewise.schema import DEFAULT_LENGTH, KEYS, LENGTHS, NOT_NULL, SCHEMAS, references_of
from sitewise.sources.snapshots import Frags
from sitewise.sources.tables import Tables


def _domain_rules(table: str, columns: list[str]) -> dict[str, Column]:
    """Rule name → condition that must not be false. An unknown condition passes."""
    rules: dict[str, Column] = {}
    for column in NOT_NULL.get(table, []):
        rules[f"{column} not null"] = F.col(column).isNotNull()
    for field in SCHEMAS[table].fields:
        longest = LENGTHS.get((table, field.name), DEFAULT_LENGTH)
        if isinstance(field.dataType, T.StringType) and longest is not None and field.name in columns:
            rules[f"{field.name} length"] = F.length(field.name) <= longest
    if table == "produits":
        rules["indisponible flag"] = F.col("indisponible").isin(0, 1)
    if table == "commandes":
        rules["livraison not before commande"] = F.col("date_livraison") >= F.col("date_commande")
    return rules


def check_domain(tables: Tables) -> DataFrame:
    """Violations per table and rule, all rules of a table in one pass; rules that hold count 0."""
    reports = []
    for name, df in tables.items():
        rules = _domain_rules(name, df.columns)
        if not rules:
            continue
        broken = df.agg(*[F.count_if(~F.coalesce(ok, F.lit(True))).alias(rule) for rule, ok in rules.items()])
        counts = F.create_map(*[x for rule in rules for x in (F.lit(rule), F.col(f"`{rule}`"))])
        reports.append(
            broken.select(F.lit(name).alias("tbl"), F.explode(counts).alias("rule", "violations"))
        )
    return union_sites(reports)


def check_pk(tables: Tables, per_site: bool = False) -> DataFrame:
    """Per table, keys held by several rows and rows without a key."""
    reports = []
    for name, df in tables.items():
        key = [KEYS[name]]
        on = ["site", *key] if per_site else key
        sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("n"))
        missing = F.col(key[0]).isNull()
        reports.append(
            sizes.agg(
                F.count_if(~missing & (F.col("n") > 1)).alias("repeated_keys"),
                F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("missing_keys"),
            ).select(F.lit(name).alias("tbl"), "repeated_keys", "missing_keys")
        )
    return union_sites(reports)


def check_fk(tables: Tables, per_site: bool = False) -> DataFrame:
    """Per reference, child rows whose parent is not there. A missing reference is legal.

    All references go through one grouping and one join: a child is read once, whatever it refers to, and
    a key named by very many rows is one row before the join.
    """
    references = references_of(tables)
    site = ["site"] if per_site else []
    on = [*site, "_reference", "_key"]

    def named(child: str) -> DataFrame:
        own = [F.struct(F.lit(i).alias("_reference"), F.col(column).alias("_key")) for i, (c, column, _) in enumerate(references) if c == child]
        return tables[child].select(*site, F.explode(F.array(*own)).alias("_r")).select(*site, "_r.*").where(F.col("_key").isNotNull())

    children = union_sites([named(child) for child in dict.fromkeys(c for c, _, _ in references)])
    parents = union_sites(
        [tables[parent].select(*site, F.lit(i).alias("_reference"), F.col(KEYS[parent]).alias("_key")) for i, (_, _, parent) in enumerate(references)]
    )
    orphans = children.groupBy(*on).agg(F.count(F.lit(1)).alias("n")).join(parents, on, "left_anti")
    total = orphans.agg(*[F.coalesce(F.sum(F.when(F.col("_reference") == i, F.col("n"))), F.lit(0)).alias(f"n{i}") for i in range(len(references))])
    reports = [
        F.struct(F.lit(child).alias("child"), F.lit(column).alias("reference"), F.lit(parent).alias("parent"), F.col(f"n{i}").alias("orphans"))
        for i, (child, column, parent) in enumerate(references)
    ]
    return total.select(F.explode(F.array(*reports)).alias("r")).select("r.*")


def rejections(rejected: DataFrame) -> DataFrame:
    """Refused changes per code and kind."""
    return rejected.groupBy("error_code", "kind").agg(F.count(F.lit(1)).alias("nb"))


def audit(tables: Tables, frags: Frags, rule: Rule) -> DataFrame:
    """Lines that are not where the rule puts them: ``actual`` and ``expected`` site, 0 for none."""
    key = "id_ligne_commande"
    expected = placed(tables["lignes_commandes"], tables["produits"], rule).select(key, F.col("site").alias("expected"))
    actual = frags["lignes_commandes"].select(key, F.col("site").alias("actual"))
    none = F.lit(NOWHERE)
    both = expected.join(actual, key, "full_outer").select(
        key, F.coalesce("expected", none).alias("expected"), F.coalesce("actual", none).alias("actual")
    )
    return both.where(F.col("expected") != F.col("actual"))


def site_counts(frags: Frags) -> DataFrame:
    """Rows per table and site."""
    return union_sites(
        [
            df.groupBy("site").agg(F.count(F.lit(1)).alias("nb")).select(F.lit(name).alias("tbl"), "site", "nb")
            for name, df in frags.items()
        ]
    )
