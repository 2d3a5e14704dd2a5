"""The seven global tables: from Parquet in their own schema, or from the test tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise.functions.prefix import row_numbers
from sitewise.functions.relations import conform, lookup
from sitewise.schema import PRICE, RATE, SCHEMAS
from sitewise.session import settle, together

Tables = dict[str, DataFrame]


def load_global(spark: SparkSession, root: str) -> Tables:
    """The seven tables from ``root/<table>``, schema declared and never inferred."""
    return {name: spark.read.schema(schema).parquet(f"{root}/{name}") for name, schema in SCHEMAS.items()}


def save_global(tables: Tables, root: str) -> None:
    together(
        tables["lignes_commandes"].sparkSession,
        [
            partial(conform(tables[name], schema).write.mode("overwrite").parquet, f"{root}/{name}")
            for name, schema in SCHEMAS.items()
        ],
    )


# Schemas of the test tables that have a counterpart in the order store.
_RAW: dict[str, str] = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}

# Order of the lines within an order; it ranks fully up to rows that are equal throughout.
_LINE_ORDER = [
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_shipdate",
    "l_returnflag",
    "l_linestatus",
]


def raw(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(_RAW[table]).parquet(f"{sf_dir}/{table}.parquet")


LINES_PER_ORDER = 1000


def numbered_lines(spark: SparkSession, sf_dir: str, order: Sequence[str] = _LINE_ORDER) -> DataFrame:
    """Test lines with the derived line id, which numbers the lines within their order.

    Ids of two orders would meet from ``LINES_PER_ORDER`` lines an order on: that fails, so a
    window over an order never has many rows to go through.
    """
    numbered = row_numbers(raw(spark, sf_dir, "lineitem"), ["l_orderkey"], order, "rn", known_small=True)
    too_many = F.raise_error(F.concat(F.lit("too many lines for their ids in order "), F.col("l_orderkey").cast("string"))).cast("bigint")
    place = F.when(F.col("rn") < LINES_PER_ORDER, F.col("rn")).otherwise(too_many)
    return numbered.withColumn("id_ligne_commande", (F.col("l_orderkey") + 1) * LINES_PER_ORDER + place).drop("rn")


# What the line table, the orders, the feeds and the calls are made of.
_NUMBERED = ["id_ligne_commande", "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_shipdate"]


def stored_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``numbered_lines``, stored: for queries that go over the lines more than once. The lines of an order lie together.

    What the order ends with and is not stored need not be dealt out: rows that only differ there are the same rows here.
    """
    last = max(k for k, name in enumerate(_LINE_ORDER) if name in _NUMBERED)
    return settle(numbered_lines(spark, sf_dir, _LINE_ORDER[: last + 1]).select(*_NUMBERED), dense=True)


def as_lines(numbered: DataFrame) -> DataFrame:
    return numbered.select(
        "id_ligne_commande",
        F.col("l_orderkey").alias("id_commande"),
        F.col("l_partkey").alias("id_produit"),
        F.col("l_quantity").cast("bigint").alias("quantite"),
        F.col("l_discount").cast(RATE).alias("remise"),
    )


def load_test_tables(spark: SparkSession, sf_dir: str, numbered: DataFrame | None = None) -> Tables:
    """The seven tables as views over the test tables. Nothing is read until a query needs it. Lines that are stored
    already come as ``numbered``."""
    lineitem = raw(spark, sf_dir, "lineitem")
    dated = lineitem if numbered is None else numbered
    numbered = numbered_lines(spark, sf_dir) if numbered is None else numbered
    part = raw(spark, sf_dir, "part")
    orders = raw(spark, sf_dir, "orders")

    employee = F.substring("o_orderpriority", 1, 1).cast("bigint")
    supplier_of = lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.min("l_suppkey").alias("s_suppkey"))
    delivered = dated.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("shipped"))

    sources = {
        "fournisseurs": raw(spark, sf_dir, "supplier").select(
            F.col("s_suppkey").alias("id_fournisseur"), F.col("s_name").alias("societe_fournisseur")
        ),
        "categories": part.select("p_size").distinct().select(
            F.col("p_size").cast("bigint").alias("id_categorie"),
            F.concat(F.lit("CAT-"), F.col("p_size").cast("string")).alias("nom_categorie"),
        ),
        "employes": orders.select("o_orderpriority").distinct().select(
            employee.alias("id_employe"), F.col("o_orderpriority").alias("nom")
        ),
        "clients": raw(spark, sf_dir, "customer").select(
            F.col("c_custkey").alias("id_client"),
            F.col("c_name").alias("societe"),
            F.col("c_name").alias("contact"),
            F.col("c_mktsegment").alias("fonction"),
            F.col("c_nationkey").cast("string").alias("pays"),
        ),
        "produits": lookup(part, supplier_of, "p_partkey", ["s_suppkey"]).select(
            F.col("p_partkey").alias("id_produit"),
            F.col("p_name").alias("designation"),
            F.col("s_suppkey").alias("id_fournisseur"),
            F.col("p_size").cast("bigint").alias("id_categorie"),
            F.col("p_retailprice").cast(PRICE).alias("prix_unitaire"),
            F.lit(0).alias("indisponible"),
        ),
        "commandes": lookup(orders, delivered, "o_orderkey", ["shipped"]).select(
            F.col("o_orderkey").alias("id_commande"),
            employee.alias("id_employe"),
            F.col("o_custkey").alias("id_client"),
            F.col("o_orderdate").alias("date_commande"),
            F.col("shipped").alias("date_livraison"),
        ),
        "lignes_commandes": as_lines(numbered),
    }
    return {name: conform(sources[name], SCHEMAS[name]) for name in SCHEMAS}


def store_tables(tables: Tables) -> Tables:
    """The tables with those that a join or a grouping derives written down, once for all jobs that read them."""
    names = ["commandes", "produits", "categories", "employes"]
    written = together(tables["commandes"].sparkSession, [partial(settle, tables[name], dense=name == "commandes") for name in names])
    return {**tables, **dict(zip(names, written))}
