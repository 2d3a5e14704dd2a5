"""Every operator as a query over the test tables: name → callable(spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitewise import schema as S
from sitewise.functions import columns as C
from sitewise.functions import relations as R
from sitewise.operators import analytics as A
from sitewise.operators import capture as CP
from sitewise.operators import changes as CH
from sitewise.operators import fragments as FR
from sitewise.operators import maintain as M
from sitewise.operators import purge as PU
from sitewise.operators import quality as Q
from sitewise.operators import recategorize as RC
from sitewise.operators import rollup as RU
from sitewise.operators.routing import route
from sitewise.plans import feed as FD
from sitewise.rules import SITES, STRICT, by_query, by_volume
from sitewise.session import settle, workdir
from sitewise.sources import ingest, layout, snapshots
from sitewise.sources.keys import assign_surrogate_key
from sitewise.sources.scripts import load_script
from sitewise.sources.sequences import number_load
from sitewise.sources.snapshots import Frags
from sitewise.sources.tables import Tables, as_lines, load_global, load_test_tables, numbered_lines, raw, save_global, stored_lines
from sitewise.streaming import feed as ST
from sitewise.streaming import ordered as OR

Query = Callable[[SparkSession, str], DataFrame]

# The rules with their thresholds scaled to the quantities of the test data (1 to 50).
BY_QUERY = by_query(50, 40, 35, 20)
BY_VOLUME = by_volume(40)
YEAR = 1998

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _add(name: str, function: Query) -> None:
    QUERIES[name] = function


_LINE = "id_ligne_commande"


def _double(column: str) -> Column:
    return F.col(column).cast("double").alias(column)


def _int(column: str) -> Column:
    return F.col(column).cast("int").alias(column)


def _line_columns(*more: str) -> list[Column | str]:
    return [_LINE, "id_commande", "id_produit", "quantite", _double("remise"), *more]


def _loaded(spark: SparkSession, tables: Tables, rule) -> Frags:
    """All sites, derived once and stored."""
    return FR.load_sites(tables, rule, workdir(spark, "sites"))


def _digest(frags: Frags, rejected: DataFrame | None = None) -> DataFrame:
    """All rows of all tables and sites in one shape, and the refused changes."""
    none = F.lit(0).cast("bigint")
    parts = []
    for name, df in frags.items():
        is_line = name == "lignes_commandes"
        client = F.coalesce("id_client", none) if is_line and "id_client" in df.columns else none
        parts.append(
            df.select(
                F.lit(name).alias("tbl"),
                _int("site") if "site" in df.columns else F.lit(0).alias("site"),
                F.col(S.KEYS[name]).alias("id"),
                (F.col("id_produit") if is_line else none).alias("id_produit"),
                (F.col("quantite") if is_line else none).alias("quantite"),
                (F.col("remise").cast("double") if is_line else F.lit(0.0)).alias("remise"),
                client.alias("id_client"),
            )
        )
    if rejected is not None:
        parts.append(
            rejected.select(
                F.lit("rejected").alias("tbl"),
                _int("site"),
                F.col("seq").alias("id"),
                none.alias("id_produit"),
                F.col("error_code").cast("bigint").alias("quantite"),
                F.lit(0.0).alias("remise"),
                none.alias("id_client"),
            )
        )
    return FR.union_sites(parts)


# ---------------------------------------------------------------- sources and sinks


@query
def load_global_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seven tables written once in their own schema, read back with it."""
    root = workdir(spark, "global")
    save_global(load_test_tables(spark, sf_dir), root)
    t = load_global(spark, root)
    zero = F.lit(0).cast("bigint")
    shape = {
        "fournisseurs": ("id_fournisseur", zero, zero, F.col("societe_fournisseur"), F.lit(0.0)),
        "categories": ("id_categorie", zero, zero, F.col("nom_categorie"), F.lit(0.0)),
        "employes": ("id_employe", zero, zero, F.col("nom"), F.lit(0.0)),
        "clients": ("id_client", zero, zero, F.concat_ws("/", "societe", "fonction", "pays"), F.lit(0.0)),
        "produits": (
            "id_produit",
            F.coalesce("id_fournisseur", zero),
            F.col("id_categorie"),
            F.col("designation"),
            F.col("prix_unitaire").cast("double"),
        ),
        "commandes": (
            "id_commande",
            F.col("id_employe"),
            F.col("id_client"),
            F.concat_ws("/", *[F.date_format(c, "yyyy-MM-dd") for c in ("date_commande", "date_livraison")]),
            F.lit(0.0),
        ),
        "lignes_commandes": (
            _LINE,
            F.col("id_commande"),
            F.col("id_produit"),
            F.col("quantite").cast("string"),
            F.col("remise").cast("double"),
        ),
    }
    return FR.union_sites(
        [
            t[name].select(
                F.lit(name).alias("tbl"),
                F.col(key).alias("id"),
                ref1.alias("ref1"),
                ref2.alias("ref2"),
                text.alias("txt"),
                amount.alias("amount"),
            )
            for name, (key, ref1, ref2, text, amount) in shape.items()
        ]
    )


QUERIES["load_global"] = QUERIES.pop("load_global_")


@query
def seed_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text, dates day first; some carry a day that does not exist, a blank or a word."""
    orders = raw(spark, sf_dir, "orders")
    priority = F.col("o_orderpriority")
    text = orders.select(
        F.col("o_orderkey").cast("string").alias("id_commande"),
        F.when(priority == "3-MEDIUM", "").otherwise(F.substring(priority, 1, 1)).alias("id_employe"),
        F.when(priority == "2-HIGH", "n/a").otherwise(F.col("o_custkey").cast("string")).alias("id_client"),
        F.when(priority == "5-LOW", F.concat(F.lit("31/02/"), F.year("o_orderdate").cast("string")))
        .otherwise(F.date_format("o_orderdate", "dd/MM/yyyy"))
        .alias("date_commande"),
        F.format_string("%.1f", F.floor(F.col("o_totalprice") / 1000) + 0.5).alias("frais_port"),
    )
    good, bad = ingest.seed_ingest(text, S.SCHEMAS["commandes"])
    nothing = F.lit(-1).cast("bigint")
    return good.select(
        "id_commande",
        F.coalesce("id_employe", nothing).alias("id_employe"),
        "id_client",
        F.date_format("date_commande", "yyyy-MM-dd").alias("date_commande"),
        F.col("frais_port").cast("bigint").alias("frais_port"),
        F.lit("").alias("bad_columns"),
    ).unionByName(
        bad.select(
            F.col("id_commande").cast("bigint").alias("id_commande"),
            nothing.alias("id_employe"),
            nothing.alias("id_client"),
            "date_commande",
            nothing.alias("frais_port"),
            "bad_columns",
        )
    )


@query
def assign_surrogate_key_(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered 1, 2, 3 … by date, then key."""
    orders = raw(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_surrogate_key(orders, [], ["o_orderdate", "o_orderkey"], "id").select("id", "o_orderkey")


QUERIES["assign_surrogate_key"] = QUERIES.pop("assign_surrogate_key_")


@query
def fragment_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = workdir(spark, "sites")
    FR.load_sites(load_test_tables(spark, sf_dir), BY_QUERY, root)
    return _digest(snapshots.read_version(spark, root))


@query
def fragment_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One site's tables under their local names."""
    root = workdir(spark, "sites")
    FR.load_sites(load_test_tables(spark, sf_dir), BY_VOLUME, root)
    return _digest(snapshots.fragment_read(spark, root, site=1, views=True))


@query
def full_replica_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _digest(FR.full_replica_load(load_test_tables(spark, sf_dir), BY_QUERY))


# ---------------------------------------------------------------- filters, projections, predicates


def _routed(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = load_test_tables(spark, sf_dir)
        return route(t["lignes_commandes"], t["produits"], rule).select(_LINE, _int("site"))

    return run


_add("route_by_query", _routed(BY_QUERY))
_add("route_by_volume", _routed(BY_VOLUME))


def _dated(test) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        orders = load_test_tables(spark, sf_dir)["commandes"]
        return orders.where(test(F.col("date_commande"), YEAR)).select("id_commande", "id_client", "date_commande")

    return run


_add("filter_year_extract", _dated(C.year_extract))
_add("filter_date_range", _dated(C.year_range))


@query
def filter_in_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = load_test_tables(spark, sf_dir)["produits"]
    chosen = A.purge_predicate({"id_categorie": [50, 35], "id_fournisseur": 7})
    return products.where(chosen).select("id_produit", "id_categorie", "id_fournisseur")


@query
def project_tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_test_tables(spark, sf_dir)
    lines = FR.lines(t, BY_VOLUME)
    cols = [_LINE, "id_produit", "quantite"]
    by_site = F.concat(F.lit("SITE_"), F.col("site").cast("string"))
    return FR.union_sites([R.tagged(t["lignes_commandes"], "GLOBAL", cols), R.tagged(lines, by_site, cols)])


@query
def guard_changed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    fired = CH.guard(FD.change_feed(spark, sf_dir), BY_QUERY)
    return fired.select("seq", "op", _LINE)


# ---------------------------------------------------------------- joins


@query
def join_line_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_test_tables(spark, sf_dir)
    joined = A.line_product(t["lignes_commandes"], t["produits"])
    return joined.select(_LINE, "id_produit", "id_categorie", _double("prix_unitaire"))


@query
def join_line_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_test_tables(spark, sf_dir)
    return A.line_order(t["lignes_commandes"], t["commandes"]).select(_LINE, "id_client", "date_commande")


@query
def join_order_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_test_tables(spark, sf_dir)
    return A.order_client(t["commandes"], t["clients"]).select("id_commande", "id_client", "societe")


@query
def join_category_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces sold per category, with its name."""
    t = load_test_tables(spark, sf_dir)
    # Per product first: a product sold very often meets the join as one row.
    sold = t["lignes_commandes"].groupBy("id_produit").agg(F.sum("quantite").alias("pieces"))
    totals = A.line_product(sold, t["produits"]).groupBy("id_categorie").agg(F.sum("pieces").alias("pieces"))
    return A.with_category_name(totals, t["categories"]).select("id_categorie", "nom_categorie", "pieces")


@query
def line_detail_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = load_test_tables(spark, sf_dir)
    detail = A.line_detail(t["lignes_commandes"], t["produits"], t["commandes"], YEAR)
    return detail.select(
        *_line_columns("id_employe", "id_client", "date_commande", "date_livraison"),
        "designation",
        F.coalesce("id_fournisseur", F.lit(0)).alias("id_fournisseur"),
        "id_categorie",
        _double("prix_unitaire"),
        _int("indisponible"),
    )


@query
def semi_join_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients with an order that has a line on a category-50 product above the quantity."""
    t = load_test_tables(spark, sf_dir)
    products = t["produits"].where(F.col("id_categorie") == 50)
    lines = R.semi(t["lignes_commandes"].where(F.col("quantite") > 40), products, "id_produit")
    orders = R.semi(t["commandes"], lines, "id_commande")
    return R.semi(t["clients"], orders, "id_client").select("id_client", "societe")


@query
def anti_join_not_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a second load adds after the line table has grown."""
    after = load_test_tables(spark, sf_dir)
    existing = _loaded(spark, FD.tables_before(spark, sf_dir), BY_QUERY)
    derived = _loaded(spark, after, BY_QUERY)
    return _digest({name: FR.missing_rows(derived[name], existing[name], name) for name in derived})


@query
def lookup_or_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Category of the product of a line; a line on no listed product gets none (-1)."""
    t = load_test_tables(spark, sf_dir)
    listed = t["produits"].where(F.col("prix_unitaire") < 1000)
    found = R.lookup(t["lignes_commandes"], listed, "id_produit", ["id_categorie"])
    return found.select(_LINE, F.coalesce("id_categorie", F.lit(-1)).alias("id_categorie"))


# ---------------------------------------------------------------- fragment derivation

def _fragment_columns(table: str) -> list[Column | str]:
    return {
        "lignes_commandes": _line_columns(),
        "commandes": ["id_commande", "id_employe", "id_client", "date_commande", "date_livraison"],
        "clients": ["id_client", "societe", "fonction", "pays"],
        "employes": ["id_employe", "nom"],
        "produits": [
            "id_produit",
            "designation",
            F.coalesce("id_fournisseur", F.lit(0)).alias("id_fournisseur"),
            "id_categorie",
            _double("prix_unitaire"),
        ],
        "fournisseurs": ["id_fournisseur", "societe_fournisseur"],
        "categories": ["id_categorie", "nom_categorie"],
    }[table]


def _fragment(rule, table: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        derived = FR.fragment(load_test_tables(spark, sf_dir), rule, table)
        more = ["id_client"] if table == "lignes_commandes" and "id_client" in derived.columns else []
        return derived.select(*_fragment_columns(table), *more, _int("site"))

    return run


for _scenario, _rule in (("s1", BY_QUERY), ("s2", BY_VOLUME)):
    for _english, _table in (
        ("lines", "lignes_commandes"),
        ("orders", "commandes"),
        ("clients", "clients"),
        ("employees", "employes"),
        ("products", "produits"),
        ("suppliers", "fournisseurs"),
        ("categories", "categories"),
    ):
        _add(f"{_scenario}_fragment_{_english}", _fragment(_rule, _table))


@query
def dedupe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients of the employees, each pair once."""
    return R.dedupe(load_test_tables(spark, sf_dir)["commandes"].select("id_employe", "id_client"))


# ---------------------------------------------------------------- aggregates, sort, set operations


@query
def orders_per_client(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.orders_per_client(load_test_tables(spark, sf_dir), YEAR)


@query
def orders_per_client_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count with the year extracted from the date."""
    return A.orders_per_client(load_test_tables(spark, sf_dir), YEAR, extract=True)


@query
def orders_per_client_named(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.orders_per_client(load_test_tables(spark, sf_dir), YEAR, named=True)


def _revenue(rule, discount: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        t = load_test_tables(spark, sf_dir)
        # An absolute discount goes by the sites' own products.
        wanted = ["commandes", "produits"] if discount == "absolute" else ["commandes"]
        total = A.revenue_by_category(FR.load_sites(t, rule, workdir(spark, "sites"), wanted=wanted), t, YEAR, discount)
        return total.withColumn("chiffre_affaires", F.col("chiffre_affaires").cast("double"))

    return run


_add("revenue_by_category_abs", _revenue(BY_QUERY, "absolute"))
_add("revenue_by_category_rate", _revenue(BY_VOLUME, "rate"))


@query
def revenue_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Revenue after the feed in four batches, kept up with each of them."""
    numbered = stored_lines(spark, sf_dir)
    tables = FD.tables_before(spark, sf_dir, numbered)
    root = workdir(spark, "store")
    ST.begin(root, tables, BY_QUERY)
    parts = RU.keep_revenue(spark, f"{root}/sites", f"{root}/revenue", tables, RU.ABSOLUTE)
    changes = settle(FD.change_feed(spark, sf_dir, numbered))
    for k in range(4):
        batch = changes.where(F.pmod(F.xxhash64("id_commande"), F.lit(4)) == k)
        ST.apply_version(batch, root, tables, BY_QUERY, k)
        parts = RU.keep_revenue(spark, f"{root}/sites", f"{root}/revenue", tables, RU.ABSOLUTE)
    total = RU.revenue_of(parts, tables["categories"], YEAR, RU.ABSOLUTE)
    return total.withColumn("chiffre_affaires", F.col("chiffre_affaires").cast("double"))


@query
def sum_two_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces per product: per site, then over the sites."""
    sited = FR.lines(load_test_tables(spark, sf_dir), BY_VOLUME)
    return A.sum_two_level(sited, ["id_produit"], "quantite")


@query
def count_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every order, whether a line of it is on each site."""
    t = load_test_tables(spark, sf_dir)
    return FR.on_sites(t["commandes"].select("id_commande"), FR.lines(t, BY_VOLUME), "id_commande")


@query
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces per category, largest first."""
    return R.sort_desc(join_category_rollup(spark, sf_dir), "pieces")


@query
def union_all_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both sites' stored line tables, each read from its own files."""
    root = workdir(spark, "sites")
    t = load_test_tables(spark, sf_dir)
    lines = snapshots.write_table(FR.lines(t, BY_QUERY), root, "lignes_commandes")
    parts = [lines.where(F.col("site") == s) for s in SITES]
    return FR.union_sites([p.select(_LINE, "id_produit", "quantite", _double("remise")) for p in parts])


@query
def reconstruct_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The line table from the two sites' stored lines, each read from its own files."""
    return _rebuilt(spark, load_test_tables(spark, sf_dir), BY_VOLUME).select(*_line_columns())


def _rebuilt(spark: SparkSession, t: Tables, rule) -> DataFrame:
    lines = snapshots.write_table(FR.lines(t, rule), workdir(spark, "sites"), "lignes_commandes")
    return FR.reconstruct([lines.where(F.col("site") == s) for s in SITES])


@query
def reconstruction_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that the by-query sites do not give back: those that its rule sends nowhere."""
    t = load_test_tables(spark, sf_dir)
    gaps = FR.reconstruction_gaps(_rebuilt(spark, t, BY_QUERY), t["lignes_commandes"])
    return gaps.select(*_line_columns(), "gap")


def _literal(value: Column) -> Column:
    return F.coalesce(F.concat(F.lit("'"), F.replace(value, F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL"))


@query
def seed_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients and suppliers written as insert scripts and read back: texts with quotes, semicolons and line
    breaks, dates, keys of a sequence for the suppliers. Some clients have a value too few, or a day that does not exist."""
    root = workdir(spark, "scripts")
    nation = F.col("c_nationkey")
    day = F.when(nation == 4, F.lit("30/02/2020")).otherwise(F.concat(F.lpad((nation + 1).cast("string"), 2, "0"), F.lit("/03/2020")))
    fields = [
        F.col("c_custkey").cast("string"),
        _literal(F.col("c_name")),
        _literal(F.concat("c_name", F.lit("'s; desk\n(;"), F.col("c_custkey").cast("string"))),
        _literal(F.when(nation != 5, F.col("c_mktsegment"))),
        F.concat(F.lit("TO_DATE('"), day, F.lit("', 'DD/MM/YYYY')")),
        F.when(nation != 3, _literal(nation.cast("string"))),
    ]
    head = "INSERT INTO CLIENTS (ID_CLIENT, SOCIETE, CONTACT,\n  FONCTION, DATE_NAISSANCE, PAYS) VALUES ("
    clients = raw(spark, sf_dir, "customer").select(F.concat(F.lit(head), F.concat_ws(", ", *fields), F.lit(");")))
    clients.write.text(f"{root}/clients")
    named = F.concat(F.lit("Insert into shop.fournisseurs (ID_FOURNISSEUR,SOCIETE_FOURNISSEUR) VALUES (F_SEQ.NEXTVAL,"), _literal(F.col("s_name")), F.lit(");"))
    raw(spark, sf_dir, "supplier").orderBy("s_suppkey").select(named).write.text(f"{root}/suppliers")
    parts = []
    for table, folder, key, columns in (
        ("clients", "clients", "id_client", ("societe", "contact", "fonction", "pays")),
        ("fournisseurs", "suppliers", "id_fournisseur", ("societe_fournisseur",) * 2),
    ):
        rows, bad = load_script(spark, f"{root}/{folder}", table, S.SCHEMAS[table], f"{root}/sequences", folder)
        born = F.date_format("date_naissance", "yyyy-MM-dd") if table == "clients" else F.lit("-")
        texts = [F.coalesce(c, F.lit("-")) for c in columns]
        parts.append(rows.select(F.lit(table).alias("tbl"), F.col(key).alias("id"), F.concat_ws("|", *texts, born).alias("txt")))
        name = F.regexp_extract("statement", "(Customer#[0-9]+)'", 1)
        parts.append(bad.select(F.lit("refused").alias("tbl"), F.lit(0).cast("bigint").alias("id"), F.concat_ws("|", "reason", name).alias("txt")))
    return FR.union_sites(parts)


@query
def numbered_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients in two loads, and the first load again: keys go on after each load, and come again with it."""
    customers = raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    root = workdir(spark, "sequences")
    parts = []
    for run, load in enumerate(("even", "odd", "even"), 1):
        rows = customers.where(F.col("c_nationkey") % 2 == int(load == "odd")).select("c_custkey")
        keyed = number_load(rows, root, "clients", load, ["c_custkey"], "id_client")
        parts.append(keyed.select(F.lit(run).alias("run"), F.lit(load).alias("load"), "c_custkey", "id_client"))
    return FR.union_sites(parts)


# ---------------------------------------------------------------- scalar functions


@query
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All scalar functions over every line and its order, with a fixed clock."""
    t = load_test_tables(spark, sf_dir)
    now = F.lit(dt.datetime(2002, 1, 1)).cast("timestamp_ntz")
    price = F.col("prix_unitaire")
    products = t["produits"].select("id_produit", "prix_unitaire")
    joined = A.line_product(A.line_order(t["lignes_commandes"], t["commandes"]), products)
    day = F.date_format("date_commande", "dd/MM/yyyy")
    iso = F.date_format("date_commande", "yyyy-MM-dd")
    return joined.select(
        _LINE,
        C.parse_day(day).alias("parsed_day"),
        C.parse_day(iso, "yyyy-MM-dd").alias("parsed_iso"),
        F.year("date_commande").cast("bigint").alias("annee"),
        F.round(C.net_rate(F.col("quantite"), price, F.col("remise")), 2).cast("double").alias("net_rate"),
        C.net_absolute(F.col("quantite"), price, F.col("remise")).cast("double").alias("net_absolute"),
        C.nvl(F.when(F.col("quantite") > 25, F.col("quantite")), F.lit(-1)).alias("nvl_quantite"),
        F.datediff(now, F.col("date_commande")).cast("bigint").alias("age_days"),
        (F.col("date_commande") < now - F.expr("INTERVAL 365 DAYS")).alias("older_than_year"),
        F.concat(F.lit("FAILED: Ligne Commande ID "), F.col(_LINE).cast("string"), F.lit(" not found.")).alias("message"),
    )


# ---------------------------------------------------------------- change routing


def _actions(rule, *ops: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = FD.change_feed(spark, sf_dir).where(F.col("op").isin(*ops))
        products = load_test_tables(spark, sf_dir)["produits"]
        return _action_columns(CH.route_changes(feed, products, rule))

    return run


def _action_columns(actions: DataFrame) -> DataFrame:
    return actions.select(
        "seq", _int("step"), "action", _int("site"), _LINE, "id_commande", "id_produit", "quantite", _double("remise")
    )


def _both(function) -> Query:
    """The same query under both rules, told apart by ``rule``."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = [function(rule)(spark, sf_dir).withColumn("rule", F.lit(rule.name)) for rule in (BY_QUERY, BY_VOLUME)]
        return FR.union_sites(parts)

    return run


_add("route_inserts", _both(lambda rule: _actions(rule, "I")))
_add("route_deletes", _both(lambda rule: _actions(rule, "D")))


def _classified(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        feed = FD.change_feed(spark, sf_dir).where(F.col("op") == "U")
        products = load_test_tables(spark, sf_dir)["produits"]
        named = CH.classify(feed, products, rule)
        return named.select("seq", _int("old_site"), _int("new_site"), "kind")

    return run


_add("classify_transitions", _both(_classified))


def _summary(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        products = load_test_tables(spark, sf_dir)["produits"]
        counted = CH.transition_summary(FD.change_feed(spark, sf_dir), products, rule)
        return counted.select(_int("old_site"), _int("new_site"), "nb")

    return run


_add("transition_summary", _both(_summary))


@query
def compact_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = CH.compact(FD.later_changes(FD.change_feed(spark, sf_dir)))
    missing = F.lit(-1).cast("bigint")
    return folded.select(
        "seq",
        "op",
        _LINE,
        "id_commande",
        *[F.coalesce(c, missing).alias(c) for c in ("old_id_produit", "old_quantite", "new_id_produit", "new_quantite")],
        *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in ("old_remise", "new_remise")],
    )


@query
def tied_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that must be taken together in a feed that brings returned lines back under the client's next order."""
    numbered = stored_lines(spark, sf_dir)
    moved = settle(_moved(spark, sf_dir, numbered).select(_LINE, "id_commande"))
    return M.tied_orders(M.line_orders(moved, [_lines_before(numbered)]))


def _moved(spark: SparkSession, sf_dir: str, numbered: DataFrame) -> DataFrame:
    return FD.moved_changes(spark, sf_dir, settle(FD.change_feed(spark, sf_dir, numbered)), numbered)


def _lines_before(numbered: DataFrame) -> DataFrame:
    """The line table before the feed."""
    return R.conform(as_lines(numbered.where(F.col("l_linenumber") != FD.NEW)), S.SCHEMAS["lignes_commandes"])


def _captured(feed: DataFrame) -> DataFrame:
    missing = F.lit(-1).cast("bigint")
    return feed.select(
        "seq",
        "op",
        _LINE,
        "id_commande",
        *[F.coalesce(c, missing).alias(c) for c in ("old_id_produit", "old_quantite", "new_id_produit", "new_quantite")],
        *[F.coalesce(F.col(c).cast("double"), F.lit(-1.0)).alias(c) for c in ("old_remise", "new_remise")],
    )


@query
def capture_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed between the line table as it is before the moving feed and as it stands in the end."""
    numbered = stored_lines(spark, sf_dir)
    old = _lines_before(numbered)
    moved = settle(CH.compact(_moved(spark, sf_dir, numbered)))
    return _captured(CP.capture_changes(old, CH.apply_changes_global(old, moved)))


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Lines as of version 0 of a store, and what is captured between it and the version that the feed makes."""
    numbered = stored_lines(spark, sf_dir)
    tables = FD.tables_before(spark, sf_dir, numbered)
    root = workdir(spark, "store")
    ST.begin(root, tables, BY_QUERY)
    ST.apply_version(FD.change_feed(spark, sf_dir, numbered), root, tables, BY_QUERY, 0)
    old = ST.state(spark, root, tables, 0)[0]["lignes_commandes"]
    return old, CP.capture_between(spark, f"{root}/global", 0, 1)


@query
def capture_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _captured(_two_versions(spark, sf_dir)[1])


@query
def capture_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older version with what was captured applied: the newer version."""
    old, captured = _two_versions(spark, sf_dir)
    return CH.apply_changes_global(old, settle(captured)).select(*_line_columns())


# ---------------------------------------------------------------- fragment maintenance


def _before(spark: SparkSession, sf_dir: str, rule, numbered: DataFrame | None = None) -> tuple[Tables, Frags]:
    """Tables and fragments as they stand before the feed, the fragments stored."""
    tables = FD.tables_before(spark, sf_dir, numbered)
    return tables, FR.load_sites(tables, rule, workdir(spark, "sites"))


@query
def validate_line_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = load_test_tables(spark, sf_dir)["produits"]
    actions = CH.route_changes(FD.change_feed(spark, sf_dir), products, BY_VOLUME)
    checked = M.validate(actions)
    return checked.select("seq", _int("step"), "action", F.coalesce("error_code", F.lit(0)).alias("error_code"))


def _calls(spark: SparkSession, sf_dir: str, rule, numbered: DataFrame | None = None) -> DataFrame:
    """Test lines with their line number, their site under a rule and the line columns."""
    numbered = numbered_lines(spark, sf_dir) if numbered is None else numbered
    lines = numbered.select(
        _LINE,
        F.col("l_orderkey").alias("id_commande"),
        F.col("l_partkey").alias("id_produit"),
        F.col("l_quantity").cast("bigint").alias("quantite"),
        F.col("l_discount").cast(S.RATE).alias("remise"),
        F.col("l_linenumber").alias("number"),
        F.col("l_returnflag").alias("flag"),
    )
    return route(lines, load_test_tables(spark, sf_dir)["produits"], rule)


def insert_calls(spark: SparkSession, sf_dir: str, rule, numbered: DataFrame | None = None) -> DataFrame:
    """Inserts at the sites, by line number: 5 the new lines at their site (twice over),
    1 lines that are there already, 2 at the other site (site 1 where there is none),
    6 with a negative quantity."""
    lines = _calls(spark, sf_dir, rule, numbered)
    number = F.col("number")
    other = F.when(F.col("site") == 1, 2).otherwise(1)
    calls = (
        lines.where(number.isin(FD.NEW, FD.DELETED, FD.FLIPPED, FD.NEGATED))
        .withColumn("site", F.when(number == FD.FLIPPED, other).otherwise(F.col("site")))
        .withColumn("quantite", F.when(number == FD.NEGATED, -F.col("quantite")).otherwise(F.col("quantite")))
        .where(F.col("site") > 0)
    )
    again = calls.where(number == FD.NEW).withColumn("seq", F.col(_LINE) * 2 + 1)
    return (
        calls.withColumn("seq", F.col(_LINE) * 2)
        .unionByName(again)
        .select("seq", "site", _LINE, "id_commande", "id_produit", "quantite", "remise")
    )


def update_calls(spark: SparkSession, sf_dir: str, rule, numbered: DataFrame | None = None) -> DataFrame:
    """Updates at the sites, by line number: 2 another quantity, 3 another product (a returned
    line one that does not exist, else the smallest), 4 a negative discount, 1 at the
    other site, 6 nothing (all values kept)."""
    lines = _calls(spark, sf_dir, rule, numbered).where(F.col("site") > 0)
    number = F.col("number")
    none = F.lit(None)
    product = F.when(number == FD.MOVED, F.when(F.col("flag") == "R", F.col("id_produit") + 1_000_000_000).otherwise(F.lit(1)))
    return lines.where(number.isin(FD.DELETED, FD.FLIPPED, FD.MOVED, FD.DISCOUNTED, FD.NEGATED)).select(
        F.col(_LINE).alias("seq"),
        F.when(number == FD.DELETED, 3 - F.col("site")).otherwise(F.col("site")).alias("site"),
        _LINE,
        product.cast("bigint").alias("id_produit"),
        F.when(number == FD.FLIPPED, 51 - F.col("quantite")).otherwise(none).cast("bigint").alias("quantite"),
        F.when(number == FD.DISCOUNTED, -F.col("remise") - F.lit("0.01").cast(S.RATE))
        .otherwise(none)
        .cast(S.RATE)
        .alias("remise"),
    )


def delete_calls(spark: SparkSession, sf_dir: str, rule, numbered: DataFrame | None = None) -> DataFrame:
    """Deletes at the sites: line numbers 1 to 3 at their site, 4 at the other one."""
    lines = _calls(spark, sf_dir, rule, numbered).where(F.col("site") > 0)
    wrong = F.col("number") == FD.DISCOUNTED
    return lines.where(F.col("number") <= FD.DISCOUNTED).select(
        F.col(_LINE).alias("seq"),
        F.when(wrong, 3 - F.col("site")).otherwise(F.col("site")).alias("site"),
        _LINE,
    )


def _procedure(procedure, calls, rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        numbered = stored_lines(spark, sf_dir)
        tables, frags = _before(spark, sf_dir, rule, numbered)
        return _digest(*procedure(frags, tables, calls(spark, sf_dir, rule, numbered), rule.policy))

    return run


_add("insert_lines_hydrating", _procedure(M.insert_lines, insert_calls, BY_QUERY))
_add("insert_lines_strict", _procedure(M.insert_lines, insert_calls, BY_VOLUME))
_add("update_lines_hydrating", _procedure(M.update_lines, update_calls, BY_QUERY))
_add("update_lines_strict", _procedure(M.update_lines, update_calls, BY_VOLUME))
_add("delete_lines_cascade", _both(lambda rule: _procedure(M.delete_lines, delete_calls, rule)))


def _batch(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        numbered = stored_lines(spark, sf_dir)
        tables, frags = _before(spark, sf_dir, rule, numbered)
        _, after, rejected = M.apply_batch(tables, frags, FD.change_feed(spark, sf_dir, numbered), rule)
        return _digest(after, rejected)

    return run


_add("apply_change_batch_s1", _batch(BY_QUERY))
_add("replay_changes_s2", _batch(BY_VOLUME))


@query
def replicate_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and products of the new lines, copied to both sites ahead of the inserts."""
    tables, frags = _before(spark, sf_dir, BY_VOLUME)
    new = FD.change_feed(spark, sf_dir).where(F.col("op") == "I")
    keys = {
        "commandes": new.select("id_commande"),
        "produits": new.select(F.col("new_id_produit").alias("id_produit")),
    }
    return _digest(M.replicate_parents(frags, tables, keys))


@query
def purge_by_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines, orders and products named by key, off every site."""
    frags = _loaded(spark, load_test_tables(spark, sf_dir), BY_VOLUME)
    predicates = {
        "lignes_commandes": A.purge_predicate({"id_commande": 7, "id_produit": [11, 12]}),
        "commandes": A.purge_predicate({"id_commande": 7, "id_client": 13, "id_employe": 3}),
        "produits": A.purge_predicate({"id_produit": [11, 12], "id_fournisseur": 5}),
        "categories": A.purge_predicate({"id_categorie": 35}),
        "clients": A.purge_predicate({"id_client": 13}),
        "employes": A.purge_predicate({"id_employe": 3}),
        "fournisseurs": A.purge_predicate({"id_fournisseur": 5}),
    }
    return _digest(M.purge(frags, predicates))


@query
def purge_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clients of a country and a supplier off every site, with all that names them."""
    frags = _loaded(spark, load_test_tables(spark, sf_dir), BY_VOLUME)
    keys = {
        "clients": frags["clients"].where(F.col("pays") == "7").select("id_client"),
        "fournisseurs": frags["fournisseurs"].where(F.col("id_fournisseur") == 5).select("id_fournisseur"),
    }
    return _digest(PU.purge_closure(frags, keys))


def _global_after(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        numbered = stored_lines(spark, sf_dir)
        tables, frags = _before(spark, sf_dir, rule, numbered)
        after, _, _ = M.apply_batch(tables, frags, FD.change_feed(spark, sf_dir, numbered), rule)
        return after["lignes_commandes"].select(*_line_columns())

    return run


_add("apply_changes_global", _global_after(BY_QUERY))

# ---------------------------------------------------------------- constraints, errors, placement


@query
def check_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.check_domain(load_test_tables(spark, sf_dir))


@query
def check_primary_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of the global tables, and what the line number of the raw data would be as a key."""
    t = load_test_tables(spark, sf_dir)
    numbered = raw(spark, sf_dir, "lineitem").select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias(_LINE))
    raw_key = Q.check_pk({"lignes_commandes": numbered}).withColumn("tbl", F.lit("lineitem"))
    return Q.check_pk(t).unionByName(raw_key)


@query
def check_foreign_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """References of the global tables, and of a by-query fragment without its site-2 orders."""
    t = load_test_tables(spark, sf_dir)
    frags = _loaded(spark, t, BY_QUERY)
    broken = {**frags, "commandes": frags["commandes"].where(F.col("site") == 1)}
    return FR.union_sites(
        [
            Q.check_fk(t).withColumn("scope", F.lit("global")),
            Q.check_fk(frags, per_site=True).withColumn("scope", F.lit("sites")),
            Q.check_fk(broken, per_site=True).withColumn("scope", F.lit("broken")),
        ]
    )


@query
def rejection_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the strict procedures refuse, per code and kind."""
    numbered = stored_lines(spark, sf_dir)
    tables, frags = _before(spark, sf_dir, BY_VOLUME, numbered)
    refused = [
        M.insert_lines(frags, tables, insert_calls(spark, sf_dir, BY_VOLUME, numbered), STRICT)[1],
        M.update_lines(frags, tables, update_calls(spark, sf_dir, BY_VOLUME, numbered), STRICT)[1],
        M.delete_lines(frags, tables, delete_calls(spark, sf_dir, BY_VOLUME, numbered), STRICT)[1],
    ]
    return Q.rejections(FR.union_sites(refused)).select("error_code", "kind", "nb")


@query
def audit_placement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines out of place when the whole feed has reached the global table but no site."""
    tables = FD.tables_before(spark, sf_dir)
    frags = FR.derive(tables, BY_QUERY)
    feed = FD.change_feed(spark, sf_dir)
    after = {**tables, "lignes_commandes": CH.apply_changes_global(tables["lignes_commandes"], feed)}
    return Q.audit(after, frags, BY_QUERY).select(_LINE, _int("expected"), _int("actual"))


@query
def change_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every product of categories 9, 35 and 50 passed on to the next of them; the sites after it, and what is out of place then."""
    tables = load_test_tables(spark, sf_dir)
    category = F.col("id_categorie")
    following = F.when(category == 9, 35).when(category == 35, 50).otherwise(9).cast("bigint")
    moves = tables["produits"].where(category.isin(9, 35, 50)).select("id_produit", following.alias("id_categorie"))
    after, frags, refused = RC.change_categories(tables, _loaded(spark, tables, BY_QUERY), settle(moves), BY_QUERY)
    misplaced = Q.audit(after, frags, BY_QUERY)
    none = F.lit(0).cast("bigint")
    shown = misplaced.select(
        F.lit("misplaced").alias("tbl"), _int("actual").alias("site"), F.col(_LINE).alias("id"), none.alias("id_produit"),
        none.alias("quantite"), F.lit(0.0).alias("remise"), none.alias("id_client"),
    )
    return FR.union_sites([_digest(frags, refused), shown])


def _counts(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return Q.site_counts(_loaded(spark, load_test_tables(spark, sf_dir), rule)).select("tbl", _int("site"), "nb")

    return run


_add("site_counts", _both(_counts))

# ---------------------------------------------------------------- streaming, layout


FEED_PARTS, FEED_FILES = 4, 8


def _feed_files(spark: SparkSession, changes: DataFrame, order: Sequence[int] = range(FEED_PARTS)) -> tuple[str, int]:
    """The (stored) feed as files by ``seq`` range, written in that order: the file source goes by time.
    Gives the folder and the files of each range; each is written by a task of its own."""
    path = workdir(spark, "feed")
    low, high = changes.agg(F.min("seq"), F.max("seq")).first()
    part = F.floor((F.col("seq") - low) * FEED_PARTS / (high + 1 - low)) if low is not None else F.lit(0)
    rows = changes.withColumn("_part", part)
    least = rows.groupBy("_part").count().agg(F.min("count")).first()[0]
    files = max(1, min(FEED_FILES, least or 1))
    for k in order:
        rows.where(F.col("_part") == k).drop("_part").repartition(files).write.mode("append").parquet(path)
    return path, files


def _stream_routed(rule) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        sink, checkpoint = workdir(spark, "actions"), workdir(spark, "offsets")
        stream = ST.read_feed(spark, *_feed_files(spark, settle(FD.change_feed(spark, sf_dir))))
        products = load_test_tables(spark, sf_dir)["produits"]
        ST.drain(ST.stream_route(stream, products, rule, sink, checkpoint))
        return _action_columns(spark.read.parquet(sink))

    return run


_add("stream_route_changes", _both(_stream_routed))


@query
def stream_apply_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed applied in four micro-batches, each a new version of all tables."""
    numbered = stored_lines(spark, sf_dir)
    tables = FD.tables_before(spark, sf_dir, numbered)
    root = workdir(spark, "store")
    ST.begin(root, tables, BY_QUERY)
    stream = ST.read_feed(spark, *_feed_files(spark, settle(FD.change_feed(spark, sf_dir, numbered))))
    ST.drain(ST.stream_apply(stream, root, tables, BY_QUERY, workdir(spark, "offsets")))
    _, frags = ST.state(spark, root, tables)
    return _digest(frags, ST.rejected_changes(spark, root))


@query
def stream_replay_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed replayed from files out of order, then its changes of discounts once more, too late to count."""
    numbered = stored_lines(spark, sf_dir)
    tables = FD.tables_before(spark, sf_dir, numbered)
    root = workdir(spark, "store")
    ST.begin(root, tables, BY_VOLUME)
    begin = dt.datetime(2026, 1, 1, tzinfo=dt.timezone.utc)
    changes = FD.change_feed(spark, sf_dir, numbered)
    changes = settle(changes.withColumn("at", F.timestamp_millis(F.lit(int(begin.timestamp() * 1000)) + F.col("seq"))))
    path, files = _feed_files(spark, changes, (1, 0, 3, 2))
    low, high = changes.agg(F.min("at"), F.max("at")).first()
    half = (high - low) / 2 + dt.timedelta(milliseconds=1) if low is not None else dt.timedelta(0)
    # As many files as a trigger takes: the late ones come in a trigger of their own.
    OR.clock_rows(spark, begin + dt.timedelta(days=36_500), files).write.mode("append").parquet(path)
    discounts = changes.where((F.col("op") == "U") & ~F.col("old_remise").eqNullSafe(F.col("new_remise")))
    discounts.coalesce(files).write.mode("append").parquet(path)
    stream = OR.read_timed_feed(spark, path, files)
    ST.drain(OR.stream_apply_ordered(stream, root, tables, BY_VOLUME, workdir(spark, "offsets"), half))
    _, frags = ST.state(spark, root, tables)
    none = F.lit(0).cast("bigint")
    late = OR.late_changes(spark, root).select(
        F.lit("late").alias("tbl"), F.lit(0).alias("site"), F.col("seq").alias("id"), none.alias("id_produit"),
        none.alias("quantite"), F.lit(0.0).alias("remise"), none.alias("id_client"),
    )
    return FR.union_sites([_digest(frags, ST.rejected_changes(spark, root)), late])


@query
def layout_orders_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workdir(spark, "orders")
    layout.layout_by_year(load_test_tables(spark, sf_dir)["commandes"], path)
    return layout.read_year(spark, path, YEAR).select("id_commande", "id_client", "date_commande")

