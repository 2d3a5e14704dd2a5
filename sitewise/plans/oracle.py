"""The same results as plain SQL, for an independent engine over the same tables.

Views that several checks share are named once in ``VIEWS``; ``_sql`` puts those a
statement names in front of it. Placement, cascades and refusals are written here as
relational statements about the state before and after; the strict replay walks each
order's changes one by one in a recursive query.
"""

from __future__ import annotations

import re

VIEWS: dict[str, str] = {}

_LINE_ORDER = (
    "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_shipdate, "
    "l_returnflag, l_linestatus"
)

VIEWS["numbered"] = f"""
SELECT (l_orderkey + 1) * 1000 + row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINE_ORDER}) AS id_ligne_commande,
       l_orderkey AS id_commande, l_partkey AS id_produit, CAST(l_quantity AS BIGINT) AS quantite,
       CAST(l_discount AS DECIMAL(5,4)) AS remise, l_linenumber AS number, l_returnflag AS flag
FROM lineitem"""
VIEWS["lignes"] = "SELECT id_ligne_commande, id_commande, id_produit, quantite, remise FROM numbered"
VIEWS["base"] = "SELECT id_ligne_commande, id_commande, id_produit, quantite, remise FROM numbered WHERE number <> 5"
VIEWS["fournisseurs"] = "SELECT s_suppkey AS id_fournisseur, s_name AS societe_fournisseur FROM supplier"
VIEWS["categories"] = (
    "SELECT DISTINCT CAST(p_size AS BIGINT) AS id_categorie, 'CAT-' || p_size AS nom_categorie FROM part"
)
VIEWS["employes"] = (
    "SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id_employe, o_orderpriority AS nom FROM orders"
)
VIEWS["clients"] = (
    "SELECT c_custkey AS id_client, c_name AS societe, c_name AS contact, c_mktsegment AS fonction, "
    "CAST(c_nationkey AS VARCHAR) AS pays FROM customer"
)
VIEWS["produits"] = """
SELECT p_partkey AS id_produit, p_name AS designation, s.id_fournisseur, CAST(p_size AS BIGINT) AS id_categorie,
       CAST(p_retailprice AS DECIMAL(12,4)) AS prix_unitaire, 0 AS indisponible
FROM part LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS id_fournisseur FROM lineitem GROUP BY l_partkey) s
  ON s.l_partkey = p_partkey"""
VIEWS["commandes"] = """
SELECT o_orderkey AS id_commande, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS id_employe, o_custkey AS id_client,
       o_orderdate AS date_commande, d.date_livraison
FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS date_livraison FROM lineitem GROUP BY l_orderkey) d
  ON d.l_orderkey = o_orderkey"""

# The change feed.
VIEWS["smallest"] = "SELECT p_size, min(p_partkey) AS id_produit FROM part WHERE p_size IN (35, 50) GROUP BY p_size"
VIEWS["feed"] = """
SELECT n.id_ligne_commande AS seq,
       CASE number WHEN 1 THEN 'D' WHEN 5 THEN 'I' ELSE 'U' END AS op,
       n.id_ligne_commande, n.id_commande,
       CASE WHEN number <> 5 THEN n.id_produit END AS old_id_produit,
       CASE WHEN number <> 5 THEN quantite END AS old_quantite,
       CASE WHEN number <> 5 THEN remise END AS old_remise,
       CASE WHEN number = 3 THEN coalesce(t.id_produit, n.id_produit) WHEN number <> 1 THEN n.id_produit END AS new_id_produit,
       CASE number WHEN 1 THEN NULL WHEN 2 THEN 51 - quantite WHEN 6 THEN -quantite ELSE quantite END AS new_quantite,
       CASE number WHEN 1 THEN NULL WHEN 4 THEN CAST(remise + 0.01 AS DECIMAL(5,4)) ELSE remise END AS new_remise
FROM numbered n
JOIN part p ON p.p_partkey = n.id_produit
LEFT JOIN smallest t ON t.p_size = CASE WHEN flag = 'R' THEN p.p_size ELSE 85 - p.p_size END AND p.p_size IN (35, 50)
WHERE number <= 6"""
VIEWS["feed_c"] = """
SELECT f.*, po.id_categorie AS old_categorie, pn.id_categorie AS new_categorie
FROM feed f LEFT JOIN produits po ON po.id_produit = f.old_id_produit
LEFT JOIN produits pn ON pn.id_produit = f.new_id_produit"""


def _by_query(quantity: str, category: str) -> str:
    return f"CASE WHEN {category} = 50 AND {quantity} > 40 THEN 1 WHEN {category} = 35 AND {quantity} > 20 THEN 2 ELSE 0 END"


def _by_volume(quantity: str) -> str:
    return f"CASE WHEN {quantity} >= 40 THEN 1 ELSE 2 END"


_CHANGED = (
    "(op <> 'U' OR old_id_produit IS DISTINCT FROM new_id_produit OR old_quantite IS DISTINCT FROM new_quantite "
    "OR old_remise IS DISTINCT FROM new_remise)"
)
_FIRES_1 = f"{_CHANGED} AND (coalesce(old_quantite > 20, FALSE) OR coalesce(new_quantite > 20, FALSE))"

# Changes with the site before and after; only those that can touch a site.
VIEWS["c1"] = f"""
SELECT *, CASE WHEN op = 'I' THEN 0 ELSE {_by_query('old_quantite', 'old_categorie')} END AS old_site,
       CASE WHEN op = 'D' THEN 0 ELSE {_by_query('new_quantite', 'new_categorie')} END AS new_site
FROM feed_c WHERE {_FIRES_1}"""
VIEWS["c2"] = f"""
SELECT *, CASE WHEN op = 'I' THEN 0 ELSE {_by_volume('old_quantite')} END AS old_site,
       CASE WHEN op = 'D' THEN 0 ELSE {_by_volume('new_quantite')} END AS new_site
FROM feed WHERE {_CHANGED}"""
for _s in ("1", "2"):
    VIEWS[f"k{_s}"] = f"""
SELECT *, CASE WHEN old_site = 0 AND new_site = 0 THEN 'N' WHEN old_site = 0 THEN 'I' WHEN new_site = 0 THEN 'D'
               WHEN old_site = new_site THEN 'U' ELSE 'M' END AS kind FROM c{_s}"""
    VIEWS[f"a{_s}"] = f"""
SELECT seq, CAST(1 AS INTEGER) AS step, 'DELETE' AS action, old_site AS site, id_ligne_commande, id_commande,
       old_id_produit AS id_produit, old_quantite AS quantite, old_remise AS remise, op
FROM k{_s} WHERE kind IN ('D', 'M')
UNION ALL
SELECT seq, CAST(CASE WHEN kind = 'M' THEN 2 ELSE 1 END AS INTEGER), CASE WHEN kind = 'U' THEN 'UPDATE' ELSE 'INSERT' END,
       new_site, id_ligne_commande, id_commande, new_id_produit, new_quantite, new_remise, op
FROM k{_s} WHERE kind IN ('I', 'M', 'U')"""


def _fragments(prefix: str, lines: str, by_query: bool) -> None:
    """Site tables derived from a line table; views ``<prefix>_<table>``."""
    p = prefix
    if by_query:
        VIEWS[f"{p}_lignes"] = f"""
SELECT l.*, c.id_client, {_by_query('l.quantite', 'p.id_categorie')} AS site
FROM {lines} l JOIN produits p ON p.id_produit = l.id_produit JOIN commandes c ON c.id_commande = l.id_commande
WHERE {_by_query('l.quantite', 'p.id_categorie')} > 0"""
        held = "CASE id_categorie WHEN 50 THEN 1 WHEN 35 THEN 2 END"
        for table in ("produits", "categories"):
            VIEWS[f"{p}_{table}"] = f"SELECT *, {held} AS site FROM {table} WHERE id_categorie IN (35, 50)"
    else:
        VIEWS[f"{p}_lignes"] = f"""
SELECT *, CASE WHEN quantite >= 40 THEN 1 ELSE 2 END AS site FROM {lines} WHERE quantite IS NOT NULL"""
        VIEWS[f"{p}_produits"] = _parents("produits", f"{p}_lignes", "id_produit")
        VIEWS[f"{p}_categories"] = _parents("categories", f"{p}_produits", "id_categorie")
    VIEWS[f"{p}_commandes"] = _parents("commandes", f"{p}_lignes", "id_commande")
    VIEWS[f"{p}_clients"] = _parents("clients", f"{p}_commandes", "id_client")
    VIEWS[f"{p}_employes"] = _parents("employes", f"{p}_commandes", "id_employe")
    VIEWS[f"{p}_fournisseurs"] = _parents("fournisseurs", f"{p}_produits", "id_fournisseur")


def _parents(table: str, children: str, key: str) -> str:
    return " UNION ALL ".join(
        f"SELECT *, {site} AS site FROM {table} WHERE {key} IN (SELECT {key} FROM {children} WHERE site = {site})"
        for site in (1, 2)
    )


_fragments("g1", "lignes", True)
_fragments("g2", "lignes", False)
_fragments("b1", "base", True)
_fragments("b2", "base", False)

_TABLES = {
    "fournisseurs": "id_fournisseur",
    "categories": "id_categorie",
    "employes": "id_employe",
    "clients": "id_client",
    "produits": "id_produit",
    "commandes": "id_commande",
}


def _digest(prefix: str, client: bool, rejected: str | None = None, site: str = "site", only: str = "TRUE") -> str:
    parts = [
        f"SELECT '{table}' AS tbl, CAST({site} AS INTEGER) AS site, {key} AS id, CAST(0 AS BIGINT) AS id_produit, "
        f"CAST(0 AS BIGINT) AS quantite, CAST(0 AS DOUBLE) AS remise, CAST(0 AS BIGINT) AS id_client "
        f"FROM {prefix}_{table} WHERE {only}"
        for table, key in _TABLES.items()
    ]
    parts.append(
        f"SELECT 'lignes_commandes', CAST({site} AS INTEGER), id_ligne_commande, id_produit, quantite, "
        f"CAST(remise AS DOUBLE), {'id_client' if client else '0'} FROM {prefix}_lignes WHERE {only}"
    )
    if rejected:
        parts.append(
            f"SELECT 'rejected', CAST(site AS INTEGER), seq, 0, CAST(code AS BIGINT), 0, 0 FROM {rejected}"
        )
    return " UNION ALL ".join(parts)


def _sql(body: str, extra: dict[str, str] | None = None) -> str:
    """The statement with the views it names, in order of dependence."""
    views = {**VIEWS, **(extra or {})}
    ordered: list[str] = []

    def add(text: str, above: tuple[str, ...] = ()) -> None:
        for name in re.findall(r"[a-z_0-9]+", text):
            if name in views and name not in ordered and name not in above:
                add(views[name], (*above, name))
                ordered.append(name)

    add(body)
    if not ordered:
        return body.strip()
    recursive = "RECURSIVE " if any(name.endswith("_walk") for name in ordered) else ""
    return f"WITH {recursive}" + ",\n".join(f"{name} AS ({views[name].strip()})" for name in ordered) + "\n" + body.strip()


def _both(by_query: str, by_volume: str) -> str:
    return f"SELECT *, 'by_query' AS rule FROM ({by_query}) UNION ALL SELECT *, 'by_volume' AS rule FROM ({by_volume})"


_LINE_COLUMNS = "id_ligne_commande, id_commande, id_produit, quantite, CAST(remise AS DOUBLE) AS remise"

# ---------------------------------------------------------------- direct calls

_BAD_INPUT = "(quantite <= 0 OR remise < 0 OR id_ligne_commande <= 0 OR id_commande <= 0 OR id_produit <= 0)"


def _at(prefix: str, table: str, key: str, row: str = "r") -> str:
    return f"({row}.site, {row}.{key}) IN (SELECT (site, {key}) FROM {prefix}_{table})"


def _calls(scenario: str) -> dict[str, str]:
    """The insert, update and delete calls, with the sites of all lines under the rule."""
    site = _by_query("n.quantite", "p.id_categorie") if scenario == "1" else _by_volume("n.quantite")
    return {
        "all_sited": f"SELECT n.*, {site} AS site FROM numbered n LEFT JOIN produits p ON p.id_produit = n.id_produit",
        "ins_once": """
SELECT id_ligne_commande * 2 AS seq,
       CASE WHEN number = 2 THEN CASE WHEN site = 1 THEN 2 ELSE 1 END ELSE site END AS site,
       id_ligne_commande, id_commande, id_produit, CASE WHEN number = 6 THEN -quantite ELSE quantite END AS quantite, remise, number
FROM all_sited WHERE number IN (1, 2, 5, 6)""",
        "ins_calls": """
SELECT seq, site, id_ligne_commande, id_commande, id_produit, quantite, remise FROM ins_once WHERE site > 0
UNION ALL
SELECT seq + 1, site, id_ligne_commande, id_commande, id_produit, quantite, remise FROM ins_once WHERE site > 0 AND number = 5""",
        "upd_calls": """
SELECT id_ligne_commande AS seq, CASE WHEN number = 1 THEN 3 - site ELSE site END AS site, id_ligne_commande,
       CASE WHEN number = 3 THEN CASE WHEN flag = 'R' THEN id_produit + 1000000000 ELSE 1 END END AS id_produit,
       CASE WHEN number = 2 THEN 51 - quantite END AS quantite,
       CASE WHEN number = 4 THEN -remise - 0.01 END AS remise
FROM all_sited WHERE site > 0 AND number IN (1, 2, 3, 4, 6)""",
        "del_calls": """
SELECT id_ligne_commande AS seq, CASE WHEN number = 4 THEN 3 - site ELSE site END AS site, id_ligne_commande
FROM all_sited WHERE site > 0 AND number <= 4""",
    }


def _insert(scenario: str) -> tuple[dict[str, str], str]:
    strict = scenario == "2"
    b = f"b{scenario}"
    parents = (
        f"WHEN NOT {_at(b, 'commandes', 'id_commande')} THEN -20003 WHEN NOT {_at(b, 'produits', 'id_produit')} THEN -20004"
        if strict
        else ""
    )
    client = "" if strict else ", (SELECT id_client FROM commandes c WHERE c.id_commande = j.id_commande) AS id_client"
    views = {
        **_calls(scenario),
        "ins_alone": f"""
SELECT r.*, CASE WHEN {_BAD_INPUT} THEN -20001 WHEN {_at(b, 'lignes', 'id_ligne_commande')} THEN -20002 {parents} ELSE 0 END AS alone
FROM ins_calls r""",
        "ins_judged": """
SELECT *, CASE WHEN alone <> -20001 AND seq > min(CASE WHEN alone = 0 THEN seq END) OVER (PARTITION BY site, id_ligne_commande)
               THEN -20002 ELSE alone END AS code FROM ins_alone""",
        "ins_bad": "SELECT * FROM ins_judged WHERE code <> 0",
        "ins_ok": f"SELECT id_ligne_commande, id_commande, id_produit, quantite, remise{client}, site FROM ins_judged j WHERE code = 0",
        "z_lignes": f"SELECT * FROM {b}_lignes UNION ALL SELECT * FROM ins_ok",
    }
    for table in _TABLES:
        views[f"z_{table}"] = f"SELECT * FROM {b}_{table}"
    if not strict:
        views.update(_hydrated("ins_ok", b))
    return views, _digest("z", not strict, "ins_bad")


def _hydrated(inserted: str, b: str, orders_from: str | None = None) -> dict[str, str]:
    """Parents of new lines, added to those a site holds."""
    orders_from = orders_from or inserted
    new_orders = f"SELECT c.*, i.site FROM commandes c JOIN (SELECT DISTINCT site, id_commande FROM {orders_from}) i USING (id_commande)"
    new_products = f"SELECT p.*, i.site FROM produits p JOIN (SELECT DISTINCT site, id_produit FROM {inserted}) i USING (id_produit)"
    views = {"h_commandes": new_orders, "h_produits": new_products}
    for table, key, children in (
        ("clients", "id_client", "h_commandes"),
        ("employes", "id_employe", "h_commandes"),
        ("fournisseurs", "id_fournisseur", "h_produits"),
        ("categories", "id_categorie", "h_produits"),
    ):
        views[f"h_{table}"] = f"SELECT t.*, i.site FROM {table} t JOIN (SELECT DISTINCT site, {key} FROM {children}) i USING ({key})"
    for table in _TABLES:
        views[f"z_{table}"] = f"SELECT * FROM {b}_{table} UNION SELECT * FROM h_{table}"
    return views


def _update(scenario: str) -> tuple[dict[str, str], str]:
    strict = scenario == "2"
    b = f"b{scenario}"
    known = (
        _at(b, "produits", "id_produit")
        if strict
        else f"({_at(b, 'produits', 'id_produit')} OR r.id_produit IN (SELECT id_produit FROM produits))"
    )
    views = {
        **_calls(scenario),
        "upd_judged": f"""
SELECT r.*, CASE WHEN NOT {_at(b, 'lignes', 'id_ligne_commande')} THEN -20006
                 WHEN r.id_produit IS NOT NULL AND NOT {known} THEN {-20007 if strict else -1403}
                 WHEN coalesce(quantite, 1) <= 0 OR coalesce(remise, 0) < 0 THEN -20008 ELSE 0 END AS code
FROM upd_calls r""",
        "upd_bad": "SELECT * FROM upd_judged WHERE code <> 0",
        "upd_ok": "SELECT * FROM upd_judged WHERE code = 0",
        "z_lignes": f"""
SELECT l.* REPLACE (coalesce(u.id_produit, l.id_produit) AS id_produit, coalesce(u.quantite, l.quantite) AS quantite,
                    coalesce(u.remise, l.remise) AS remise)
FROM {b}_lignes l LEFT JOIN upd_ok u ON u.site = l.site AND u.id_ligne_commande = l.id_ligne_commande""",
    }
    for table in _TABLES:
        views[f"z_{table}"] = f"SELECT * FROM {b}_{table}"
    if not strict:
        views["upd_new"] = "SELECT site, id_produit FROM upd_ok WHERE id_produit IS NOT NULL"
        views.update(
            {k: v for k, v in _hydrated("upd_new", b, "z_none").items() if k not in ("z_commandes", "z_clients", "z_employes")}
        )
        views["z_none"] = "SELECT 0 AS site, CAST(0 AS BIGINT) AS id_commande WHERE FALSE"
        views["upd_left"] = f"""
SELECT DISTINCT l.site, l.id_produit FROM {b}_lignes l JOIN upd_ok u
  ON u.site = l.site AND u.id_ligne_commande = l.id_ligne_commande AND u.id_produit <> l.id_produit"""
        views["z_produits"] = f"""
SELECT * FROM (SELECT * FROM {b}_produits UNION SELECT * FROM h_produits)
WHERE (site, id_produit) NOT IN (SELECT (site, id_produit) FROM upd_left)
   OR (site, id_produit) IN (SELECT (site, id_produit) FROM z_lignes)"""
    return views, _digest("z", not strict, "upd_bad")


def _delete(scenario: str) -> str:
    strict = scenario == "2"
    b, x = f"b{scenario}", f"x{scenario}"
    # Placed inside one statement for both rules, hence names of their own.
    site = _by_query("n.quantite", "p.id_categorie") if scenario == "1" else _by_volume("n.quantite")
    VIEWS[f"{x}_calls"] = f"""
SELECT id_ligne_commande AS seq, CASE WHEN number = 4 THEN 3 - site ELSE site END AS site, id_ligne_commande
FROM (SELECT n.*, {site} AS site FROM numbered n LEFT JOIN produits p ON p.id_produit = n.id_produit)
WHERE site > 0 AND number <= 4"""
    VIEWS[f"{x}_hit"] = f"""
SELECT l.* FROM {b}_lignes l JOIN {x}_calls r ON r.site = l.site AND r.id_ligne_commande = l.id_ligne_commande"""
    unknown = f"SELECT r.*, -20005 AS code FROM {x}_calls r WHERE NOT {_at(b, 'lignes', 'id_ligne_commande')}"
    VIEWS[f"{x}_bad"] = unknown if strict else f"SELECT * FROM ({unknown}) WHERE FALSE"
    VIEWS[f"{x}_lignes"] = f"SELECT * FROM {b}_lignes r WHERE NOT {_at(x, 'hit', 'id_ligne_commande')}"
    VIEWS[f"{x}_commandes"] = f"""
SELECT * FROM {b}_commandes r
WHERE NOT ({_at(x, 'hit', 'id_commande')} AND NOT {_at(x, 'lignes', 'id_commande')})"""
    VIEWS[f"{x}_lost"] = f"SELECT * FROM {b}_commandes r WHERE NOT {_at(x, 'commandes', 'id_commande')}"
    VIEWS[f"{x}_clients"] = f"""
SELECT * FROM {b}_clients r WHERE NOT ({_at(x, 'lost', 'id_client')} AND NOT {_at(x, 'commandes', 'id_client')})"""
    for table in ("fournisseurs", "categories", "employes", "produits"):
        VIEWS[f"{x}_{table}"] = f"SELECT * FROM {b}_{table}"
    return _digest(x, not strict, f"{x}_bad")


# ---------------------------------------------------------------- whole feed, by query

# Refused are inserts at a site with a bad value; the rest is accepted.
VIEWS["f1"] = """
SELECT *, CASE WHEN kind IN ('I', 'M') AND (new_quantite <= 0 OR new_remise < 0 OR id_ligne_commande <= 0
                                            OR id_commande <= 0 OR new_id_produit <= 0) THEN -20001 ELSE 0 END AS code FROM k1"""
VIEWS["f1_bad"] = "SELECT seq, new_site AS site, code FROM f1 WHERE code <> 0"
VIEWS["f1_feed"] = "SELECT * FROM feed WHERE seq NOT IN (SELECT seq FROM f1_bad)"
VIEWS["after1"] = """
SELECT * FROM base WHERE id_ligne_commande NOT IN (SELECT id_ligne_commande FROM f1_feed)
UNION ALL
SELECT id_ligne_commande, id_commande, new_id_produit, new_quantite, new_remise FROM f1_feed WHERE op <> 'D'"""
# Lines are where a fresh load of the global table would put them.
_fragments("w1", "after1", True)
VIEWS["f1_off"] = "SELECT seq, old_site AS site, id_commande, old_id_produit AS id_produit, kind FROM f1 WHERE code = 0 AND (kind IN ('D', 'M') OR (kind = 'U' AND old_id_produit <> new_id_produit))"
VIEWS["z1_lignes"] = "SELECT * FROM w1_lignes"
VIEWS["z1_commandes"] = f"""
SELECT * FROM w1_commandes UNION
SELECT * FROM b1_commandes r WHERE NOT (r.site, r.id_commande) IN (SELECT (site, id_commande) FROM f1_off WHERE kind <> 'U')"""
VIEWS["z1_lost"] = "SELECT * FROM b1_commandes r WHERE NOT " + _at("z1", "commandes", "id_commande")
VIEWS["z1_clients"] = f"""
SELECT * FROM b1_clients r WHERE {_at('z1', 'commandes', 'id_client')} OR NOT {_at('z1', 'lost', 'id_client')}
UNION SELECT * FROM w1_clients"""
VIEWS["z1_employes"] = "SELECT * FROM b1_employes UNION SELECT * FROM w1_employes"
VIEWS["z1_dropped"] = "SELECT site, id_produit FROM f1_off GROUP BY site, id_produit HAVING arg_max(kind, seq) = 'U'"
VIEWS["z1_kept"] = f"""
SELECT * FROM b1_produits r WHERE NOT {_at('z1', 'dropped', 'id_produit')} OR {_at('w1', 'lignes', 'id_produit')}"""
VIEWS["z1_pulled"] = _parents("produits", "w1_lignes", "id_produit")
VIEWS["z1_produits"] = "SELECT * FROM z1_kept UNION SELECT * FROM z1_pulled"
VIEWS["z1_fournisseurs"] = "SELECT * FROM b1_fournisseurs UNION (" + _parents("fournisseurs", "z1_pulled", "id_fournisseur") + ")"
VIEWS["z1_categories"] = "SELECT * FROM b1_categories UNION (" + _parents("categories", "z1_pulled", "id_categorie") + ")"

# ---------------------------------------------------------------- whole feed, by volume: one change after the other

_NEW_BAD = (
    "(f.new_quantite <= 0 OR f.new_remise < 0 OR f.id_ligne_commande <= 0 OR f.id_commande <= 0 OR f.new_id_produit <= 0)"
)
VIEWS["ev"] = f"""
SELECT f.*, row_number() OVER (PARTITION BY f.id_commande ORDER BY seq) AS i,
       (f.old_site, f.id_ligne_commande) IN (SELECT (site, id_ligne_commande) FROM b2_lignes) AS there,
       (f.new_site, f.id_ligne_commande) IN (SELECT (site, id_ligne_commande) FROM b2_lignes) AS taken,
       (f.new_site, f.new_id_produit) IN (SELECT (site, id_produit) FROM b2_produits) AS product,
       {_NEW_BAD} AS bad_input,
       coalesce(f.new_quantite, 1) <= 0 OR coalesce(f.new_remise, 0) < 0 AS bad_values
FROM k2 f"""
VIEWS["starts"] = """
SELECT c.id_commande,
       count(*) FILTER (WHERE l.site = 1) AS n1, count(*) FILTER (WHERE l.site = 2) AS n2,
       (1, c.id_commande) IN (SELECT (site, id_commande) FROM b2_commandes) AS e1,
       (2, c.id_commande) IN (SELECT (site, id_commande) FROM b2_commandes) AS e2
FROM commandes c LEFT JOIN b2_lignes l ON l.id_commande = c.id_commande GROUP BY c.id_commande"""
_STEP = """
CASE WHEN kind IN ('D', 'M') AND NOT there THEN -20005
     WHEN kind IN ('I', 'M') THEN CASE WHEN bad_input THEN -20001 WHEN taken THEN -20002
          WHEN NOT CASE new_site WHEN 1 THEN w.e1 ELSE w.e2 END THEN -20003 WHEN NOT product THEN -20004 ELSE 0 END
     WHEN kind = 'U' THEN CASE WHEN NOT there THEN -20006 WHEN NOT product THEN -20007 WHEN bad_values THEN -20008 ELSE 0 END
     ELSE 0 END"""
VIEWS["ev_walk"] = f"""
SELECT id_commande, CAST(0 AS BIGINT) AS i, n1, n2, e1, e2, CAST(0 AS BIGINT) AS seq, 0 AS code FROM starts
UNION ALL
SELECT id_commande, i, n1, n2,
       e1 AND NOT (code = 0 AND off = 1 AND n1 = 0), e2 AND NOT (code = 0 AND off = 2 AND n2 = 0), seq, code
FROM (SELECT id_commande, i, seq, code, off, e1, e2,
             n1 + CASE WHEN code = 0 THEN (gain = 1)::INT - (off = 1)::INT ELSE 0 END AS n1,
             n2 + CASE WHEN code = 0 THEN (gain = 2)::INT - (off = 2)::INT ELSE 0 END AS n2
      FROM (SELECT w.id_commande, ev.i, ev.seq, w.n1, w.n2, w.e1, w.e2, {_STEP} AS code,
                   CASE WHEN kind IN ('D', 'M') THEN old_site ELSE 0 END AS off,
                   CASE WHEN kind IN ('I', 'M') THEN new_site ELSE 0 END AS gain
            FROM ev_walk w JOIN ev ON ev.id_commande = w.id_commande AND ev.i = w.i + 1))"""
VIEWS["verdicts"] = "SELECT ev.*, w.code FROM ev JOIN ev_walk w ON w.id_commande = ev.id_commande AND w.i = ev.i"
VIEWS["y2_bad"] = (
    "SELECT seq, CASE WHEN code = -20005 OR new_site = 0 THEN old_site ELSE new_site END AS site, code FROM verdicts WHERE code <> 0"
)
VIEWS["y2_ok"] = "SELECT * FROM verdicts WHERE code = 0 AND kind <> 'N'"
VIEWS["y2_lignes"] = """
SELECT id_ligne_commande, id_commande, id_produit, quantite, remise, site FROM b2_lignes
WHERE id_ligne_commande NOT IN (SELECT id_ligne_commande FROM y2_ok)
UNION ALL
SELECT id_ligne_commande, id_commande, new_id_produit, new_quantite, new_remise, new_site FROM y2_ok WHERE kind <> 'D'"""
VIEWS["y2_end"] = "SELECT id_commande, last(e1 ORDER BY i) AS e1, last(e2 ORDER BY i) AS e2 FROM ev_walk GROUP BY id_commande"
VIEWS["y2_commandes"] = """
SELECT r.* FROM b2_commandes r JOIN y2_end s ON s.id_commande = r.id_commande WHERE CASE r.site WHEN 1 THEN e1 ELSE e2 END"""
VIEWS["y2_lost"] = "SELECT * FROM b2_commandes r WHERE NOT " + _at("y2", "commandes", "id_commande")
VIEWS["y2_clients"] = f"""
SELECT * FROM b2_clients r WHERE {_at('y2', 'commandes', 'id_client')} OR NOT {_at('y2', 'lost', 'id_client')}"""
for _t in ("fournisseurs", "categories", "employes", "produits"):
    VIEWS[f"y2_{_t}"] = f"SELECT * FROM b2_{_t}"

# ---------------------------------------------------------------- all checks


def _fragment(prefix: str, table: str) -> str:
    columns = {
        "lignes": _LINE_COLUMNS + (", id_client" if prefix == "g1" else ""),
        "commandes": "id_commande, id_employe, id_client, date_commande, date_livraison",
        "clients": "id_client, societe, fonction, pays",
        "employes": "id_employe, nom",
        "produits": "id_produit, designation, coalesce(id_fournisseur, 0) AS id_fournisseur, id_categorie, "
        "CAST(prix_unitaire AS DOUBLE) AS prix_unitaire",
        "fournisseurs": "id_fournisseur, societe_fournisseur",
        "categories": "id_categorie, nom_categorie",
    }[table]
    return _sql(f"SELECT {columns}, CAST(site AS INTEGER) AS site FROM {prefix}_{table}")


_YEAR = "date_commande >= TIMESTAMP '1998-01-01' AND date_commande < TIMESTAMP '1999-01-01'"
_ACTION = (
    "seq, step, action, CAST(site AS INTEGER) AS site, id_ligne_commande, id_commande, id_produit, quantite, "
    "CAST(remise AS DOUBLE) AS remise"
)


def _actions(where: str) -> str:
    return _sql(_both(f"SELECT {_ACTION} FROM a1 WHERE {where}", f"SELECT {_ACTION} FROM a2 WHERE {where}"))


def _revenue(prefix: str, term: str, products: str) -> str:
    return _sql(
        f"""SELECT c.id_categorie, c.nom_categorie, CAST({term} AS DOUBLE) AS chiffre_affaires
FROM {prefix}_lignes l
JOIN {prefix}_commandes o ON o.id_commande = l.id_commande AND o.site = l.site
JOIN {products} p ON p.id_produit = l.id_produit {'AND p.site = l.site' if products != 'produits' else ''}
JOIN categories c ON c.id_categorie = p.id_categorie
WHERE {_YEAR} GROUP BY c.id_categorie, c.nom_categorie"""
    )


def _domain() -> str:
    lengths = {
        "fournisseurs": "societe_fournisseur contact_fournisseur fonction_fournisseur adresse_fournisseur "
        "ville_fournisseur region_fournisseur code_postal_fournisseur pays_fournisseur tel_fournisseur fax_fournisseur",
        "categories": "nom_categorie",
        "employes": "nom prenom fonction_employe titre_courtoisie adresse_employe ville_employe pays_employe tel_domicile",
        "clients": "code_client societe contact fonction adresse ville region code_postal pays telephone fax",
        "produits": "designation",
    }
    present = {
        "fournisseurs": {"societe_fournisseur"},
        "categories": {"nom_categorie"},
        "employes": {"nom"},
        "clients": {"societe", "contact", "fonction", "pays"},
        "produits": {"designation"},
    }
    parts = [
        f"SELECT '{table}' AS tbl, '{column} length' AS rule, "
        + (f"count(*) FILTER (WHERE length({column}) > 100)" if column in present[table] else "count(*) FILTER (WHERE FALSE)")
        + f" AS violations FROM {table}"
        for table, columns in lengths.items()
        for column in columns.split()
    ]
    parts += [
        f"SELECT 'clients', '{column} not null', count(*) FILTER (WHERE {column} IS NULL) FROM clients"
        for column in ("societe", "contact", "fonction")
    ]
    parts.append("SELECT 'produits', 'indisponible flag', count(*) FILTER (WHERE indisponible NOT IN (0, 1)) FROM produits")
    parts.append(
        "SELECT 'commandes', 'livraison not before commande', count(*) FILTER (WHERE date_livraison < date_commande) FROM commandes"
    )
    return _sql(" UNION ALL ".join(parts))


def _primary_keys() -> str:
    keys = {**_TABLES, "lignes": "id_ligne_commande"}
    parts = [
        f"SELECT '{'lignes_commandes' if t == 'lignes' else t}' AS tbl, "
        f"(SELECT count(*) FROM (SELECT {k} FROM {t} WHERE {k} IS NOT NULL GROUP BY {k} HAVING count(*) > 1)) AS repeated_keys, "
        f"(SELECT count(*) FROM {t} WHERE {k} IS NULL) AS missing_keys"
        for t, k in keys.items()
    ]
    parts.append(
        "SELECT 'lineitem', (SELECT count(*) FROM (SELECT l_orderkey, l_linenumber FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 0"
    )
    return _sql(" UNION ALL ".join(parts))


def _foreign_keys() -> str:
    references = [
        ("produits", "id_fournisseur", "fournisseurs"),
        ("produits", "id_categorie", "categories"),
        ("commandes", "id_employe", "employes"),
        ("commandes", "id_client", "clients"),
        ("lignes", "id_commande", "commandes"),
        ("lignes", "id_produit", "produits"),
    ]
    parts = []
    for child, column, parent in references:
        name = "lignes_commandes" if child == "lignes" else child
        parts.append(
            f"SELECT '{name}' AS child, '{column}' AS reference, '{parent}' AS parent, "
            f"(SELECT count(*) FROM {child} WHERE {column} NOT IN (SELECT {column} FROM {parent})) AS orphans, 'global' AS scope"
        )
    for scope in ("sites", "broken"):
        for child, column, parent in [*references, ("lignes", "id_client", "clients")]:
            name = "lignes_commandes" if child == "lignes" else child
            cut = "site = 1" if scope == "broken" else "TRUE"
            rows = f"(SELECT * FROM g1_{child}{' WHERE ' + cut if child == 'commandes' else ''})"
            held = f"(SELECT (site, {column}) FROM g1_{parent}{' WHERE ' + cut if parent == 'commandes' else ''})"
            parts.append(
                f"SELECT '{name}', '{column}', '{parent}', (SELECT count(*) FROM {rows} x "
                f"WHERE {column} IS NOT NULL AND (x.site, x.{column}) NOT IN {held}), '{scope}'"
            )
    return _sql(" UNION ALL ".join(parts))


def _rejections() -> str:
    views: dict[str, str] = {}
    for part in (_insert("2")[0], _update("2")[0]):
        views.update({k: v for k, v in part.items() if not k.startswith("z_")})
    return _sql(
        """SELECT code AS error_code, kind, count(*) AS nb FROM (
SELECT code, 'I' AS kind FROM ins_bad UNION ALL SELECT code, 'U' FROM upd_bad UNION ALL SELECT code, 'D' FROM x2_bad)
GROUP BY code, kind""",
        views,
    )


def _compact() -> str:
    old = "CASE WHEN op <> 'D' THEN new_{0} END"
    new = "CASE op WHEN 'D' THEN old_{0} WHEN 'U' THEN new_{0}{1} END"
    views = {
        "twice": f"""
SELECT seq * 2 AS seq, op, id_ligne_commande, id_commande, old_id_produit, old_quantite, old_remise,
       new_id_produit, new_quantite, new_remise FROM feed
UNION ALL
SELECT seq * 2 + 1, CASE op WHEN 'D' THEN 'I' WHEN 'I' THEN 'D' ELSE 'U' END, id_ligne_commande, id_commande,
       {old.format('id_produit')}, {old.format('quantite')}, {old.format('remise')},
       {new.format('id_produit', '')}, {new.format('quantite', ' + 1')}, {new.format('remise', '')} FROM feed""",
        "firsts": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_ligne_commande ORDER BY seq) AS r FROM twice) WHERE r = 1",
        "lasts": "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id_ligne_commande ORDER BY seq DESC) AS r FROM twice) WHERE r = 1",
    }
    return _sql(
        """SELECT l.seq, CASE WHEN f.op = 'I' THEN 'I' WHEN l.op = 'D' THEN 'D' ELSE 'U' END AS op,
       l.id_ligne_commande, l.id_commande,
       coalesce(f.old_id_produit, -1) AS old_id_produit, coalesce(f.old_quantite, -1) AS old_quantite,
       coalesce(l.new_id_produit, -1) AS new_id_produit, coalesce(l.new_quantite, -1) AS new_quantite,
       coalesce(CAST(f.old_remise AS DOUBLE), -1) AS old_remise, coalesce(CAST(l.new_remise AS DOUBLE), -1) AS new_remise
FROM firsts f JOIN lasts l ON l.id_ligne_commande = f.id_ligne_commande
WHERE NOT (f.op = 'I' AND l.op = 'D')""",
        views,
    )


# The feed twice over, in which a deleted line that was returned comes back under the client's next order.
VIEWS["suivantes"] = """
SELECT o_orderkey AS id_commande, lead(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prochaine FROM orders"""
VIEWS["ramenees"] = """
SELECT n.id_ligne_commande, n.id_commande, s.prochaine FROM numbered n JOIN suivantes s ON s.id_commande = n.id_commande
WHERE number = 1 AND flag = 'R' AND prochaine IS NOT NULL"""
VIEWS["liens"] = "SELECT id_commande AS a, prochaine AS b FROM ramenees UNION SELECT prochaine, id_commande FROM ramenees"
VIEWS["liens_walk"] = "SELECT a AS node, a AS vu FROM liens UNION SELECT w.node, l.b FROM liens_walk w JOIN liens l ON l.a = w.vu"
VIEWS["ensuite"] = """
SELECT b.* FROM base b WHERE id_ligne_commande NOT IN (SELECT id_ligne_commande FROM feed)
UNION ALL
SELECT f.id_ligne_commande, coalesce(r.prochaine, f.id_commande),
       CASE op WHEN 'D' THEN old_id_produit ELSE new_id_produit END, CASE op WHEN 'D' THEN old_quantite ELSE new_quantite + 1 END,
       CASE op WHEN 'D' THEN old_remise ELSE new_remise END
FROM feed f LEFT JOIN ramenees r ON r.id_ligne_commande = f.id_ligne_commande WHERE op <> 'I'"""


def _capture(old: str, new: str) -> str:
    """The numbered difference of two line tables; a line under another order goes and comes."""
    values = ("id_produit", "quantite", "remise")
    side = lambda alias, prefix: ", ".join(f"{alias}.{v} AS {prefix}_{v}" for v in values)
    none = lambda prefix: ", ".join(f"NULL AS {prefix}_{v}" for v in values)
    differ = " OR ".join(f"o.{v} IS DISTINCT FROM n.{v}" for v in values)
    shown = ", ".join(
        f"coalesce(CAST({p}_{v} AS DOUBLE), -1) AS {p}_{v}" if v == "remise" else f"coalesce({p}_{v}, -1) AS {p}_{v}"
        for p in ("old", "new")
        for v in values
    )
    views = {
        "ecarts": f"""
SELECT o.id_ligne_commande, 0 AS step, 'D' AS op, o.id_commande, {side('o', 'old')}, {none('new')}
FROM {old} o LEFT JOIN {new} n ON n.id_ligne_commande = o.id_ligne_commande
WHERE n.id_ligne_commande IS NULL OR n.id_commande IS DISTINCT FROM o.id_commande
UNION ALL
SELECT n.id_ligne_commande, 1, 'I', n.id_commande, {none('old')}, {side('n', 'new')}
FROM {new} n LEFT JOIN {old} o ON n.id_ligne_commande = o.id_ligne_commande
WHERE o.id_ligne_commande IS NULL OR n.id_commande IS DISTINCT FROM o.id_commande
UNION ALL
SELECT n.id_ligne_commande, 0, 'U', n.id_commande, {side('o', 'old')}, {side('n', 'new')}
FROM {old} o JOIN {new} n ON n.id_ligne_commande = o.id_ligne_commande AND n.id_commande = o.id_commande
WHERE {differ}"""
    }
    return _sql(
        f"SELECT row_number() OVER (ORDER BY id_ligne_commande, step) AS seq, op, id_ligne_commande, id_commande, {shown} FROM ecarts", views
    )


def _missing() -> str:
    keys = {**_TABLES, "lignes": "id_ligne_commande"}
    views = {f"m_{t}": f"SELECT * FROM g1_{t} r WHERE NOT {_at('b1', t, k)}" for t, k in keys.items()}
    return _sql(_digest("m", True), views)


def _replicated() -> str:
    views = {
        "r_both": "SELECT 1 AS site UNION ALL SELECT 2",
        "r_lignes": "SELECT * FROM b2_lignes",
        "r_commandes": "SELECT * FROM b2_commandes UNION SELECT c.*, s.site FROM commandes c JOIN r_both s ON TRUE "
        "WHERE c.id_commande IN (SELECT id_commande FROM feed WHERE op = 'I')",
        "r_produits": "SELECT * FROM b2_produits UNION SELECT p.*, s.site FROM produits p JOIN r_both s ON TRUE "
        "WHERE p.id_produit IN (SELECT new_id_produit FROM feed WHERE op = 'I')",
    }
    for t in ("fournisseurs", "categories", "employes", "clients"):
        views[f"r_{t}"] = f"SELECT * FROM b2_{t}"
    return _sql(_digest("r", False), views)


def _purged() -> str:
    cut = {
        "lignes": "id_commande = 7 OR id_produit IN (11, 12)",
        "commandes": "id_commande = 7 OR id_client = 13 OR id_employe = 3",
        "produits": "id_produit IN (11, 12) OR id_fournisseur = 5",
        "categories": "id_categorie = 35",
        "clients": "id_client = 13",
        "employes": "id_employe = 3",
        "fournisseurs": "id_fournisseur = 5",
    }
    return _sql(_digest("p", False), {f"p_{t}": f"SELECT * FROM g2_{t} WHERE NOT coalesce({c}, FALSE)" for t, c in cut.items()})


def _closed() -> str:
    """Rows that name a row that goes, go: over all references at once, site by site."""
    references = [
        ("produits", "id_fournisseur", "fournisseurs"),
        ("produits", "id_categorie", "categories"),
        ("commandes", "id_employe", "employes"),
        ("commandes", "id_client", "clients"),
        ("lignes", "id_commande", "commandes"),
        ("lignes", "id_produit", "produits"),
    ]
    keys = {**_TABLES, "lignes": "id_ligne_commande"}
    views = {
        "naming": " UNION ALL ".join(
            f"SELECT '{parent}' AS parent, {column} AS named, site, '{child}' AS child, {keys[child]} AS own FROM g2_{child}"
            for child, column, parent in references
        ),
        "gone_walk": """
SELECT 'clients' AS tbl, id_client AS id, site FROM g2_clients WHERE pays = '7'
UNION SELECT 'fournisseurs', id_fournisseur, site FROM g2_fournisseurs WHERE id_fournisseur = 5
UNION SELECT n.child, n.own, n.site FROM gone_walk w JOIN naming n ON n.parent = w.tbl AND n.named = w.id AND n.site = w.site""",
    }
    for t, k in keys.items():
        views[f"p_{t}"] = f"SELECT * FROM g2_{t} WHERE (site, {k}) NOT IN (SELECT (site, id) FROM gone_walk WHERE tbl = '{t}')"
    return _sql(_digest("p", False), views)


def _recategorized() -> str:
    """Lines by the new categories; orders and clients as those lines name them; what else was there stays, and
    parents of what came are there too."""
    category = "CASE id_categorie WHEN 9 THEN 35 WHEN 35 THEN 50 WHEN 50 THEN 9 ELSE id_categorie END"
    views = {
        "nouveaux": f"SELECT * REPLACE ({category} AS id_categorie) FROM produits",
        "h_lignes": VIEWS["g1_lignes"].replace("JOIN produits p", "JOIN nouveaux p"),
        "h_commandes": _parents("commandes", "h_lignes", "id_commande"),
        "h_clients": _parents("clients", "h_commandes", "id_client"),
        "h_employes": f"SELECT * FROM g1_employes UNION {_parents('employes', 'h_commandes', 'id_employe').replace('UNION ALL', 'UNION')}",
        "tenus": f"SELECT id_produit, id_fournisseur, {category} AS id_categorie, site FROM g1_produits",
        "h_produits": "SELECT * FROM tenus UNION SELECT DISTINCT p.id_produit, p.id_fournisseur, p.id_categorie, l.site "
        "FROM nouveaux p JOIN h_lignes l ON l.id_produit = p.id_produit",
        "h_fournisseurs": f"SELECT * FROM g1_fournisseurs UNION {_parents('fournisseurs', 'h_produits', 'id_fournisseur').replace('UNION ALL', 'UNION')}",
        "h_categories": f"SELECT * FROM g1_categories UNION {_parents('categories', 'h_produits', 'id_categorie').replace('UNION ALL', 'UNION')}",
    }
    return _sql(_digest("h", True), views)


def _replicas() -> str:
    views = {f"q_{t}": f"SELECT *, 1 AS site FROM {t} UNION ALL SELECT *, 2 AS site FROM {t}" for t in _TABLES}
    views["q_lignes"] = "SELECT * FROM g1_lignes"
    return _sql(_digest("q", False), views)


def oracle_sql() -> dict[str, str]:
    deletes = (_delete("1"), _delete("2"))
    pieces = """SELECT c.id_categorie, c.nom_categorie, CAST(sum(l.quantite) AS BIGINT) AS pieces
FROM lignes l JOIN produits p ON p.id_produit = l.id_produit JOIN categories c ON c.id_categorie = p.id_categorie
GROUP BY c.id_categorie, c.nom_categorie"""
    dated = f"SELECT id_commande, id_client, date_commande FROM commandes WHERE {_YEAR}"
    counted = f"SELECT id_client, count(*) AS nb_commandes FROM commandes WHERE {_YEAR} GROUP BY id_client"
    counts = " UNION ALL ".join(
        f"SELECT '{'lignes_commandes' if t == 'lignes' else t}' AS tbl, CAST(site AS INTEGER) AS site, count(*) AS nb FROM {{0}}_{t} GROUP BY site"
        for t in [*_TABLES, "lignes"]
    )
    checks = {
        "load_global": _sql(
            """SELECT 'fournisseurs' AS tbl, id_fournisseur AS id, CAST(0 AS BIGINT) AS ref1, CAST(0 AS BIGINT) AS ref2,
       societe_fournisseur AS txt, CAST(0 AS DOUBLE) AS amount FROM fournisseurs
UNION ALL SELECT 'categories', id_categorie, 0, 0, nom_categorie, 0 FROM categories
UNION ALL SELECT 'employes', id_employe, 0, 0, nom, 0 FROM employes
UNION ALL SELECT 'clients', id_client, 0, 0, societe || '/' || fonction || '/' || pays, 0 FROM clients
UNION ALL SELECT 'produits', id_produit, coalesce(id_fournisseur, 0), id_categorie, designation, CAST(prix_unitaire AS DOUBLE) FROM produits
UNION ALL SELECT 'commandes', id_commande, id_employe, id_client,
       concat_ws('/', strftime(date_commande, '%Y-%m-%d'), strftime(date_livraison, '%Y-%m-%d')), 0 FROM commandes
UNION ALL SELECT 'lignes_commandes', id_ligne_commande, id_commande, id_produit, CAST(quantite AS VARCHAR), CAST(remise AS DOUBLE) FROM lignes"""
        ),
        "seed_ingest": """
SELECT o_orderkey AS id_commande,
       CASE WHEN bad = '' AND o_orderpriority <> '3-MEDIUM' THEN CAST(substr(o_orderpriority, 1, 1) AS BIGINT) ELSE -1 END AS id_employe,
       CASE WHEN bad = '' THEN o_custkey ELSE -1 END AS id_client,
       CASE WHEN o_orderpriority = '5-LOW' THEN '31/02/' || year(o_orderdate)
            WHEN bad = '' THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(o_orderdate, '%d/%m/%Y') END AS date_commande,
       CASE WHEN bad = '' THEN CAST(floor(o_totalprice / 1000) AS BIGINT) + 1 ELSE -1 END AS frais_port,
       bad AS bad_columns
FROM (SELECT *, CASE o_orderpriority WHEN '2-HIGH' THEN 'id_client' WHEN '5-LOW' THEN 'date_commande' ELSE '' END AS bad FROM orders)""",
        "assign_surrogate_key": "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS id, o_orderkey FROM orders",
        "fragment_write": _sql(_digest("g1", True)),
        "fragment_read": _sql(_digest("g2", False, site="0", only="site = 1")),
        "full_replica_load": _replicas(),
        "route_by_query": _sql(
            f"SELECT id_ligne_commande, CAST({_by_query('quantite', 'p.id_categorie')} AS INTEGER) AS site "
            "FROM lignes l LEFT JOIN produits p ON p.id_produit = l.id_produit"
        ),
        "route_by_volume": _sql(f"SELECT id_ligne_commande, CAST({_by_volume('quantite')} AS INTEGER) AS site FROM lignes"),
        "filter_year_extract": _sql(dated.replace(_YEAR, "extract(YEAR FROM date_commande) = 1998")),
        "filter_date_range": _sql(dated),
        "filter_in_or": _sql(
            "SELECT id_produit, id_categorie, id_fournisseur FROM produits WHERE id_categorie IN (50, 35) OR id_fournisseur = 7"
        ),
        "project_tagged": _sql(
            """SELECT 'GLOBAL' AS db, id_ligne_commande, id_produit, quantite FROM lignes
UNION ALL SELECT 'SITE_' || site, id_ligne_commande, id_produit, quantite FROM g2_lignes"""
        ),
        "guard_changed_columns": _sql(f"SELECT seq, op, id_ligne_commande FROM feed WHERE {_FIRES_1}"),
        "join_line_product": _sql(
            """SELECT l.id_ligne_commande, l.id_produit, p.id_categorie, CAST(p.prix_unitaire AS DOUBLE) AS prix_unitaire
FROM lignes l JOIN produits p ON p.id_produit = l.id_produit"""
        ),
        "join_line_order": _sql(
            """SELECT l.id_ligne_commande, c.id_client, c.date_commande FROM lignes l
JOIN commandes c ON c.id_commande = l.id_commande"""
        ),
        "join_order_client": _sql(
            "SELECT o.id_commande, o.id_client, c.societe FROM commandes o JOIN clients c ON c.id_client = o.id_client"
        ),
        "join_category_rollup": _sql(pieces),
        "line_detail_star": _sql(
            f"""SELECT l.id_ligne_commande, l.id_commande, l.id_produit, l.quantite, CAST(l.remise AS DOUBLE) AS remise,
       c.id_employe, c.id_client, c.date_commande, c.date_livraison, p.designation,
       coalesce(p.id_fournisseur, 0) AS id_fournisseur, p.id_categorie, CAST(p.prix_unitaire AS DOUBLE) AS prix_unitaire, p.indisponible
FROM lignes l JOIN produits p ON p.id_produit = l.id_produit JOIN commandes c ON c.id_commande = l.id_commande WHERE {_YEAR}"""
        ),
        "semi_join_in": _sql(
            """SELECT id_client, societe FROM clients WHERE id_client IN (SELECT id_client FROM commandes WHERE id_commande IN
(SELECT id_commande FROM lignes WHERE quantite > 40 AND id_produit IN (SELECT id_produit FROM produits WHERE id_categorie = 50)))"""
        ),
        "anti_join_not_exists": _missing(),
        "lookup_or_null": _sql(
            """SELECT l.id_ligne_commande, coalesce(p.id_categorie, -1) AS id_categorie FROM lignes l
LEFT JOIN produits p ON p.id_produit = l.id_produit AND p.prix_unitaire < 1000"""
        ),
        "dedupe_rows": _sql("SELECT DISTINCT id_employe, id_client FROM commandes"),
        "orders_per_client": _sql(counted),
        "orders_per_client_extract": _sql(counted.replace(_YEAR, "extract(YEAR FROM date_commande) = 1998")),
        "orders_per_client_named": _sql(
            f"""SELECT o.id_client, c.societe, count(o.id_commande) AS nb_commandes FROM commandes o
JOIN clients c ON c.id_client = o.id_client WHERE {_YEAR} GROUP BY o.id_client, c.societe"""
        ),
        "revenue_by_category_abs": _revenue(
            "g1", "sum(CAST(l.quantite AS DECIMAL(10,0)) * p.prix_unitaire - l.remise)", "g1_produits"
        ),
        "revenue_by_category_rate": _revenue(
            "g2", "round(sum(CAST(l.quantite AS DECIMAL(10,0)) * p.prix_unitaire * (1 - l.remise)), 2)", "produits"
        ),
        "revenue_kept_up": _revenue(
            "z1", "sum(CAST(l.quantite AS DECIMAL(10,0)) * p.prix_unitaire - l.remise)", "z1_produits"
        ),
        "sum_two_level": _sql("SELECT id_produit, CAST(sum(quantite) AS BIGINT) AS quantite FROM g2_lignes GROUP BY id_produit"),
        "count_existence": _sql(
            """SELECT id_commande, id_commande IN (SELECT id_commande FROM g2_lignes WHERE site = 1) AS on_site_1,
       id_commande IN (SELECT id_commande FROM g2_lignes WHERE site = 2) AS on_site_2 FROM commandes"""
        ),
        "sort_desc": _sql(pieces + " ORDER BY pieces DESC NULLS FIRST"),
        "union_all_sites": _sql(
            """SELECT id_ligne_commande, id_produit, quantite, CAST(remise AS DOUBLE) AS remise FROM g1_lignes WHERE site = 1
UNION ALL SELECT id_ligne_commande, id_produit, quantite, CAST(remise AS DOUBLE) FROM g1_lignes WHERE site = 2"""
        ),
        "reconstruct_global": _sql(f"SELECT {_LINE_COLUMNS} FROM lignes"),
        "reconstruction_gaps": _sql(
            f"""SELECT {_LINE_COLUMNS}, 'lost' AS gap FROM lignes
WHERE id_ligne_commande NOT IN (SELECT id_ligne_commande FROM g1_lignes)"""
        ),
        "scalar_functions": _sql(
            """SELECT l.id_ligne_commande, date_commande AS parsed_day, date_commande AS parsed_iso,
       CAST(extract(YEAR FROM date_commande) AS BIGINT) AS annee,
       CAST(round(CAST(quantite AS DECIMAL(10,0)) * CAST(prix_unitaire AS DECIMAL(12,4)) * (1 - remise), 2) AS DOUBLE) AS net_rate,
       CAST(CAST(quantite AS DECIMAL(10,0)) * CAST(prix_unitaire AS DECIMAL(12,4)) - remise AS DOUBLE) AS net_absolute,
       coalesce(CASE WHEN quantite > 25 THEN quantite END, -1) AS nvl_quantite,
       CAST(date_diff('day', CAST(date_commande AS DATE), DATE '2002-01-01') AS BIGINT) AS age_days,
       date_commande < TIMESTAMP '2002-01-01' - INTERVAL 365 DAY AS older_than_year,
       'FAILED: Ligne Commande ID ' || l.id_ligne_commande || ' not found.' AS message
FROM lignes l JOIN commandes c ON c.id_commande = l.id_commande JOIN produits p ON p.id_produit = l.id_produit"""
        ),
        "route_inserts": _actions("op = 'I'"),
        "route_deletes": _actions("op = 'D'"),
        "classify_transitions": _sql(
            _both(
                *[
                    f"SELECT seq, CAST(old_site AS INTEGER) AS old_site, CAST(new_site AS INTEGER) AS new_site, kind FROM k{s} WHERE op = 'U'"
                    for s in "12"
                ]
            )
        ),
        "transition_summary": _sql(
            _both(
                *[
                    f"SELECT CAST(old_site AS INTEGER) AS old_site, CAST(new_site AS INTEGER) AS new_site, count(*) AS nb "
                    f"FROM k{s} WHERE op = 'U' GROUP BY old_site, new_site"
                    for s in "12"
                ]
            )
        ),
        "compact_changes": _compact(),
        "tied_orders": _sql("SELECT node AS id_commande, min(vu) AS groupe FROM liens_walk GROUP BY node"),
        "capture_changes": _capture("base", "ensuite"),
        "capture_versions": _capture("base", "after1"),
        "capture_applied": _sql(f"SELECT {_LINE_COLUMNS} FROM after1"),
        "seed_scripts": """
SELECT 'clients' AS tbl, c_custkey AS id, c_name || '|' || c_name || chr(39) || 's; desk' || chr(10) || '(;' || c_custkey || '|' ||
       CASE WHEN c_nationkey = 5 THEN '-' ELSE c_mktsegment END || '|' || c_nationkey || '|2020-03-' || lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS txt
FROM customer WHERE c_nationkey NOT IN (3, 4)
UNION ALL
SELECT 'refused', 0, CASE c_nationkey WHEN 3 THEN 'not one value for each column|' ELSE 'does not fit: date_naissance|' END || c_name
FROM customer WHERE c_nationkey IN (3, 4)
UNION ALL
SELECT 'fournisseurs', row_number() OVER (ORDER BY s_suppkey), s_name || '|' || s_name || '|-' FROM supplier""",
        "numbered_loads": """
SELECT 1 AS run, 'even' AS load, c_custkey, row_number() OVER (ORDER BY c_custkey) AS id_client FROM customer WHERE c_nationkey % 2 = 0
UNION ALL
SELECT 2, 'odd', c_custkey, row_number() OVER (ORDER BY c_custkey) + (SELECT count(*) FROM customer WHERE c_nationkey % 2 = 0)
FROM customer WHERE c_nationkey % 2 = 1
UNION ALL
SELECT 3, 'even', c_custkey, row_number() OVER (ORDER BY c_custkey) FROM customer WHERE c_nationkey % 2 = 0""",
        "validate_line_inputs": _sql(
            f"""SELECT seq, step, action, CASE WHEN action = 'INSERT' AND {_BAD_INPUT} THEN -20001
WHEN action = 'UPDATE' AND (coalesce(quantite, 1) <= 0 OR coalesce(remise, 0) < 0) THEN -20008 ELSE 0 END AS error_code FROM a2"""
        ),
        "insert_lines_hydrating": _sql(_insert("1")[1], _insert("1")[0]),
        "insert_lines_strict": _sql(_insert("2")[1], _insert("2")[0]),
        "update_lines_hydrating": _sql(_update("1")[1], _update("1")[0]),
        "update_lines_strict": _sql(_update("2")[1], _update("2")[0]),
        "delete_lines_cascade": _sql(_both(*deletes)),
        "apply_change_batch_s1": _sql(_digest("z1", True, "f1_bad")),
        "replay_changes_s2": _sql(_digest("y2", False, "y2_bad")),
        "replicate_parents": _replicated(),
        "purge_by_keys": _purged(),
        "purge_closure": _closed(),
        "apply_changes_global": _sql(f"SELECT {_LINE_COLUMNS} FROM after1"),
        "check_domain": _domain(),
        "check_primary_key": _primary_keys(),
        "check_foreign_key": _foreign_keys(),
        "rejection_report": _rejections(),
        "audit_placement": _sql(
            """SELECT coalesce(e.id_ligne_commande, a.id_ligne_commande) AS id_ligne_commande,
       CAST(coalesce(e.site, 0) AS INTEGER) AS expected, CAST(coalesce(a.site, 0) AS INTEGER) AS actual
FROM v1_lignes e FULL JOIN b1_lignes a ON a.id_ligne_commande = e.id_ligne_commande
WHERE coalesce(e.site, 0) <> coalesce(a.site, 0)""",
            {
                "unchecked": """
SELECT * FROM base WHERE id_ligne_commande NOT IN (SELECT id_ligne_commande FROM feed)
UNION ALL
SELECT id_ligne_commande, id_commande, new_id_produit, new_quantite, new_remise FROM feed WHERE op <> 'D'""",
                "v1_lignes": VIEWS["g1_lignes"].replace("FROM lignes l", "FROM unchecked l"),
            },
        ),
        "change_categories": _recategorized(),
        "site_counts": _sql(_both(counts.format("g1"), counts.format("g2"))),
        "stream_route_changes": _actions("TRUE"),
        "stream_apply_changes": _sql(_digest("z1", True, "f1_bad")),
        "stream_replay_ordered": _sql(
            _digest("y2", False, "y2_bad")
            + " UNION ALL SELECT 'late', 0, seq, 0, 0, 0, 0 FROM feed WHERE op = 'U' AND old_remise IS DISTINCT FROM new_remise"
        ),
        "layout_orders_by_year": _sql(dated),
    }
    for scenario in "12":
        for english, table in (
            ("lines", "lignes"),
            ("orders", "commandes"),
            ("clients", "clients"),
            ("employees", "employes"),
            ("products", "produits"),
            ("suppliers", "fournisseurs"),
            ("categories", "categories"),
        ):
            checks[f"s{scenario}_fragment_{english}"] = _fragment(f"g{scenario}", table)
    return checks
