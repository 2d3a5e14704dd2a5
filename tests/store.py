"""Small literal stores, and the same store run one row at a time in plain Python."""

from __future__ import annotations

import copy
import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from sitewise.schema import CHANGES, KEYS, SCHEMAS

DAY = dt.datetime(2026, 3, 1)


def frame(spark: SparkSession, rows: list[dict], schema: T.StructType) -> DataFrame:
    columns = {name: [row.get(name) for row in rows] for name in schema.names}
    return spark.createDataFrame(pa.table(columns, schema=to_arrow_schema(schema)), schema)


def make_tables(spark: SparkSession, **rows: list[dict]) -> dict[str, DataFrame]:
    return {name: frame(spark, rows.get(name, []), schema) for name, schema in SCHEMAS.items()}


def site_schema(name: str, client: bool) -> T.StructType:
    fields = list(SCHEMAS[name].fields)
    if name == "lignes_commandes" and client:
        fields.append(T.StructField("id_client", T.LongType()))
    return T.StructType([*fields, T.StructField("site", T.IntegerType())])


def make_frags(spark: SparkSession, client: bool, **rows: list[dict]) -> dict[str, DataFrame]:
    return {name: frame(spark, rows.get(name, []), site_schema(name, client)) for name in SCHEMAS}


def line(i, order, product, quantity, discount) -> dict:
    return {
        "id_ligne_commande": i,
        "id_commande": order,
        "id_produit": product,
        "quantite": quantity,
        "remise": None if discount is None else Decimal(str(discount)),
    }


def product(i, category, supplier=1, price="10.0000") -> dict:
    return {"id_produit": i, "id_categorie": category, "id_fournisseur": supplier, "prix_unitaire": Decimal(price)}


def order(i, client=1, employee=1, date=DAY) -> dict:
    return {"id_commande": i, "id_client": client, "id_employe": employee, "date_commande": date}


def client(i) -> dict:
    return {"id_client": i, "societe": f"c{i}", "contact": "x", "fonction": "y"}


def change(seq, op, old: dict | None, new: dict | None) -> dict:
    one = new or old
    row = {"seq": seq, "op": op, "id_ligne_commande": one["id_ligne_commande"], "id_commande": one["id_commande"]}
    for side, values in (("old", old), ("new", new)):
        for column in ("id_produit", "quantite", "remise"):
            row[f"{side}_{column}"] = values[column] if values else None
    return row


def feed(spark: SparkSession, rows: list[dict]) -> DataFrame:
    return frame(spark, rows, CHANGES)


def keys_at(frags: dict[str, DataFrame]) -> dict[str, set]:
    """Per table the (site, key) pairs; lines with their values."""
    found = {}
    for name, df in frags.items():
        if name == "lignes_commandes":
            columns = ["site", "id_ligne_commande", "id_commande", "id_produit", "quantite", "remise"]
            columns += [c for c in ("id_client",) if c in df.columns]
            rows = [tuple(r) for r in df.select(*columns).collect()]
        else:
            rows = [tuple(r) for r in df.select("site", KEYS[name]).collect()]
        assert len(rows) == len(set(rows)), f"{name} holds a row twice: {rows}"
        found[name] = set(rows)
    return found


class Refused(Exception):
    def __init__(self, code: int):
        self.code = code


class RowStore:
    """The global line table and two sites, changed one row at a time."""

    def __init__(self, rule: str, tables: dict[str, list[dict]], sites: dict[str, set]):
        self.rule = rule
        self.tables = {n: {r[KEYS[n]]: r for r in rows} for n, rows in tables.items()}
        for name in KEYS:
            self.tables.setdefault(name, {})
        self.lines = dict(self.tables["lignes_commandes"])
        self.sites = {s: {n: {} for n in KEYS} for s in (1, 2)}
        for name, found in sites.items():
            for row in found:
                if name == "lignes_commandes":
                    cols = ["site", "id_ligne_commande", "id_commande", "id_produit", "quantite", "remise", "id_client"]
                    held = dict(zip(cols, row))
                    self.sites[held.pop("site")][name][held["id_ligne_commande"]] = held
                else:
                    self.sites[row[0]][name][row[1]] = self.tables[name].get(row[1], {KEYS[name]: row[1]})
        self.refused: list[tuple[int, int]] = []

    def site_of(self, values: dict, old_site: int | None = None, update: bool = False) -> int:
        q = values["quantite"]
        if self.rule == "by_query":
            category = self.tables["produits"].get(values["id_produit"], {}).get("id_categorie")
            if q is not None and category == 50 and q > 100:
                return 1
            return 2 if q is not None and category == 35 and q > 50 else 0
        if not update:
            return 1 if q is not None and q >= 100 else 2
        if old_site == 1:
            return 1 if q is not None and q >= 100 else 2
        return 2 if q is not None and q < 100 else 1

    def hydrate(self, here: dict, table: str, key) -> None:
        if key in here[table]:
            return
        row = self.tables[table].get(key) if key is not None else None
        if row is None:
            raise Refused(-1403)
        for parent in {"commandes": ("clients", "employes"), "produits": ("fournisseurs", "categories")}.get(table, ()):
            self.hydrate(here, parent, row.get(KEYS[parent]))
        here[table][key] = row

    def insert(self, site: int, new: dict) -> None:
        here, strict = self.sites[site], self.rule == "by_volume"
        numbers = [new[c] for c in ("quantite", "id_ligne_commande", "id_commande", "id_produit")]
        if any(n is not None and n <= 0 for n in numbers) or (new["remise"] is not None and new["remise"] < 0):
            raise Refused(-20001)
        if new["id_ligne_commande"] in here["lignes_commandes"]:
            raise Refused(-20002)
        if strict:
            if new["id_commande"] not in here["commandes"]:
                raise Refused(-20003)
            if new["id_produit"] not in here["produits"]:
                raise Refused(-20004)
        else:
            self.hydrate(here, "commandes", new["id_commande"])
            self.hydrate(here, "produits", new["id_produit"])
        held = dict(new)
        if not strict:
            held["id_client"] = here["commandes"][new["id_commande"]].get("id_client")
        here["lignes_commandes"][new["id_ligne_commande"]] = held

    def delete(self, site: int, i: int) -> None:
        here = self.sites[site]
        if i not in here["lignes_commandes"]:
            if self.rule == "by_volume":
                raise Refused(-20005)
            return
        number = here["lignes_commandes"].pop(i)["id_commande"]
        if any(r["id_commande"] == number for r in here["lignes_commandes"].values()):
            return
        buyer = here["commandes"].pop(number).get("id_client")
        if not any(r.get("id_client") == buyer for r in here["commandes"].values()) and buyer is not None:
            here["clients"].pop(buyer, None)

    def update(self, site: int, i: int, new: dict) -> None:
        here, strict = self.sites[site], self.rule == "by_volume"
        if i not in here["lignes_commandes"]:
            raise Refused(-20006)
        row = here["lignes_commandes"][i]
        if new["id_produit"] is not None:
            if strict and new["id_produit"] not in here["produits"]:
                raise Refused(-20007)
            if not strict:
                self.hydrate(here, "produits", new["id_produit"])
        if (new["quantite"] is not None and new["quantite"] <= 0) or (new["remise"] is not None and new["remise"] < 0):
            raise Refused(-20008)
        before = row["id_produit"]
        for column in ("id_produit", "quantite", "remise"):
            if new[column] is not None:
                row[column] = new[column]
        if not strict and before != row["id_produit"]:
            if not any(r["id_produit"] == before for r in here["lignes_commandes"].values()):
                here["produits"].pop(before, None)

    def change(self, c: dict) -> None:
        """One statement on the global table; refused as a whole or done as a whole."""
        i, op = c["id_ligne_commande"], c["op"]
        if op != "I" and i not in self.lines:
            return
        kept = copy.deepcopy((self.lines, self.sites))
        new = {"id_ligne_commande": i, "id_commande": c["id_commande"]}
        new |= {v: c[f"new_{v}"] for v in ("id_produit", "quantite", "remise")}
        old = self.lines.get(i)
        try:
            if op == "I" and old is not None:
                raise Refused(-1)
            self.react(op, i, old, new)
            if op == "D":
                del self.lines[i]
            else:
                orders, products = self.tables["commandes"], self.tables["produits"]
                if (new["id_commande"] is not None and new["id_commande"] not in orders) or (
                    new["id_produit"] is not None and new["id_produit"] not in products
                ):
                    raise Refused(-2291)
                self.lines[i] = new
        except Refused as refused:
            self.lines, self.sites = kept
            self.refused.append((c["seq"], refused.code))

    def react(self, op: str, i: int, old: dict | None, new: dict) -> None:
        if op == "I":
            if self.site_of(new):
                self.insert(self.site_of(new), new)
        elif op == "D":
            if self.site_of(old):
                self.delete(self.site_of(old), i)
        else:
            if all(old[c] == new[c] for c in ("id_produit", "quantite", "remise")):
                return
            was = self.site_of(old)
            now = self.site_of(new, was, update=True)
            if was and was == now:
                self.update(now, i, new)
            else:
                if was:
                    self.delete(was, i)
                if now:
                    self.insert(now, new)

    def state(self) -> dict[str, set]:
        found: dict[str, set] = {}
        cols = ["id_ligne_commande", "id_commande", "id_produit", "quantite", "remise"]
        cols += ["id_client"] if self.rule == "by_query" else []
        for name in KEYS:
            if name == "lignes_commandes":
                found[name] = {(s, *[r[c] for c in cols]) for s in (1, 2) for r in self.sites[s][name].values()}
            else:
                found[name] = {(s, key) for s in (1, 2) for key in self.sites[s][name]}
        return found
