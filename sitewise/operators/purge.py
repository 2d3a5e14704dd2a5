"""Deleting rows together with everything that names them."""

from __future__ import annotations

from pyspark.sql import DataFrame

from sitewise.operators.fragments import union_sites
from sitewise.schema import KEYS, references_of
from sitewise.session import settle
from sitewise.sources.snapshots import Frags
from sitewise.sources.tables import Tables


def parents_first(tables: Tables | Frags) -> list[str]:
    """The tables, each after all that it refers to; children are deleted in the reverse order."""
    needs = {name: {parent for child, _, parent in references_of(tables) if child == name} for name in tables}
    order: list[str] = []
    while len(order) < len(needs):
        ready = sorted(name for name, on in needs.items() if name not in order and on <= set(order))
        if not ready:
            raise ValueError("the tables refer to each other in a circle")
        order += ready
    return order


def closure(tables: Tables | Frags, keys: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Per table, the (site and) key of every row that goes with the given ones, children first. Stored.

    ``keys`` names rows of any tables (table → DataFrame of ids, on every site). A row goes if it is named or
    if a reference of it, at its own site, names a row that goes. Rows that name nothing stay. What is
    looked up in a table is as large as what goes from its parents.
    """
    unknown = set(keys) - set(tables)
    if unknown:
        raise ValueError(f"no such table: {sorted(unknown)}")
    sites = ["site"] if "site" in tables["lignes_commandes"].columns else []
    gone: dict[str, DataFrame] = {}
    for name in parents_first(tables):
        key, parts = KEYS[name], []
        if name in keys:
            parts.append(tables[name].join(keys[name].select(key).distinct(), key, "left_semi").select(*sites, key))
        for child, column, parent in references_of(tables):
            if child == name and parent in gone:
                going = gone[parent].withColumnRenamed(KEYS[parent], column)
                parts.append(tables[name].join(going, [*sites, column], "left_semi").select(*sites, key))
        if parts:
            gone[name] = settle(union_sites(parts).distinct())
    return dict(reversed(gone.items()))


def purge_closure(tables: Tables | Frags, keys: dict[str, DataFrame]) -> Tables | Frags:
    """The tables without the rows that ``closure`` finds; no reference is left that names one of them."""
    gone = closure(tables, keys)
    return {name: df.join(gone[name], gone[name].columns, "left_anti") if name in gone else df for name, df in tables.items()}
