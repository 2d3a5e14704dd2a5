"""Small relational helpers shared by the operators.

None of them forces a join strategy. Existence tests reduce their right side to
distinct keys first, so that a hot key arrives once per map task and not once per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _on(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def semi(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows with a partner (IN / EXISTS)."""
    keys = _on(on)
    return df.join(other.select(*keys).distinct(), keys, "left_semi")


def anti(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Rows without a partner (NOT EXISTS)."""
    keys = _on(on)
    return df.join(other.select(*keys).distinct(), keys, "left_anti")


def lookup(df: DataFrame, dim: DataFrame, on: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """Columns of a unique-key table; NULL where there is no such key."""
    keys = _on(on)
    return df.join(dim.select(*keys, *cols), keys, "left")


def exists_flag(
    df: DataFrame, other: DataFrame, on: str | Sequence[str], name: str, unique: bool = False
) -> DataFrame:
    """Adds whether a row has a partner. ``unique``: the keys of ``other`` are known to be so."""
    keys = _on(on)
    partners = other.select(*keys) if unique else other.select(*keys).distinct()
    marked = partners.withColumn(name, F.lit(True))
    return df.join(marked, keys, "left").withColumn(name, F.coalesce(F.col(name), F.lit(False)))


def dedupe(df: DataFrame) -> DataFrame:
    return df.distinct()


def sort_desc(df: DataFrame, column: str) -> DataFrame:
    """Largest first; missing values come before all others."""
    return df.orderBy(F.desc_nulls_first(column))


def tagged(df: DataFrame, tag: str | Column, cols: Sequence[str], name: str = "db") -> DataFrame:
    """Some columns and a tag that names the origin."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    return df.select(tag.alias(name), *cols)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the columns of a schema; those the input lacks are NULL."""
    have = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f.name if f.name in have else 'NULL'} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schema.fields
        ]
    )
