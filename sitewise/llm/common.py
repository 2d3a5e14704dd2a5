"""Helpers that several operators use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The white space of the word rule [^\x20\x09-\x0D]+, as text for translate() and as a pattern.
BLANKS = " \t\n\x0b\f\r"
BLANK_PATTERN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: Column) -> Column:
    """The text, empty where there is none."""
    return F.coalesce(text, F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, whatever the optimizer merges."""
    return F.transform(F.array(value), body)[0]


def parts(df: DataFrame, rows: int, rows_per_part: int, least: int = 1) -> int:
    """Partitions for so many rows: grows with the rows, at least one for each core slot."""
    slots = df.sparkSession.sparkContext.defaultParallelism
    return max(least, slots, -(-rows // rows_per_part))


def plain(dtype: T.DataType) -> str:
    return dtype.simpleString()


def free_name(columns: Sequence[str], name: str) -> str:
    """``name`` with as many underscores before it as it takes to be none of the columns, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name
