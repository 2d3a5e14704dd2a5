"""Surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitewise.functions.prefix import HOT_ROWS, row_numbers


def assign_surrogate_key(
    df: DataFrame, within: Sequence[str], order_by: Sequence[str], name: str, start: int = 1, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Dense numbers from ``start``, in order; over all rows where ``within`` is empty.

    No step runs in a single task: rows are ranged over all partitions and numbered
    from per-partition offsets.
    """
    numbered = row_numbers(df, within, order_by, name, hot_rows)
    return numbered.withColumn(name, F.col(name) + F.lit(start - 1))
