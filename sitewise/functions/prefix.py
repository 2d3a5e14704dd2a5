"""Running totals and row numbers that survive a hot group.

A window over a key sorts one group in one task. That is right while groups are
small. Where some group holds more than ``hot_rows`` rows, the rows of those groups
are range-partitioned by (key, order) instead: each chunk is totalled on its own,
the chunk totals (at most one row per chunk and key) give every chunk its offset,
and both add up to the exact running total.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from sitewise.session import settle

HOT_ROWS = 5_000_000

_CHUNK = "_chunk"
_TIE = "_tie"
_POSITION = "_position"
_LOCAL = "_local_"


def _ranged(df: DataFrame, keys: list[str], order: list[str], rows: int, hot_rows: int) -> DataFrame:
    """The rows ranged by (key, order) and sorted, with their chunk and position, settled.

    The bounds are sampled, so the chunk of a row is settled before it is used twice.
    """
    chunks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-2 * rows // hot_rows))
    # Equal rows must be able to fall into different chunks, hence the tie breaker.
    return settle(
        df.withColumn(_TIE, F.monotonically_increasing_id())
        .repartitionByRange(chunks, *keys, *order, _TIE)
        .sortWithinPartitions(*keys, *order, _TIE)
        .withColumn(_CHUNK, F.spark_partition_id())
        .withColumn(_POSITION, F.monotonically_increasing_id())
        .drop(_TIE)
    )


def _before(keys: list[str], name: str) -> Column:
    """Total of a key's earlier chunks; a key has at most one row per chunk here.

    As rows are ranged by key, (key, chunk) pairs are at most the chunks and the hot keys
    together, a handful for every ``hot_rows`` rows; how they are joined is left to Spark.
    """
    earlier = W.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(W.unboundedPreceding, -1)
    return F.sum(name).over(earlier)


def _same(left: str, right: str, keys: list[str]) -> Column:
    """Equal keys; NULL is a key like any other."""
    equal = F.lit(True)
    for key in keys:
        equal = equal & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return equal


def _chunked_sums(ranged: DataFrame, keys: list[str], sums: dict[str, str], columns: list[str]) -> DataFrame:
    within = W.partitionBy(*keys, _CHUNK).orderBy(_POSITION).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = ranged.select("*", *[F.sum(source).over(within).alias(_LOCAL + name) for name, source in sums.items()])
    totals = ranged.groupBy(*keys, _CHUNK).agg(*[F.sum(source).alias(name) for name, source in sums.items()])
    # A handful of rows, which is known once they are stored: then the chunks stay where they are.
    offsets = settle(totals.select(*keys, _CHUNK, *[_before(keys, name).alias(name) for name in sums]))
    met = local.alias("l").join(offsets.alias("o"), _same("l", "o", [*keys, _CHUNK]))

    def total(name: str) -> Column:
        """NULL until the first value, as over a plain window."""
        before, within = F.col(f"o.{name}"), F.col(f"l.{_LOCAL}{name}")
        return F.coalesce(before + within, before, within).alias(name)

    return met.select(*[F.col(f"l.{c}") for c in columns], *[total(name) for name in sums])


def _chunked_numbers(ranged: DataFrame, keys: list[str], name: str, columns: list[str]) -> DataFrame:
    """Row numbers need no second shuffle of the rows: a position within a chunk is one already."""
    totals = ranged.groupBy(*keys, _CHUNK).agg(F.min(_POSITION).alias("_start"), F.count(F.lit(1)).alias("_n"))
    offsets = settle(totals.select(*keys, _CHUNK, "_start", F.coalesce(_before(keys, "_n"), F.lit(0)).alias("_offset")))
    number = F.col("o._offset") + F.col(f"l.{_POSITION}") - F.col("o._start") + 1
    met = ranged.alias("l").join(offsets.alias("o"), _same("l", "o", [*keys, _CHUNK]))
    return met.select(*[F.col(f"l.{c}") for c in columns], number.alias(name))


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    sums: dict[str, str],
    hot_rows: int = HOT_ROWS,
    known_small: bool = False,
) -> DataFrame:
    """Adds inclusive running totals ``{new column: summed column}`` per key, in order.

    ``order`` must rank the rows of a key fully, up to rows that are equal in every
    summed column. NULL is a key like any other, and a NULL value adds nothing. A caller that has already checked that
    no group is above ``hot_rows`` says so with ``known_small``.
    """
    window = W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.select("*", *[F.sum(source).over(window).alias(name) for name, source in sums.items()])

    def chunked(ranged: DataFrame) -> DataFrame:
        return _chunked_sums(ranged, list(keys), sums, df.columns)

    return _by_size(df, list(keys), list(order), plain, chunked, hot_rows, known_small)


def _by_size(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    plain: Callable[[DataFrame], DataFrame],
    chunked: Callable[[DataFrame], DataFrame],
    hot_rows: int,
    known_small: bool,
) -> DataFrame:
    """Small groups one way, hot groups the other."""
    if not keys:
        df = settle(df)  # counted, sampled and dealt out: worked out once
        return chunked(_ranged(df, keys, order, df.count(), hot_rows))
    if known_small:
        return plain(df)
    hot_groups = find_hot(df, keys, hot_rows)
    hot_total = hot_groups.agg(F.sum("n")).first()[0]
    if not hot_total:
        return plain(df)
    hot_groups = settle(hot_groups)
    rows, found = df.alias("l"), hot_groups.alias("o")
    hot = rows.join(found, _same("l", "o", keys), "left_semi")
    rest = rows.join(found, _same("l", "o", keys), "left_anti")
    return plain(rest).unionByName(chunked(_ranged(hot, keys, order, hot_total, hot_rows)))


def find_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Groups of more than ``hot_rows`` rows, with their size. Counted with map-side totals."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot_rows)


def row_numbers(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    name: str,
    hot_rows: int = HOT_ROWS,
    known_small: bool = False,
) -> DataFrame:
    """Adds 1, 2, 3 … per key (over all rows where there is no key)."""
    window = W.partitionBy(*keys).orderBy(*order)

    def plain(rows: DataFrame) -> DataFrame:
        return rows.withColumn(name, F.row_number().over(window).cast("bigint"))

    def chunked(ranged: DataFrame) -> DataFrame:
        return _chunked_numbers(ranged, list(keys), name, df.columns)

    return _by_size(df, list(keys), list(order), plain, chunked, hot_rows, known_small)
