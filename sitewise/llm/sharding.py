"""Sharding by sampled splitters.

Rows are ordered by a key (by default a hash of the text, so that copies lie side by
side) and cut into ranges of near equal bytes: a sample drawn in proportion to size
gives the boundaries, every row finds its range by binary search in them, and ranges
that turn out overfull are sampled again and subdivided. Exact totals per range then
give each row its place in the whole order, and equal stretches of bytes are the shards.

* Null texts count as empty, null ids sort first; an empty table gives no rows.
* Equal (key, id) pairs are told apart by a stored tie number, so a group of copies or
  one repeated row can be cut anywhere: no range has to hold a whole group.
* A row larger than a shard fills one alone (later shards may then stay empty).
* Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitewise.llm.common import parts, table, whole
from sitewise.session import settle

SAMPLES_PER_RANGE = 30
UNIT = float(2**53)


def _range_of(cuts: Sequence, point: Column, cut_type: str) -> Column:
    """How many cuts are at or below the point, by binary search."""
    if not cuts:
        return F.lit(0)
    literal = F.array(*[F.struct(*[F.lit(v) for v in cut]) for cut in cuts]).cast(f"array<{cut_type}>")
    steps, step = [], 1
    while step <= len(cuts):
        steps.insert(0, step)
        step *= 2

    def halve(at: Column, by: Column) -> Column:
        ahead = at + by
        return F.when((ahead <= len(cuts)) & (F.get(literal, ahead - 1) <= point), ahead).otherwise(at)

    return F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)


def _splitters(rows: DataFrame, total: int, wanted: int, seed: int) -> list[tuple]:
    """Quantiles of a sample in which a row's chance follows its size."""
    chance = F.col("size") * (wanted * SAMPLES_PER_RANGE / max(1, total))
    drawn = F.pmod(F.xxhash64("key", "doc_id", "tie", F.lit(seed)), F.lit(2**53)) / UNIT
    sample = rows.where(drawn < chance).select(F.struct("key", "doc_id", "tie").alias("point"))
    # One task orders the sample: its size is bounded by ranges x SAMPLES_PER_RANGE, not by the rows.
    numbered = sample.select("point", F.ntile(wanted).over(Window.orderBy("point")).alias("tile"))
    firsts = numbered.groupBy("tile").agg(F.min("point").alias("point")).where("tile > 1").select("point.*")
    return sorted((tuple(r) for r in firsts.collect()), key=lambda p: (p[0], p[1] is not None, p[1] if p[1] is not None else 0, p[2]))


def shard_rows(docs: DataFrame, n_shards: int = 40, rows_per_range: int = 1_000_000, key: Column | None = None) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row (see the module).

    Shard sizes differ by about one row's bytes. ``rows_per_range`` bounds what one task
    orders; the number of ranges, and with it the splitters, follows the rows.
    """
    text = whole(F.col("text"))
    slim = settle(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            (F.xxhash64(text) if key is None else key).alias("key"),
            F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
        )
    )
    rows, total = slim.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    wanted = parts(slim, rows, rows_per_range, least=4 * n_shards)
    cut_type = f"struct<key:{slim.schema['key'].dataType.simpleString()},doc_id:{slim.schema['doc_id'].dataType.simpleString()},tie:bigint>"
    point = F.struct("key", "doc_id", "tie")
    cuts = _splitters(slim, total, wanted, seed=1) if rows else []
    for seed in (2, 3):
        ranged = slim.withColumn("range", _range_of(cuts, point, cut_type))
        sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
        full = [r for r in sizes.where((F.col("n") > 2 * rows_per_range) | ((F.col("bytes") > 4 * total / wanted) & (F.col("n") > 4))).collect()]
        if not full:
            break
        for r in full:
            pieces = max(2, -(-r.n // rows_per_range), -(-r.bytes * wanted // max(1, total)))
            cuts = cuts + _splitters(ranged.where(F.col("range") == r.range), r.bytes, pieces, seed)
        cuts = sorted(set(cuts), key=lambda p: (p[0], p[1] is not None, p[1] if p[1] is not None else 0, p[2]))
    ranged = slim.withColumn("range", _range_of(cuts, point, cut_type))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # One row per range: bounded by the number of cuts.
    offsets = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes")).select(
        "range",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rows_before"),
        F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
    )
    inside = Window.partitionBy("range").orderBy("key", "doc_id", "tie")
    running = inside.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        ranged.withColumn("rn", F.row_number().over(inside))
        .withColumn("upto", F.sum("size").over(running))
        .join(offsets, "range")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rows_before") + F.col("rn") - 1).alias("place"),
            # The middle of the row decides: its shard is the stretch of bytes it lies in.
            F.least(
                F.floor(((F.col("bytes_before") + F.col("upto")) * 2 - F.col("size")) * n_shards / (2 * max(1, total))), F.lit(n_shards - 1)
            ).cast("int").alias("shard"),
        )
    )
    placed = settle(placed)
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first"))
    return placed.join(firsts, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("first")).alias("slot"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    shards = shard_rows(table(spark, sf_dir, "documents"), n_shards=40)
    return shards.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
