"""Typed rows from raw text rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.functions.columns import blank_to_null, parse_day


def _whole(text: Column, dtype: T.DataType) -> Column:
    """Whether a number keeps all its decimals in the column; true for what is no number."""
    decimals = F.char_length(F.rtrim(F.regexp_extract(text, r"^[-+]?[0-9]*\.([0-9]+)$", 1), F.lit("0")))
    scale = dtype.scale if isinstance(dtype, T.DecimalType) else 0 if isinstance(dtype, (T.LongType, T.IntegerType)) else 1_000
    return decimals <= scale


def _typed(text: Column, dtype: T.DataType, day_pattern: str) -> Column:
    if isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampNTZType):
        if "H" in day_pattern:
            return F.try_to_timestamp(text, F.lit(day_pattern)).cast(dtype)
        return parse_day(text, day_pattern)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        # Through a decimal: a fraction is rounded half up, not refused.
        return text.try_cast("decimal(38,6)").try_cast("decimal(38,0)").try_cast(dtype)
    return text.try_cast(dtype)


def seed_ingest(
    raw: DataFrame, schema: T.StructType, day_pattern: str = "d/M/yyyy", exact: bool = False, carry: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Split raw text rows into typed rows and rows that do not convert.

    Numbers may be quoted text, days are ``DD/MM/YYYY``, a blank is a missing value.
    A bad row keeps its raw text and names the columns at fault in ``bad_columns``. A number with more
    decimals than its column is rounded half up; with ``exact`` it is at fault. ``carry`` names columns of the
    rows that go along unread.
    """
    fields = [field for field in schema.fields if field.name in raw.columns]
    clean = raw.select(*carry, *[blank_to_null(F.trim(F.col(f.name))).alias(f.name) for f in fields])

    def typed_value(f: T.StructField) -> Column:
        value = _typed(F.col(f.name), f.dataType, day_pattern)
        return (F.when(_whole(F.col(f.name), f.dataType), value) if exact else value).alias(f.name)

    typed = clean.select(
        *carry,
        F.struct(*[F.col(f.name) for f in fields]).alias("raw"),
        F.struct(*[typed_value(f) for f in fields]).alias("typed"),
    )
    faults = F.array_compact(
        F.array(
            *[
                F.when(F.col(f"raw.{f.name}").isNotNull() & F.col(f"typed.{f.name}").isNull(), F.lit(f.name))
                for f in fields
            ]
        )
    )
    judged = typed.withColumn("faults", faults)
    good = judged.where(F.size("faults") == 0).select(*carry, "typed.*")
    bad = judged.where(F.size("faults") > 0).select(*carry, "raw.*", F.concat_ws(",", "faults").alias("bad_columns"))
    return good, bad
