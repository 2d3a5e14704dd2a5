"""Column expressions: dates, defaults, revenue, messages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def year_extract(column: Column, year: int) -> Column:
    """Calendar-year test on the extracted year; the scan cannot use it."""
    return F.year(column) == year


def year_range(column: Column, year: int) -> Column:
    """The same test as a half-open range, which reaches the Parquet scan."""
    start = F.lit(dt.datetime(year, 1, 1)).cast("timestamp_ntz")
    end = F.lit(dt.datetime(year + 1, 1, 1)).cast("timestamp_ntz")
    return (column >= start) & (column < end)


def parse_day(text: Column, pattern: str = "d/M/yyyy") -> Column:
    """Day text to a zone-free timestamp; NULL where the text is no such day."""
    return F.try_to_date(text, pattern).cast("timestamp_ntz")


def nvl(value: Column, default: Column) -> Column:
    return F.coalesce(value, default)


def blank_to_null(text: Column) -> Column:
    """An empty text counts as missing."""
    return F.when(text != "", text)


def units(quantity: Column) -> Column:
    """Quantity as an exact decimal: the widest whose product with a price and a discount keeps all its decimals."""
    return quantity.cast("decimal(13,0)")


def net_rate(quantity: Column, price: Column, discount: Column) -> Column:
    """Line revenue where the discount is a rate."""
    return units(quantity) * price * (F.lit(1).cast("decimal(1,0)") - discount)


def net_absolute(quantity: Column, price: Column, discount: Column) -> Column:
    """Line revenue where the discount is an amount."""
    return units(quantity) * price - discount


def error_message(code: Column, messages: dict[int, tuple[str, str | None, str]]) -> Column:
    """Text of an error code; some texts name the id at fault."""
    text = F.lit(None).cast("string")
    for value, (before, id_column, after) in messages.items():
        shown = F.lit(before) if id_column is None else F.concat(
            F.lit(before), F.coalesce(F.col(id_column).cast("string"), F.lit("")), F.lit(after)
        )
        text = F.when(code == value, shown).otherwise(text)
    return text
