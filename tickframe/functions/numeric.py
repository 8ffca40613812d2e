"""Expressions on untrusted numbers, rounding and time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_int(cell: Column) -> Column:
    """A cell as an integer, truncated; 0 for junk and infinities."""
    x = cell.try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), 0).otherwise(x.cast("bigint")).cast("bigint")


def as_float(cell: Column) -> Column:
    return F.coalesce(cell.try_cast("double"), F.lit(0.0))


def to_ms(us: Column) -> Column:
    """Microseconds as milliseconds, halves to even."""
    return F.rint(us / 1000).cast("bigint")


def one_decimal(x: Column) -> Column:
    return F.format_string("%.1f", x)


def upper_median(values: Column) -> Column:
    """The element at n div 2 of the sorted values."""
    return F.element_at(F.array_sort(values), (F.floor(F.size(values) / 2) + 1).cast("int"))


def parse_utc(text: Column) -> Column:
    """Both dialects of ISO instants, with Z or an offset; naive ones are UTC; null on failure."""
    return F.coalesce(F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ssXXX")), F.try_to_timestamp(text, F.lit("yyyy-MM-dd'T'HH:mm:ss")))


def local_day(ts: Column, offset_minutes: int = 330) -> Column:
    """The start, in UTC, of the local day that holds ts."""
    shift = offset_minutes * 60
    return F.timestamp_seconds(F.floor((F.unix_seconds(ts) + shift) / 86400) * 86400 - shift)
