"""Time helpers. All times are UTC without a zone; the present is always an argument."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F


def ntz(value: Column | dt.datetime | str) -> Column:
    """A point in time as a zone-free column."""
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def to_day(col: Column) -> Column:
    return col.cast("date")


def hours_crossed(start: Column, end: Column) -> Column:
    """Hour marks passed on the clock: 00:59 to 01:01 is one, though two minutes apart."""
    return (F.datediff(end, start) * 24 + F.hour(end) - F.hour(start)).cast("long")
