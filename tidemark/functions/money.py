"""Exact money. Doubles add up differently in every order of rows; decimals do not.

Amounts keep eight decimals; results are rounded where a result is defined as rounded, and never
what goes into it. An amount beyond twenty digits is null, not the end of the job.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def MONEY(name: str) -> str:  # noqa: N802
    """`money` as SQL text."""
    return f"TRY_CAST({name} AS DECIMAL(28,8))"


def money(col: Column | str) -> Column:
    """A stored double as an exact amount, so that sums do not depend on row order."""
    return (F.col(col) if isinstance(col, str) else col).try_cast("decimal(28,8)")


def units(col: Column | str) -> Column:
    """A quantity or count as an exact factor of an amount."""
    return (F.col(col) if isinstance(col, str) else col).cast("decimal(20,0)")


def plain(col: Column) -> Column:
    """An exact result back as a double."""
    return col.cast("double")


def per(amount: Column, count: Column) -> Column:
    """Quotient of an amount and a count to two decimals, null when the count is 0 or null.

    The types leave 16 decimals to the quotient, enough for no tie to be rounded twice.
    """
    return F.round(
        amount.cast("decimal(30,8)") / F.nullif(count.cast("decimal(18,0)"), F.lit(0)), 2)
