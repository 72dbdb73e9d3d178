"""Sums by group, kept up by change: from the rows a batch replaces and those it brings."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

ROWS = "_rows"


def sums(rows: DataFrame, by: Mapping[str, Column], values: Mapping[str, Column]) -> DataFrame:
    """Groups with the number of their rows and the sums of `values`, which must be exact (counts or
    decimals), so that taking away what was added leaves nothing behind."""
    return rows.groupBy(*(c.alias(n) for n, c in by.items())).agg(
        F.count(F.lit(1)).alias(ROWS), *(F.coalesce(F.sum(c), F.lit(0)).alias(n)
                                         for n, c in values.items()))


def changes(before: DataFrame, after: DataFrame, by: Mapping[str, Column],
            values: Mapping[str, Column]) -> DataFrame:
    """What the sums gain when the rows of `before` give way to those of `after`; groups that gain
    nothing are left out. Only changed rows are read, and partial sums are shuffled."""
    def signed(rows: DataFrame, sign: int) -> DataFrame:
        # negated, not multiplied: a product of decimals may have fewer decimals
        known = {n: F.coalesce(c, F.lit(0)) for n, c in values.items()}
        return rows.select(F.lit(sign).alias("_sign"), *(c.alias(n) for n, c in by.items()), *(
            (c if sign > 0 else -c).alias(n) for n, c in known.items()))

    names = [ROWS, *values]
    found = signed(before, -1).unionByName(signed(after, 1)).groupBy(*by).agg(
        F.sum("_sign").alias(ROWS), *(F.sum(n).alias(n) for n in values))
    return found.filter(" OR ".join(f"{n} <> 0" for n in names))


def _touching(state: DataFrame, gained: DataFrame, by: Sequence[str], how: str) -> DataFrame:
    touched = gained.select(*(F.col(c).alias(f"_t_{c}") for c in by))
    return state.join(touched, [F.col(f"_t_{c}").eqNullSafe(F.col(c)) for c in by], how)


def applied(state: DataFrame, gained: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sums after the change, of the groups that it touches: groups left without rows come with
    none, for the caller to drop. `state` may be the whole of it or the part that is touched."""
    names = [c for c in state.columns if c not in by]
    both = _touching(state, gained, by, "left_semi").unionByName(gained)
    # summed, not added: a sum of decimals keeps their decimals
    return both.groupBy(*by).agg(*(
        F.sum(n).cast(state.schema[n].dataType).alias(n) for n in names)).select(state.columns)


def kept_up(state: DataFrame, gained: DataFrame, by: Sequence[str]) -> DataFrame:
    """The whole state after the change: untouched groups as they are, emptied ones gone."""
    return (_touching(state, gained, by, "left_anti")
            .unionByName(applied(state, gained, by).filter(F.col(ROWS) > 0)))
