"""Exact NTILE over a whole table without a window over the whole table.

The built-in `ntile` with no partition moves every row to one task. Which tile a row falls in
depends only on the rows at the tile ends. The sort positions of all rows are dealt to tasks by
range and sorted there; one count a task tells in which task, and as which of its rows, the last row
of each tile lies. These few rows are fetched, and all rows are labelled in place.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import accumulate
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType

from tidemark.session import materialize

# Fixed value: `monotonically_increasing_id` counts the rows of a task in its low 33 bits.
ROW_BITS = 33


@dataclass(frozen=True)
class Order:
    """Sort order of one score. Nulls come last ascending and first descending."""

    column: str
    descending: bool = False


def tile_ends(rows: int, tiles: int) -> dict[int, int]:
    """Rank of the last row of each tile but the last one; the first `rows % tiles` hold one more."""
    size, extra = divmod(rows, tiles)
    ends = {t: t * size + min(t, extra) for t in range(1, tiles)}
    return {t: r for t, r in ends.items() if 0 < r < rows}


def _place(df: DataFrame, order: Order, id_col: str) -> Column:
    """Sort position of a row, ascending."""
    key = F.col(order.column)
    low_null = F.when(key.isNull(), 0 if order.descending else 1).otherwise(
        1 if order.descending else 0)
    kind = df.schema[order.column].dataType
    signed = (-key if order.descending else key).cast(kind)
    return F.struct(low_null.alias("n"), F.coalesce(signed, F.lit(0).cast(kind)).alias("k"),
                    F.col(id_col).alias("id"))


def _literal(place: Any, kind: DataType) -> Column:
    return F.struct(*(F.lit(v).alias(n) for n, v in zip(("n", "k", "id"), place))).cast(kind)


def _sorted(df: DataFrame, places: list[Column], kinds: list[DataType]) -> DataFrame:
    """s (number of the score), p0, p1, … (the place, under the score's own number), and `at`, which
    counts up through the order of all rows, with gaps between tasks."""
    entries = (F.struct(F.lit(i).alias("s"), *(
        (place if j == i else F.lit(None).cast(kind)).alias(f"p{j}")
        for j, kind in enumerate(kinds))) for i, place in enumerate(places))
    by = ["s", *(f"p{i}" for i in range(len(places)))]
    rows = df.select(F.inline(F.array(*entries)))
    return materialize(rows.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("at", F.monotonically_increasing_id()), "places")


def _nth(stored: DataFrame) -> tuple[int, Any]:
    """Number of rows, and a function from the number of a row (from 0) to its `at`."""
    counts = sorted(map(tuple, stored.groupBy(
        F.shiftright("at", ROW_BITS).alias("task")).count().collect()))   # a row a task
    before = [0, *accumulate(n for _, n in counts)]

    def at(row: int) -> int:
        i = bisect_right(before, row) - 1
        return (counts[i][0] << ROW_BITS) + row - before[i]

    return before[-1], at


def tile_columns(df: DataFrame, id_col: str, scores: Mapping[str, Order],
                 tiles: int = 5) -> dict[str, Column]:
    """An NTILE expression per entry of `scores`, to be put on the rows of `df`.

    Keys must be numeric; equal keys are ordered by `id_col`, which is unique. `df` is read more than
    once and should be stored. One shuffle serves all scores, and carries their keys alone.
    """
    places = [_place(df, o, id_col) for o in scores.values()]
    kinds = [f.dataType for f in
             df.select(*(p.alias(f"p{i}") for i, p in enumerate(places))).schema.fields]
    stored = _sorted(df, places, kinds)
    rows, at = _nth(stored)
    total = rows // max(1, len(places))
    last = {(i, t): at(i * total + rank - 1)
            for i in range(len(places)) for t, rank in tile_ends(total, tiles).items()}
    found = {r["at"]: r for r in stored.filter(
        F.col("at").isin(list(last.values()))).collect()} if last else {}  # one a tile and score

    def label(i: int) -> Column:
        # Tiles that would be empty (fewer rows than tiles) have no end; the rest count up.
        col = F.lit(max(1, min(total, tiles)))
        for s, t in sorted(last, reverse=True):
            if s == i:
                end = _literal(tuple(found[last[s, t]][f"p{i}"]), kinds[i])
                col = F.when(places[i] <= end, t).otherwise(col)
        return col

    return {name: label(i) for i, name in enumerate(scores)}


def ntile_scores(df: DataFrame, id_col: str, scores: Mapping[str, Order],
                 tiles: int = 5) -> DataFrame:
    """The table with one NTILE column per entry of `scores`."""
    df = materialize(df, "ntile")
    return df.withColumns(tile_columns(df, id_col, scores, tiles))
