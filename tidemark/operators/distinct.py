"""Exact distinct counts that can be merged: whole numbers as bitmaps in buckets.

A row of the stored form is a group, a bucket of 32,768 neighbouring numbers and the bitmap of those
that occur. Bitmaps of days are merged to those of any period, and late rows are merged in, by a bitwise or,
without the rows they were made from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

BUCKET, BITS = "bucket", "bits"


def bitmaps(rows: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """The groups of `by` with the bitmaps of `number`, nulls aside; partial bitmaps are shuffled,
    not rows."""
    return (rows.filter(F.col(number).isNotNull())
            .groupBy(*by, F.bitmap_bucket_number(number).alias(BUCKET))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)))


def merged(maps: DataFrame, **by: Column | str) -> DataFrame:
    """Bitmaps of coarser groups, given as name = expression over the columns of the finer ones."""
    groups = [(F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in by.items()]
    return maps.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS))


def counts(maps: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """How many different numbers each group has."""
    return maps.groupBy(*by).agg(F.sum(F.bitmap_count(BITS)).alias(name))
