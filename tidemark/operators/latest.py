"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def latest(df: DataFrame, key: str, ts: str = "_extracted_at",
           tie_break: Sequence[str] | None = None) -> DataFrame:
    """The newest row of each key; a row without a time counts as newest.

    Equal times are decided by the other columns, so the result does not depend on row order.
    Because only rank 1 is kept, Spark ranks within each input partition first (WindowGroupLimit)
    and shuffles at most one row per key and partition: a key with a third of all rows is no
    hot spot.
    """
    rest = tie_break if tie_break is not None else [c for c in df.columns if c not in (key, ts)]
    order = ", ".join([f"{ts} DESC NULLS FIRST"] + [f"{c} DESC NULLS LAST" for c in rest])
    return (df.selectExpr("*", f"row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS _rank")
            .filter("_rank = 1").drop("_rank"))
