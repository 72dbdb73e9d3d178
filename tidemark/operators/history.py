"""Change history of a keyed table (slowly changing dimension, type 2)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

VALID_FROM, VALID_TO, VERSION_ID = "dbt_valid_from", "dbt_valid_to", "dbt_scd_id"


def is_current() -> Column:
    return F.col(VALID_TO).isNull()


#: Digest of the checked columns, where open versions are stored with one.
DIGEST = "_digest"


def digest(check: Sequence[str], row: str = "") -> str:
    """SQL: one text that differs if a checked column does, null counting as a value."""
    return f"md5(to_json(struct({', '.join(f'{row}{c} AS {c}' for c in check)})))"


def save_open(rows: DataFrame, table: str, path: str, key: str, check: Sequence[str],
              buckets: int) -> DataFrame:
    """Store open versions in buckets of their key, with the digest of their checked columns. A later
    `advance` then moves only the present table, to these buckets, and compares one column."""
    (rows.withColumn(DIGEST, F.expr(digest(check)))
     .write.bucketBy(buckets, key).sortBy(key).mode("overwrite").option("path", path)
     .saveAsTable(table))
    return rows.sparkSession.table(table)


def _opened(row: str, key: str, cols: Sequence[str], now: str) -> list[str]:
    """Columns of a new version of a row, which is given by the prefix of its columns."""
    return [*(f"{row}{c} AS {c}" for c in cols), f"{now} AS {VALID_FROM}",
                      f"CAST(NULL AS TIMESTAMP_NTZ) AS {VALID_TO}",
                      f"md5(concat_ws('|', {row}{key}, {now})) AS {VERSION_ID}"]


def advance(open_rows: DataFrame | None, current: DataFrame, key: str, check: Sequence[str],
            as_of: dt.datetime | str, close_vanished: bool = True) -> DataFrame:
    """Open versions against the present table: unchanged rows, closed rows and new versions.

    One full outer join on the key, which is unique on both sides; none on the first run. A row
    whose checked columns are all the same stays exactly as it was, its unchecked columns included.
    Open versions from `save_open` are told by their digest.
    """
    cols, now = current.columns, f"TIMESTAMP_NTZ '{as_of}'"
    if open_rows is None:
        return current.selectExpr(*_opened("", key, cols, now))
    stored = DIGEST in open_rows.columns
    old = open_rows.selectExpr(
        f"{key} AS _old_key", f"{DIGEST if stored else 'NULL'} AS _old_digest",
        f"struct({', '.join([*cols, VALID_FROM, VALID_TO, VERSION_ID])}) AS _old")
    new = current.selectExpr(f"{key} AS _new_key", f"struct({', '.join(cols)}) AS _new")
    both = old.join(new, F.expr("_old_key = _new_key"), "full_outer")

    differs = (f"_old_digest <> {digest(check, '_new.')}" if stored
               else " OR ".join(f"NOT (_old.{c} <=> _new.{c})" for c in check))
    changed = f"(_old IS NOT NULL AND _new IS NOT NULL AND ({differs}))"
    closes = f"({changed} OR _new IS NULL)" if close_vanished else changed
    kept = ", ".join([*(f"_old.{c} AS {c}" for c in cols), f"_old.{VALID_FROM} AS {VALID_FROM}",
                      f"IF({closes}, {now}, NULL) AS {VALID_TO}",
                      f"_old.{VERSION_ID} AS {VERSION_ID}"])
    opened = ", ".join(_opened("_new.", key, cols, now))
    return both.selectExpr(f"""inline(array_compact(array(
        IF(_old IS NOT NULL, struct({kept}), NULL),
        IF(_old IS NULL OR {changed}, struct({opened}), NULL))))""")


def snapshot(history: DataFrame | None, current: DataFrame, key: str, check: Sequence[str],
             as_of: dt.datetime | str, close_vanished: bool = True) -> DataFrame:
    """The history brought up to the present table. Closed versions pass through unshuffled."""
    if history is None:
        return advance(None, current, key, check, as_of)
    live = advance(history.filter(is_current()), current, key, check, as_of, close_vanished)
    return history.filter(~is_current()).unionByName(live)
