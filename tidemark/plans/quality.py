"""Data checks. Each returns its findings; no findings means the check passed."""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import ntz, to_day
from tidemark.operators import overlapping_versions
from tidemark.schemas import SEGMENTS, SENTIMENTS, STATUSES

Tables = Mapping[str, DataFrame]

# The column checks of each table.
NOT_NULL = {
    "silver": {
        "stg_customers": ["customer_id", "email", "updated_at"],
        "stg_products": ["product_id", "price", "category"],
        "stg_orders": ["order_id", "customer_id", "total_amount"],
        "stg_order_items": ["order_item_id", "order_id", "product_id"],
        "stg_reviews": ["review_id", "rating"],
    },
    "gold": {
        "dim_customers": ["customer_key", "customer_id", "email", "is_current"],
        "dim_products": ["product_key", "product_id", "price", "is_current"],
        "dim_date": ["date_key", "full_date"],
        "fct_orders": ["order_id", "customer_id", "total_amount"],
        "fct_order_items": ["order_item_id", "order_id", "product_id"],
        "fct_reviews": ["review_id", "order_id", "product_id", "rating"],
        "mart_revenue_summary": ["gross_revenue"],
        "mart_product_performance": ["product_id"],
        "mart_customer_orders": ["customer_id"],
        "mart_order_funnel": ["order_day"],
    },
}
UNIQUE = {
    "silver": {
        "stg_customers": ["customer_id", "email"], "stg_products": ["product_id"],
        "stg_orders": ["order_id"], "stg_order_items": ["order_item_id"],
        "stg_reviews": ["review_id"],
    },
    "gold": {
        "dim_date": ["date_key", "full_date"], "fct_orders": ["order_id"],
        "fct_order_items": ["order_item_id"], "fct_reviews": ["review_id"],
        "mart_product_performance": ["product_id"], "mart_customer_orders": ["customer_id"],
        "mart_order_funnel": ["order_day"],
    },
}
ACCEPTED = {
    "silver": {"stg_orders": {"status": STATUSES}},
    "gold": {"fct_orders": {"status": STATUSES}, "fct_reviews": {"sentiment": SENTIMENTS},
             "mart_customer_orders": {"customer_segment": SEGMENTS}},
}
REFERENCES = {"gold": [("fct_order_items", "order_id", "fct_orders", "order_id")]}
GATE = {"raw_orders": 1, "stg_orders": 1, "fct_orders": 1, "mart_revenue_summary": 1}


# Rows that may not be, by table, beside nulls and values outside a list.
REFUSED = {
    "fct_orders": {"revenue_positive": "total_amount <= 0"},
    "fct_reviews": {"rating_range": "rating < 1.0 OR rating > 5.0"},
}


class CheckFailed(ValueError):
    """One or more checks have findings."""


def watch(table: str) -> dict[str, Column]:
    """Conditions for the pass that stores a table to count, so that checks which find none of them
    met need not read it: `null <column>`, `value <column>`, and the names in `REFUSED`."""
    found = {f"null {c}": F.col(c).isNull()
             for layer in NOT_NULL.values() for c in layer.get(table, [])}
    found |= {f"value {c}": ~F.col(c).isin(list(values))
              for layer in ACCEPTED.values() for c, values in layer.get(table, {}).items()}
    return found | {name: F.expr(bad) for name, bad in REFUSED.get(table, {}).items()}


def _all(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _by_column(counts: DataFrame, table: str, cols: Sequence[str]) -> DataFrame:
    """A row per column out of one row with a count for each."""
    return counts.select(F.inline(F.array(*(
        F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                 F.col(c).alias("failures")) for c in cols))))


def not_null(tables: Tables, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Nulls per column; one pass over each table, whatever the number of its columns."""
    parts = []
    for name, cols in columns.items():
        counts = tables[name].agg(*(F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in cols))
        parts.append(_by_column(counts, name, cols))
    return _all(parts)


def unique(tables: Tables, columns: Mapping[str, Sequence[str]]) -> DataFrame:
    """Values per column that occur more than once, nulls aside; one pass over each table."""
    parts = []
    for name, cols in columns.items():
        # One field per column, null but for the entry's own: values keep their types.
        entries = [[F.lit(i).alias("_n"), *(
            (F.col(c) if c == own else F.lit(None).cast(tables[name].schema[c].dataType)).alias(c)
            for c in cols)] for i, own in enumerate(cols)]
        values = tables[name].select(*entries[0]) if len(cols) == 1 else tables[name].select(
            F.inline(F.array(*(F.struct(*e) for e in entries))))
        given = reduce(lambda a, b: a | b, (F.col(c).isNotNull() for c in cols))
        twice = values.filter(given).groupBy("_n", *cols).count().filter("count > 1")
        found = twice.agg(*(F.count_if(F.col("_n") == i).alias(c) for i, c in enumerate(cols)))
        parts.append(_by_column(found, name, cols))
    return _all(parts)


def accepted_values(tables: Tables, columns: Mapping[str, Mapping[str, Sequence[str]]]) -> DataFrame:
    """Rows per unexpected value, nulls aside."""
    return _all([
        tables[name].filter(~F.col(c).isin(list(values)))
        .groupBy(F.col(c).alias("value")).agg(F.count(F.lit(1)).alias("failures"))
        .select(F.lit(name).alias("table_name"), F.lit(c).alias("column_name"), "value", "failures")
        for name, cols in columns.items() for c, values in cols.items()])


def relationships(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Key values of the child that the parent lacks, with their rows."""
    found = parent.select(F.col(parent_key).alias(key))
    return (child.filter(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count(F.lit(1)).alias("failures")).join(found, key, "left_anti"))


def duplicate_current(dim_customers: DataFrame) -> DataFrame:
    return (dim_customers.filter("is_current").groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("current_row_count")).filter("current_row_count > 1"))


def future_orders(fct_orders: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return (fct_orders.filter(to_day(F.col("order_date")) > to_day(ntz(as_of)))
            .select("order_id", "order_date"))


def orphan_items(items: DataFrame, orders: DataFrame) -> DataFrame:
    return (items.join(orders.select("order_id"), "order_id", "left_anti")
            .select("order_item_id", "order_id"))


def revenue_positive(orders: DataFrame) -> DataFrame:
    return orders.filter("total_amount <= 0").select("order_id", "total_amount")


def history_overlap(dim_customers: DataFrame) -> DataFrame:
    return overlapping_versions(dim_customers, "customer_id")


def rating_range(reviews: DataFrame) -> DataFrame:
    return reviews.filter("rating < 1.0 OR rating > 5.0").select("review_id", "rating")


def row_counts(tables: Tables, minimum: Mapping[str, int] = GATE) -> DataFrame:
    """Row count and least count of the gate's tables."""
    return _all([
        tables[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(least).alias("min_rows"),
            (F.col("row_count") >= least).alias("passed"))
        for name, least in minimum.items()])


def gate(counts: Mapping[str, int], minimum: Mapping[str, int] = GATE) -> None:
    """All counts, as the commits have them, are looked at before the gate closes."""
    short = [f"{name} has {counts[name]} rows, expected >= {least}"
             for name, least in minimum.items() if counts[name] < least]
    if short:
        raise CheckFailed("; ".join(short))


def require_none(findings: Mapping[str, DataFrame]) -> None:
    """Stop if any check has a finding; one row of each, as JSON, is fetched in a single job."""
    if not findings:
        return
    failed = _all([df.limit(1).select(F.lit(name).alias("name"), F.to_json(F.struct("*")).alias("row"))
                   for name, df in findings.items()]).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['name']}: {r['row']}" for r in failed))


def column_checks(tables: Tables, layer: str,
                  watched: Mapping[str, Mapping[str, int]] | None = None,
                  settled: Collection[str] = ()) -> dict[str, DataFrame]:
    """Checks of a layer's columns. Nulls and values that the write of a table has not met
    (`Table.watched`) are not looked for again, nor is anything in tables that are `settled`: they are
    as they were when they passed."""
    def open_(table: str, name: str) -> bool:
        return table not in settled and (watched or {}).get(table, {}).get(name) != 0

    nulls = {t: left for t, cols in NOT_NULL[layer].items()
             if (left := [c for c in cols if open_(t, f"null {c}")])}
    values = {t: left for t, cols in ACCEPTED[layer].items()
              if (left := {c: v for c, v in cols.items() if open_(t, f"value {c}")})}
    keys = {t: cols for t, cols in UNIQUE[layer].items() if t not in settled}
    found = {}
    if keys:
        found["unique"] = unique(tables, keys).filter("failures > 0")
    if nulls:
        found["not_null"] = not_null(tables, nulls).filter("failures > 0")
    if values:
        found["accepted_values"] = accepted_values(tables, values)
    for child, key, parent, parent_key in REFERENCES.get(layer, []):
        if child in settled and parent in settled:
            continue
        found[f"{child}.{key}"] = relationships(tables[child], key, tables[parent], parent_key)
    return found


def singular_checks(tables: Tables, as_of: dt.datetime | str,
                    watched: Mapping[str, Mapping[str, int]] | None = None) -> dict[str, DataFrame]:
    found = {
        "duplicate_current": duplicate_current(tables["dim_customers"]),
        "future_orders": future_orders(tables["fct_orders"], as_of),
        "orphan_items": orphan_items(tables["fct_order_items"], tables["fct_orders"]),
        "revenue_positive": revenue_positive(tables["fct_orders"]),
        "history_overlap": history_overlap(tables["dim_customers"]),
        "rating_range": rating_range(tables["fct_reviews"]),
    }
    clean = {name for names in (watched or {}).values() for name, n in names.items() if n == 0}
    return {name: rows for name, rows in found.items() if name not in clean}
