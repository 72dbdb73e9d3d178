"""Silver: one clean row per entity id.

Rows are filtered before the latest one is taken, so an invalid newest row lets an older valid
one through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.functions import MONEY, title_case
from tidemark.operators import latest
from tidemark.schemas import ENTITIES


# The rows that count, and what becomes of their columns.
VALID = {
    "customers": "customer_id IS NOT NULL",
    "products": "product_id IS NOT NULL AND price > 0",
    "orders": "order_id IS NOT NULL AND customer_id IS NOT NULL AND total_amount > 0",
    "order_items": "order_item_id IS NOT NULL AND order_id IS NOT NULL AND quantity > 0 AND unit_price > 0",
    "reviews": "review_id IS NOT NULL AND rating BETWEEN 1.0 AND 5.0",
}
TIDY = {
    "customers": {
        **{c: f"trim({c})" for c in ("first_name", "last_name")},
        **{c: f"lower(trim({c}))" for c in ("email", "username")},
        "city": title_case("city"), "state": "upper(state)", "country": "upper(country)"},
    "products": {
        "title": "trim(title)", "category": "lower(trim(category))",
        "stock_quantity": "IF(stock_quantity < 0, 0, stock_quantity)",
        "gross_margin": f"CAST(round({MONEY('price')} - {MONEY('cost_price')}, 2) AS DOUBLE)"},
    "orders": {
        "status": "lower(trim(status))", "payment_method": "lower(trim(payment_method))",
        "shipping_city": title_case("shipping_city")},
    "order_items": {
        "calculated_line_total": f"CAST(round({MONEY('unit_price')} * quantity, 2) AS DOUBLE)"},
    "reviews": {"review_text": "trim(review_text)"},
}
#: Columns that only the clean table has stand before these.
_BEFORE = {"gross_margin": "updated_at", "calculated_line_total": "_extracted_at"}


def tidied(entity: str) -> dict[str, str]:
    """The columns of a clean table, in their order, as SQL over those of the raw rows."""
    names = list(ENTITIES[entity].fields.names)
    for name in TIDY[entity]:
        if name not in names:
            names.insert(names.index(_BEFORE[name]), name)
    return {n: TIDY[entity].get(n, n) for n in names}


def valid(raw: DataFrame, entity: str) -> DataFrame:
    """The rows that count, with the entity's own columns; load columns are left behind before
    anything is shuffled."""
    return raw.select(*ENTITIES[entity].fields.names).filter(VALID[entity])


def _clean(raw: DataFrame, entity: str) -> DataFrame:
    return latest(valid(raw, entity), ENTITIES[entity].key).selectExpr(
        *(f"{made} AS {name}" for name, made in tidied(entity).items()))


def customers(raw: DataFrame) -> DataFrame:
    return _clean(raw, "customers")


def products(raw: DataFrame) -> DataFrame:
    return _clean(raw, "products")


def orders(raw: DataFrame) -> DataFrame:
    return _clean(raw, "orders")


def order_items(raw: DataFrame) -> DataFrame:
    return _clean(raw, "order_items")


def reviews(raw: DataFrame) -> DataFrame:
    return _clean(raw, "reviews")


CLEAN = {"customers": customers, "products": products, "orders": orders,
         "order_items": order_items, "reviews": reviews}
