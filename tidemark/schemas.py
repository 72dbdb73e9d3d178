"""Schemas of the five raw tables. The JSON fields come first, the load columns last."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_TYPES = {
    "L": T.LongType(),
    "S": T.StringType(),
    "D": T.DoubleType(),
    "T": T.TimestampNTZType(),
}


def _schema(spec: str) -> T.StructType:
    pairs = (item.rsplit(" ", 1) for item in spec.split(", "))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


@dataclass(frozen=True)
class Entity:
    """A source entity: `snapshot` entities are extracted whole each day, the others by increment."""

    name: str
    key: str
    mode: str
    fields: T.StructType

    @property
    def raw(self) -> str:
        return f"raw_{self.name}"

    @property
    def silver(self) -> str:
        return f"stg_{self.name}"


ENTITIES = {
    e.name: e
    for e in (
        Entity("customers", "customer_id", "snapshot", _schema(
            "customer_id L, first_name S, last_name S, email S, username S, phone S, city S, "
            "state S, zipcode S, country S, created_at T, updated_at T, _extracted_at T")),
        Entity("products", "product_id", "snapshot", _schema(
            "product_id L, title S, category S, price D, cost_price D, stock_quantity L, "
            "rating D, review_count L, updated_at T, _extracted_at T")),
        Entity("orders", "order_id", "incremental", _schema(
            "order_id L, customer_id L, order_date T, status S, payment_method S, "
            "shipping_city S, total_amount D, updated_at T, _extracted_at T")),
        Entity("order_items", "order_item_id", "incremental", _schema(
            "order_item_id L, order_id L, product_id L, quantity L, unit_price D, "
            "line_total D, _extracted_at T")),
        Entity("reviews", "review_id", "incremental", _schema(
            "review_id L, order_id L, product_id L, customer_id L, rating D, review_text S, "
            "reviewed_at T, updated_at T, _extracted_at T")),
    )
}

# Fixed values of the data model.
STATUSES = ["pending", "confirmed", "shipped", "delivered", "cancelled"]
SENTIMENTS = ["positive", "neutral", "negative"]
SEGMENTS = ["Champion", "Loyal", "Recent", "At Risk", "Needs Attention"]
