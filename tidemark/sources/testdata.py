"""The five raw tables, derived from the driver's tables by plain expressions (see FIXTURES.md).

Customers and products are whole snapshots of three days, orders two increments. The days differ
by rule:

* customers: day 2 moves the BUILDING segment, day 3 moves it back, clears the phone of MACHINERY
  and renames FURNITURE (a column that opens no new version);
* products: day 2 doubles the price of ECONOMY parts, day 3 clears the stock of SMALL ones;
* orders: day 2 brings the urgent orders again, now delivered, the high ones again without a
  total (to be refused), and new orders.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

DAYS = {1: "2026-01-01", 2: "2026-01-02", 3: "2026-01-03"}
RUN_AT = {d: f"{day} 06:00:00" for d, day in DAYS.items()}
NEW_ORDER_IDS = 10_000_000_000


# Columns of the driver's tables. Given, so that reading a table starts no job to look for them.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "part": "p_partkey long, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, "
              "props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _at(day: int) -> str:
    return f"TIMESTAMP_NTZ '{DAYS[day]} 00:00:00'"


def customers_on(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    city, first = "n_name", "' Customer '"
    phone = "CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS STRING)"
    if day == 2:
        city = "IF(c_mktsegment = 'BUILDING', 'new-town east', n_name)"
    if day == 3:
        phone = f"IF(c_mktsegment = 'MACHINERY', NULL, {phone})"
        first = "IF(c_mktsegment = 'FURNITURE', 'Renamed', ' Customer ')"
    places = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey"), "left")
    return (table(spark, sf_dir, "customer")
            .join(places, F.expr("c_nationkey = n_nationkey"), "left").selectExpr(
                "c_custkey AS customer_id", f"{first} AS first_name",
                "substring(c_name, 10) AS last_name",
                "upper(c_name) || '@example.com' AS email", "' ' || c_name || ' ' AS username",
                f"{phone} AS phone", f"{city} AS city", "lower(r_name) AS state",
                "CAST(c_nationkey AS STRING) AS zipcode", "'us' AS country",
                "TIMESTAMP_NTZ '2020-01-01 00:00:00' AS created_at",
                "TIMESTAMP_NTZ '2025-12-31 00:00:00' AS updated_at",
                f"{_at(day)} AS _extracted_at"))


def products_on(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    price = "CAST(p_retailprice AS DECIMAL(18,2))"
    now, stock = price, "p_size - 5L"
    if day == 2:
        now = f"IF(p_type = 'ECONOMY', {price} * 2, {price})"
    if day == 3:
        stock = "IF(p_type = 'SMALL', NULL, p_size - 5L)"
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "' ' || p_name AS title", "p_type AS category",
        f"CAST({now} AS DOUBLE) AS price",
        f"CAST({price} * 0.6BD AS DOUBLE) AS cost_price",
        f"{stock} AS stock_quantity", "CAST(p_partkey % 41 + 10 AS DOUBLE) / 10D AS rating",
        "CAST(p_size AS BIGINT) AS review_count",
        "TIMESTAMP_NTZ '2025-12-31 00:00:00' AS updated_at", f"{_at(day)} AS _extracted_at")


def orders_on(spark: SparkSession, sf_dir: str, day: int) -> DataFrame:
    """Totals have three decimals, so that it shows where a report rounds what goes into it."""
    orders = table(spark, sf_dir, "orders")
    status = """CASE o_orderpriority WHEN '1-URGENT' THEN ' Pending ' WHEN '2-HIGH' THEN 'CONFIRMED'
        WHEN '3-MEDIUM' THEN 'shipped' WHEN '5-LOW' THEN 'cancelled' ELSE 'delivered' END"""
    price = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) + 0.005BD AS DOUBLE)"
    total = f"IF(o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P', -{price}, {price})"
    ident = "o_orderkey"
    if day == 2:
        new = "(o_orderpriority = '5-LOW' AND o_orderstatus = 'P')"
        orders = orders.filter(f"o_orderpriority IN ('1-URGENT', '2-HIGH') OR {new}")
        status = f"IF(o_orderpriority = '1-URGENT', 'DELIVERED', {status})"
        total = f"IF(o_orderpriority = '2-HIGH', 0D, {price})"
        ident = f"IF({new}, o_orderkey + {NEW_ORDER_IDS}, o_orderkey)"
    return orders.selectExpr(
        f"{ident} AS order_id", "o_custkey AS customer_id", "o_orderdate AS order_date",
        f"{status} AS status", "' ' || o_orderstatus AS payment_method",
        "o_orderpriority AS shipping_city", f"{total} AS total_amount",
        "o_orderdate AS updated_at", f"{_at(day)} AS _extracted_at")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines carry their ship date as extraction time; many ids occur more than once.

    Prices have three decimals, so that it shows where a result is rounded.
    """
    price = "(CAST(l_extendedprice AS DECIMAL(18,2)) + 0.005BD)"
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS order_item_id", "l_orderkey AS order_id",
        "l_partkey AS product_id", "CAST(l_quantity AS BIGINT) AS quantity",
        f"CAST({price} AS DOUBLE) AS unit_price",
        f"CAST({price} * CAST(l_quantity AS INT) AS DOUBLE) AS line_total", "l_shipdate AS _extracted_at")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ratings run from 0.8 to 5.2, so some lie outside the scale."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS review_id", "event_id AS order_id",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS product_id", "user_id AS customer_id",
        "CAST(event_id % 45 + 8 AS DOUBLE) / 10D AS rating",
        "' ' || event_type || ' ' AS review_text", "ts AS reviewed_at", "ts AS updated_at",
        f"{_at(1)} AS _extracted_at")


_DAILY = {"customers": (customers_on, 3), "products": (products_on, 3), "orders": (orders_on, 2)}


def raw(spark: SparkSession, sf_dir: str, entity: str, until: int = 2) -> DataFrame:
    """All that was extracted of an entity up to and including a day."""
    if entity not in _DAILY:
        return {"order_items": order_items, "reviews": reviews}[entity](spark, sf_dir)
    read, last = _DAILY[entity]
    return reduce(DataFrame.unionByName,
                  (read(spark, sf_dir, d) for d in range(1, min(until, last) + 1)))
