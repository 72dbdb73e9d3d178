"""Gold base: the histories, dimensions and facts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators import snapshot

# The columns whose change opens a new version.
CUSTOMER_CHECKS = ["city", "state", "phone", "email"]
PRODUCT_CHECKS = ["price", "stock_quantity", "cost_price"]


def customer_history(history: DataFrame | None, stg: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return snapshot(history, stg, "customer_id", CUSTOMER_CHECKS, as_of)


def product_history(history: DataFrame | None, stg: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    return snapshot(history, stg, "product_id", PRODUCT_CHECKS, as_of)


def dim_customers(history: DataFrame) -> DataFrame:
    """One row per version; the key is the natural id, so look-ups must ask for `is_current`."""
    return history.selectExpr(
        "customer_id AS customer_key", "customer_id", "first_name", "last_name",
        "first_name || ' ' || last_name AS full_name", "email", "username", "phone", "city",
        "state", "zipcode", "country", "created_at", "updated_at", "dbt_valid_from",
        "dbt_valid_to", "dbt_valid_to IS NULL AS is_current", "dbt_scd_id")


def dim_products(history: DataFrame) -> DataFrame:
    return history.selectExpr(
        "product_id AS product_key", "product_id", "title", "category", "price", "cost_price",
        "gross_margin", "stock_quantity", "rating", "review_count", "updated_at",
        "dbt_valid_from", "dbt_valid_to", "dbt_valid_to IS NULL AS is_current", "dbt_scd_id")


def day_spine(spark: SparkSession, start: dt.date | str = "2024-01-01",
              end: dt.date | str = "2027-12-31", include_end: bool = False) -> DataFrame:
    """All days from start to end; the end itself is left out unless asked for."""
    last = f"DATE '{end}'" if include_end else f"DATE '{end}' - 1"
    return spark.range(1).selectExpr(
        f"explode(sequence(DATE '{start}', {last})) AS date_day")


def day_spine_of(rows: DataFrame, ts: str) -> DataFrame:
    """All days from the first to the last that occurs in the rows."""
    return (rows.selectExpr(f"min(CAST({ts} AS DATE)) AS a", f"max(CAST({ts} AS DATE)) AS b")
            .selectExpr("explode(sequence(a, b)) AS date_day"))


def dim_date(spine: DataFrame) -> DataFrame:
    return spine.selectExpr(
        "year(date_day) * 10000 + month(date_day) * 100 + day(date_day) AS date_key",
        "date_day AS full_date", "year(date_day) AS year", "quarter(date_day) AS quarter",
        "month(date_day) AS month", "monthname(date_day) AS month_name",
        "weekofyear(date_day) AS week_of_year", "day(date_day) AS day_of_month",
        "dayname(date_day) AS day_name", "dayofweek(date_day) - 1 AS day_of_week",
        "dayofweek(date_day) IN (1, 7) AS is_weekend",
        """CASE WHEN month(date_day) IN (12, 1, 2) THEN 'Winter'
                WHEN month(date_day) IN (3, 4, 5) THEN 'Spring'
                WHEN month(date_day) IN (6, 7, 8) THEN 'Summer' ELSE 'Fall' END AS season""")


def _days(dates: DataFrame) -> DataFrame:
    """Day to key; adaptive execution broadcasts the calendar once it has proved small."""
    return dates.selectExpr("date_key", "full_date AS _day")


def _with_day(facts: DataFrame, ts: str, dates: DataFrame) -> DataFrame:
    return facts.join(_days(dates), F.expr(f"CAST({ts} AS DATE) = _day"), "left")


def dated_orders(orders: DataFrame, dates: DataFrame) -> DataFrame:
    """Orders with the key of their day: all that the marts need of the order facts."""
    return _with_day(orders, "order_date", dates).drop("_day").withColumnRenamed(
        "date_key", "order_date_key")


def fct_orders(orders: DataFrame, customers: DataFrame, dates: DataFrame) -> DataFrame:
    current = customers.filter("is_current").select("customer_id", "customer_key")
    return dated_orders(orders.join(current, "customer_id", "left"), dates).select(
        "order_id", "customer_id", "customer_key", "order_date_key", "order_date", "status",
        "payment_method", "shipping_city", "total_amount", "updated_at", "_extracted_at")


def fct_order_items(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with the product as it is now. No order column is needed, so orders are not joined."""
    current = products.filter("is_current").selectExpr(
        "product_id", "product_key", "title AS product_title", "category",
        "price AS current_price")
    return items.join(current, "product_id", "left").select(
        "order_item_id", "order_id", "product_id", "product_key", "product_title", "category",
        "quantity", "unit_price", "line_total", "calculated_line_total", "current_price",
        "_extracted_at")


def rated_reviews(reviews: DataFrame) -> DataFrame:
    """Reviews with their sentiment: all that the marts need of the review facts."""
    return reviews.selectExpr("*", """
        CASE WHEN rating >= 4.0 THEN 'positive' WHEN rating >= 3.0 THEN 'neutral'
             ELSE 'negative' END AS sentiment""")


def fct_reviews(reviews: DataFrame, customers: DataFrame, products: DataFrame,
                dates: DataFrame) -> DataFrame:
    buyer = customers.filter("is_current").selectExpr(
        "customer_id", "customer_key", "full_name AS customer_name")
    product = products.filter("is_current").selectExpr(
        "product_id", "product_key", "title AS product_title", "category")
    facts = (rated_reviews(reviews).join(buyer, "customer_id", "left")
             .join(product, "product_id", "left"))
    return _with_day(facts, "reviewed_at", dates).selectExpr(
        "review_id", "order_id", "product_id", "product_key", "product_title", "category",
        "customer_id", "customer_key", "customer_name", "date_key AS review_date_key",
        "reviewed_at", "rating", "review_text", "sentiment", "_extracted_at")


# ── storage by month ─────────────────────────────────────────────────────────

MONTH = "month_key"


def month_key(day: str) -> Column:
    return F.year(day) * 100 + F.month(day)


def write_by_month(rows: DataFrame, day: str, path: str) -> DataFrame:
    """Store rows in a folder a month of their day; rows of a month are brought together first."""
    (rows.withColumn(MONTH, month_key(day)).hint("rebalance", F.col(MONTH))
     .write.mode("overwrite").partitionBy(MONTH).parquet(path))
    return rows.sparkSession.read.schema(
        rows.withColumn(MONTH, month_key(day)).schema).parquet(path)


def on_days(stored: DataFrame, day: str, dates: DataFrame) -> DataFrame:
    """Rows of `write_by_month` on the given days of the calendar. The months are known only when the
    calendar has been filtered: the scan waits for them and opens no other folder."""
    days = dates.select(month_key("full_date").alias("_month"), F.col("full_date").alias("_day"))
    return stored.join(days, (F.col(MONTH) == F.col("_month")) & (F.col(day) == F.col("_day"))) \
        .drop("_month", "_day", MONTH)
