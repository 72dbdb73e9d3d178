"""Business reports over the marts. Nulls sort first downwards and last upwards."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import money, ntz, per, plain, to_day
from tidemark.plans import gold


def _down(name: str) -> Column:
    return F.col(name).desc_nulls_first()


def _up(name: str) -> Column:
    return F.col(name).asc_nulls_last()


def _sum(name: str) -> Column:
    return F.sum(money(name))


def _avg(name: str) -> Column:
    """Mean of an amount or count, two decimals."""
    return plain(per(F.sum(money(name)), F.count(name)))


def daily_trend(revenue: DataFrame, as_of: dt.datetime | str, days: int = 30) -> DataFrame:
    first = F.date_sub(to_day(ntz(as_of)), days)
    return _trend(revenue.filter(F.col("order_date") >= first))


def daily_trend_by_month(stored: DataFrame, dates: DataFrame, as_of: dt.datetime | str,
                         days: int = 30) -> DataFrame:
    """The same over a mart stored by `gold.write_by_month`: the calendar prunes its months."""
    first = F.date_sub(to_day(ntz(as_of)), days)
    return _trend(gold.on_days(stored, "order_date", dates.filter(F.col("full_date") >= first)))


def _trend(revenue: DataFrame) -> DataFrame:
    return (revenue.groupBy("order_date")
            .agg(_sum("gross_revenue").alias("_r"), F.sum("total_orders").alias("total_orders"))
            .select("order_date", plain(F.col("_r")).alias("total_revenue"), "total_orders",
                    plain(per(F.col("_r"), F.col("total_orders"))).alias("avg_order_value"))
            .orderBy(_down("order_date")))


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    return (products.orderBy(_down("total_revenue"), "product_id").limit(n)
            .select("product_name", "category", "total_units_sold", "total_revenue",
                    "total_profit", "avg_rating"))


def segment_mix(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("total_customers"),
                 _avg("lifetime_value").alias("avg_lifetime_value"),
                 _avg("total_orders").alias("avg_orders"),
                 _avg("recency_days").alias("avg_days_since_last_order"))
            .orderBy(_down("avg_lifetime_value"), "customer_segment"))


def price_history(dim_products: DataFrame) -> DataFrame:
    """All versions of products with more than one, whatever the change was."""
    several = dim_products.groupBy("product_id").count().filter("count > 1").select("product_id")
    return (dim_products.join(several, "product_id", "left_semi")
            .select("product_id", "title", "category", F.col("price").alias("historical_price"),
                    F.col("dbt_valid_from").alias("price_effective_from"),
                    F.col("dbt_valid_to").alias("price_effective_to"),
                    F.when(F.col("dbt_valid_to").isNull(), "current").otherwise("historical")
                    .alias("record_status"))
            .orderBy(_up("product_id"), _up("price_effective_from")))


def month_over_month(revenue: DataFrame) -> DataFrame:
    """Growth against the previous month that has revenue in the category.

    The window sees one row per category and month, since the months are summed before it.
    """
    months = revenue.groupBy("year", "month", "month_name", "category").agg(
        _sum("gross_revenue").alias("_now"), F.sum("total_orders").alias("monthly_orders"))
    before = F.lag("_now").over(
        Window.partitionBy("category").orderBy(_up("year"), _up("month")))
    growth = ((F.col("_now") - F.col("_before")) * 100).cast("decimal(26,8)")
    return (months.withColumn("_before", before)
            .select("year", "month", "month_name", "category",
                    plain(F.col("_now")).alias("monthly_revenue"), "monthly_orders",
                    plain(F.round(
                        growth / F.nullif(F.col("_before").cast("decimal(26,8)"), F.lit(0)), 2))
                    .alias("revenue_growth_pct"))
            .orderBy(_down("year"), _down("month"), _down("monthly_revenue"), "category"))


def price_delta(items: DataFrame, dim_products: DataFrame, n: int | None = 20) -> DataFrame:
    """Price paid against the price now, of the first `n` lines or of all (None)."""
    lines = items.select("order_item_id", "order_id", "product_id",
                         F.col("unit_price").alias("price_at_order_time"))
    if n is not None:   # the look-up adds no rows, so the cut comes before the join
        lines = lines.orderBy("order_item_id").limit(n)
    now = dim_products.filter("is_current").select("product_id", F.col("price").alias("price_today"))
    return lines.join(now, "product_id", "left").select(
        "order_item_id", "order_id", "product_id", "price_at_order_time", "price_today",
        plain(F.round(money("price_today") - money("price_at_order_time"), 2))
        .alias("price_difference"))


def segment_revenue(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("customer_segment")
            .agg(F.count(F.lit(1)).alias("customers"),
                 plain(F.round(_sum("lifetime_value"), 2)).alias("total_revenue"),
                 _avg("lifetime_value").alias("avg_ltv"))
            .orderBy(_down("total_revenue"), "customer_segment"))


def at_risk(customers: DataFrame) -> DataFrame:
    return (customers.filter("customer_segment = 'At Risk'")
            .select("customer_id", "customer_segment", "lifetime_value", "total_orders",
                    "recency_days")
            .orderBy(_down("lifetime_value"), "customer_id"))


def category_aov(revenue: DataFrame) -> DataFrame:
    return (revenue.groupBy("category")
            .agg(_sum("gross_revenue").alias("_r"), F.sum("total_orders").alias("_n"))
            .select("category", plain(per(F.col("_r"), F.col("_n"))).alias("avg_order_value"),
                    plain(F.col("_r")).alias("revenue"))
            .orderBy(_down("avg_order_value"), "category"))


def best_seller(products: DataFrame) -> DataFrame:
    """First by units in each category; a product never sold has none and comes first."""
    order = Window.partitionBy("category").orderBy(_down("total_units_sold"), "product_id")
    return (products.withColumn("rn", F.row_number().over(order)).filter("rn = 1")
            .select("category", "product_name", "total_units_sold", "rn"))


def daily_gmv(revenue: DataFrame) -> DataFrame:
    return (revenue.groupBy("order_date", "category")
            .agg(plain(_sum("gross_revenue")).alias("daily_gmv"))
            .orderBy(_down("order_date"), _down("daily_gmv"), "category"))
