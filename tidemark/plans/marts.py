"""Marts. Amounts are summed as decimals; every mart shuffles partial sums, not rows.

Order, line and review ids are unique in the facts and product and customer ids among the current
versions (the quality checks guard this), so counting ids needs no distinct.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions import money, ntz, per, plain, to_day, units
from tidemark.operators import Order, delta, distinct, tile_columns
from tidemark.schemas import STATUSES
from tidemark.session import materialize


def _count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def _percent(part: Column, whole: Column) -> Column:
    return plain(per(part.cast("decimal(20,0)") * 100, whole))


def _mean(total: Column, count: Column) -> Column:
    return plain(total) / F.nullif(count, F.lit(0)).cast("double")


def _calendar(dates: DataFrame) -> DataFrame:
    return dates   # adaptive execution broadcasts it where it proves small


# ── revenue ──────────────────────────────────────────────────────────────────

def order_categories(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lines of each order by the category their product has now."""
    now = products.filter("is_current").select("product_id", "category")
    return (items.select("order_id", "product_id").join(now, "product_id", "left")
            .groupBy("order_id", "category").agg(F.count(F.lit(1)).alias("lines")))


def mart_revenue_summary(orders: DataFrame, items: DataFrame, products: DataFrame,
                         dates: DataFrame) -> DataFrame:
    """Orders by day and category, where an order's total counts once per line of it.

    Lines are counted per order and category first, and the total is multiplied by that count;
    this is the sum over joined lines without joining them, and leaves one distinct count.
    """
    weighted = (
        orders.select("order_id", "customer_id", "order_date_key", "status",
                      money("total_amount").alias("_total"))
        .join(order_categories(items, products), "order_id", "left")
        .withColumn("_w", F.coalesce(F.col("lines"), F.lit(1)))
        .join(_calendar(dates.select(F.col("date_key").alias("order_date_key"),
                                     F.col("full_date").alias("order_date"))),
              "order_date_key", "left"))
    grouped = weighted.groupBy("order_date", "category").agg(
        F.count("order_id").alias("total_orders"),
        F.countDistinct("customer_id").alias("unique_customers"),
        F.sum(F.col("_total") * units("_w")).alias("_gross"),
        F.sum(F.when(F.col("_total").isNotNull(), F.col("_w"))).alias("_lines"),
        _count_if(F.col("status") == "delivered").alias("delivered_orders"),
        _count_if(F.col("status") == "cancelled").alias("cancelled_orders"))
    named = grouped.join(
        _calendar(dates.select(F.col("full_date").alias("order_date"), "year", "quarter", "month",
                               "month_name")), "order_date", "left")
    return named.select(
        "year", "quarter", "month", "month_name", "order_date", "category", "total_orders",
        "unique_customers", plain(F.col("_gross")).alias("gross_revenue"),
        _mean(F.col("_gross"), F.col("_lines")).alias("avg_order_value"),
        "delivered_orders", "cancelled_orders",
        _percent(F.col("cancelled_orders"), F.col("total_orders")).alias("cancellation_rate_pct"))


# ── products ─────────────────────────────────────────────────────────────────

def product_sales(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.sum("quantity").alias("_units"), F.sum(money("line_total")).alias("_revenue"),
        F.sum(money("unit_price")).alias("_prices"), F.count("unit_price").alias("_priced"))


def product_reviews(reviews: DataFrame) -> DataFrame:
    return reviews.groupBy("product_id").agg(
        F.count("review_id").alias("total_reviews"),
        F.sum(F.col("rating").cast("decimal(18,6)")).alias("_ratings"),
        F.count("rating").alias("_rated"),
        _count_if(F.col("sentiment") == "positive").alias("positive_reviews"),
        _count_if(F.col("sentiment") == "negative").alias("negative_reviews"))


def mart_product_performance(products: DataFrame, items: DataFrame,
                             reviews: DataFrame) -> DataFrame:
    return products_of(products, product_sales(items), product_reviews(reviews))


def products_of(products: DataFrame, sales: DataFrame, rated: DataFrame) -> DataFrame:
    """Sales and reviews of each current product, where each line counts once per review.

    Lines and reviews are summed apart and the line sums multiplied by the number of reviews;
    joining them would make lines × reviews rows of a product.
    """
    times = units(F.greatest(F.coalesce(F.col("total_reviews"), F.lit(0)), F.lit(1)))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    revenue = F.col("_revenue") * times
    sold = units("_units")
    profit = (F.col("_revenue") - money("cost_price") * sold) * times
    return (
        products.filter("is_current")
        .select("product_id", F.col("title").alias("product_name"), "category",
                F.col("price").alias("current_price"), "cost_price", "gross_margin")
        .join(sales, "product_id", "left")
        .join(rated, "product_id", "left")
        .select("product_id", "product_name", "category", "current_price", "cost_price",
                "gross_margin", count("total_orders"),
                (F.col("_units") * times.cast("bigint")).alias("total_units_sold"),
                plain(revenue).alias("total_revenue"),
                _mean(F.col("_prices"), F.col("_priced")).alias("avg_selling_price"),
                plain(F.round(profit, 2)).alias("total_profit"), count("total_reviews"),
                plain(per(F.col("_ratings"), F.col("_rated"))).alias("avg_rating"),
                count("positive_reviews"), count("negative_reviews")))


# ── net variants: each line once ─────────────────────────────────────────────

def mart_revenue_net(orders: DataFrame, items: DataFrame, dates: DataFrame) -> DataFrame:
    """Line totals by month and category; lines without an order are left out.

    Lines are summed per order and category first, so an order of any size is one small row.
    """
    lines = items.groupBy("order_id", "category").agg(
        F.sum(money("line_total")).alias("_net"))
    return (lines.join(orders.select("order_id", F.col("order_date_key").alias("date_key")),
                       "order_id")
            .join(_calendar(dates.select("date_key", "year", "month")), "date_key", "left")
            .groupBy("year", "month", "category")
            .agg(plain(F.sum("_net")).alias("net_revenue"),
                 F.count("order_id").alias("total_orders")))


def mart_product_net(items: DataFrame) -> DataFrame:
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("units"), plain(F.sum(money("line_total"))).alias("revenue"))


# ── customers ────────────────────────────────────────────────────────────────

def customer_stats(orders: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Order statistics and RFM values in one pass over the orders.

    RFM values rest on the orders known not to be cancelled and are null for a customer without.
    """
    total, kept = money("total_amount"), F.col("status") != "cancelled"
    sums = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"), F.sum(total).alias("lifetime_value"),
        F.count(total).alias("_paid"),
        F.min("order_date").alias("first_order_date"), F.max("order_date").alias("last_order_date"),
        _count_if(F.col("status") == "delivered").alias("delivered_orders"),
        _count_if(F.col("status") == "cancelled").alias("cancelled_orders"),
        F.max(F.when(kept, F.col("order_date"))).alias("_last_kept"),
        F.nullif(_count_if(kept), F.lit(0)).alias("frequency"),
        F.sum(F.when(kept, total)).alias("monetary"))
    return sums.select(
        "customer_id", "total_orders", "lifetime_value",
        _mean(F.col("lifetime_value"), F.col("_paid")).alias("avg_order_value"),
        "first_order_date", "last_order_date",
        F.datediff("last_order_date", "first_order_date").alias("customer_tenure_days"),
        "delivered_orders", "cancelled_orders",
        F.datediff(to_day(ntz(as_of)), to_day(F.col("_last_kept"))).alias("recency_days"),
        "frequency", "monetary")


def customer_order_stats(orders: DataFrame) -> DataFrame:
    stats = customer_stats(orders, "1970-01-01 00:00:00")
    return (stats.drop("recency_days", "frequency", "monetary")
            .withColumn("lifetime_value", plain(F.col("lifetime_value"))))


def rfm_scores(stats: DataFrame, high_is_good: bool = False) -> DataFrame:
    """Recency, frequency and monetary value in fifths, for customers with an order that counts.

    As given, 1 is the most recent, most frequent and highest fifth; `high_is_good` turns the
    scores round. Other customers keep null scores. `stats` is read several times.
    """
    scores = tile_columns(stats.filter("frequency IS NOT NULL"), "customer_id", {
        "recency_score": Order("recency_days", descending=high_is_good),
        "frequency_score": Order("frequency", descending=not high_is_good),
        "monetary_score": Order("monetary", descending=not high_is_good)})
    counts = F.col("frequency").isNotNull()
    return stats.withColumns({name: F.when(counts, col) for name, col in scores.items()})


def segment(recency: Column, frequency: Column) -> Column:
    """The first rule that holds names the segment; without scores none does."""
    return (F.when((recency >= 4) & (frequency >= 4), "Champion")
            .when((recency >= 3) & (frequency >= 3), "Loyal")
            .when((recency >= 4) & (frequency < 3), "Recent")
            .when((recency < 3) & (frequency >= 3), "At Risk")
            .otherwise("Needs Attention"))


def rfm_score() -> Column:
    points = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return plain(per(points, F.lit(3)))


def mart_customer_orders(customers: DataFrame, orders: DataFrame, as_of: dt.datetime | str,
                         high_is_good: bool = False) -> DataFrame:
    stats = rfm_scores(materialize(customer_stats(orders, as_of), "rfm"), high_is_good)
    stats = stats.withColumns({"lifetime_value": plain(F.col("lifetime_value")),
                               "monetary": plain(F.col("monetary"))})
    return (
        customers.filter("is_current")
        .select("customer_id", "full_name", "email", "city", "state", "country")
        .join(stats, "customer_id", "left")
        .withColumn("rfm_score", rfm_score())
        .withColumn("customer_segment", segment(F.col("recency_score"), F.col("frequency_score"))))


# ── funnel ───────────────────────────────────────────────────────────────────

def _funnel_values() -> dict[str, Column]:
    status = F.col("status")
    return {**{s: F.when(status == s, 1).otherwise(0).cast("long") for s in STATUSES},
            "total_orders": F.when(F.col("order_id").isNotNull(), 1).otherwise(0).cast("long"),
            "_delivered": F.when(status == "delivered", money("total_amount"))}


FUNNEL_DAY = ["order_day"]


def funnel_state(orders: DataFrame) -> DataFrame:
    """The sums that the funnel is made of, by day."""
    return delta.sums(orders, {"order_day": to_day(F.col("order_date"))}, _funnel_values())


def funnel_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What these sums gain when some orders are replaced, added or taken away."""
    return delta.changes(before, after, {"order_day": to_day(F.col("order_date"))}, _funnel_values())


def funnel_of(state: DataFrame) -> DataFrame:
    return state.select(
        "order_day", "total_orders", *STATUSES,
        plain(F.col("_delivered")).alias("delivered_revenue"),
        _percent(F.col("delivered"), F.col("total_orders")).alias("delivery_rate_pct"),
        _percent(F.col("cancelled"), F.col("total_orders")).alias("cancellation_rate_pct"),
    ).orderBy("order_day")


def mart_order_funnel(orders: DataFrame) -> DataFrame:
    return funnel_of(funnel_state(orders))


# ── customers of a period, from those of its days ────────────────────────────

def customer_bitmaps(orders: DataFrame) -> DataFrame:
    """The customers of each day as bitmaps, to be stored by day and merged to any period."""
    return distinct.bitmaps(orders.select(to_day(F.col("order_date")).alias("order_day"), "customer_id"),
                            ["order_day"], "customer_id")


def customers_by_month(daily: DataFrame) -> DataFrame:
    monthly = distinct.merged(daily, year="year(order_day)", month="month(order_day)")
    return distinct.counts(monthly, ["year", "month"], "customers")
