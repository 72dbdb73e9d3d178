import datetime as dt

import pytest
from conftest import plan, rows
from pyspark.sql import Window, functions as F

from tidemark.plans import gold, marts, reports
from tidemark.plans.star import REPORT_AT, Star

D = dt.datetime
SF = "/root/testdata/sf0.001"
AS_OF = "2026-02-01 00:00:00"


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, SF)


@pytest.fixture(scope="module")
def tiny(spark):
    """Products without items, without reviews, with both; orders without items, of two
    categories, outside the calendar, cancelled only, without a status."""
    make = spark.createDataFrame
    t = {}
    t["dates"] = gold.dim_date(gold.day_spine(spark, "2026-01-01", "2026-02-01"))
    t["products"] = make(
        [(1, "A", "x", 10.0, 6.0, 4.0, True), (1, "A", "old", 9.0, 6.0, 3.0, False),
         (2, "B", "y", 20.0, 9.5, 10.5, True), (3, "C", "y", 5.0, None, None, True),
         (4, "D", "z", 1.0, 0.5, 0.5, True)],
        "product_id long, title string, category string, price double, cost_price double, "
        "gross_margin double, is_current boolean").withColumn("product_key", F.col("product_id"))
    t["customers"] = make(
        [(1, "Ann", True), (1, "Anna", False), (2, "Bob", True), (3, "Cid", True), (4, "Dot", True),
         (5, "Eve", True)],
        "customer_id long, full_name string, is_current boolean").select(
        F.col("customer_id").alias("customer_key"), "customer_id", "full_name", "is_current",
        *(F.lit("-").alias(c) for c in ("email", "city", "state", "country")))
    t["stg_orders"] = make(
        [(1, 1, D(2026, 1, 2, 10), "delivered", 100.10), (2, 1, D(2026, 1, 2, 23), "cancelled", 50.0),
         (3, 2, D(2026, 1, 3), "shipped", 70.0), (4, 3, D(2026, 1, 3), "cancelled", 30.0),
         (5, 4, D(2027, 1, 1), "pending", 20.0), (6, 9, D(2026, 1, 3), None, 5.0),
         (7, 4, D(2025, 1, 1), "delivered", 1.0)],
        "order_id long, customer_id long, order_date timestamp_ntz, status string, "
        "total_amount double").select(
        "*", *(F.lit(None).cast("string").alias(c) for c in ("payment_method", "shipping_city")),
        F.col("order_date").alias("updated_at"), F.col("order_date").alias("_extracted_at"))
    t["orders"] = gold.fct_orders(t["stg_orders"], t["customers"], t["dates"])
    t["stg_items"] = make(
        [(1, 1, 1, 2, 10.0, 20.0), (2, 1, 1, 1, 11.0, 11.0), (3, 1, 2, 1, 19.99, 19.99),
         (4, 3, 3, 4, 5.0, 20.0), (5, 8, 2, 1, 20.0, 20.0), (6, 3, 77, 1, 1.0, 1.0),
         (7, 2, None, 1, 1.0, 1.0)],
        "order_item_id long, order_id long, product_id long, quantity long, unit_price double, "
        "line_total double").select(
        "*", F.col("line_total").alias("calculated_line_total"),
        F.lit(D(2026, 1, 3)).alias("_extracted_at"))
    t["items"] = gold.fct_order_items(t["stg_items"], t["products"])
    t["reviews"] = gold.fct_reviews(make(
        [(1, 1, 1, 1, 4.0), (2, 1, 1, 2, 2.9), (3, 1, 1, 1, 3.0), (4, 3, 4, 9, 5.0), (5, 3, 4, 1, None)],
        "review_id long, order_id long, product_id long, customer_id long, rating double").select(
        "*", F.lit("t").alias("review_text"), F.lit(D(2026, 1, 9, 5)).alias("reviewed_at"),
        F.lit(D(2026, 1, 9)).alias("_extracted_at")), t["customers"], t["products"], t["dates"])
    return t


def same(mine, theirs):
    assert rows(mine, *theirs.columns) == rows(theirs)


def test_facts_look_up_the_current_version_once(tiny):
    assert tiny["orders"].count() == 7
    assert rows(tiny["orders"].filter("order_id IN (1, 5, 6)"), "order_id", "customer_key",
                "order_date_key") == [(1, 1, 20260102), (5, 4, None), (6, None, 20260103)]
    assert rows(tiny["items"].filter("order_item_id IN (1, 6)"), "category", "current_price") == [
        ("x", 10.0), (None, None)]


def test_sentiment_and_names(tiny):
    assert rows(tiny["reviews"], "review_id", "sentiment", "customer_name", "review_date_key") == [
        (1, "positive", "Ann", 20260109), (2, "negative", "Bob", 20260109),
        (3, "neutral", "Ann", 20260109), (4, "positive", None, 20260109),
        (5, "negative", "Ann", 20260109)]


def test_revenue_equals_the_fan_out(tiny):
    got = marts.mart_revenue_summary(
        tiny["orders"], tiny["items"], tiny["products"], tiny["dates"])
    # an order's total once for each of its lines, as joining orders with lines gives it
    fan = (tiny["orders"].join(tiny["items"].select("order_id", "product_id"), "order_id", "left")
           .join(tiny["products"].filter("is_current").select("product_id", "category"),
                 "product_id", "left")
           .groupBy("order_date_key", "category").agg(F.sum("total_amount").alias("gross")))
    assert sorted(round(r.gross, 2) for r in fan.collect()) == sorted(
        round(r.gross_revenue, 2) for r in got.collect())
    outside = got.filter("order_date IS NULL").first()
    assert (outside.total_orders, outside.gross_revenue, outside.year) == (2, 21.0, None)


def test_revenue_shares_are_of_the_group(tiny):
    got = marts.mart_revenue_summary(
        tiny["orders"], tiny["items"], tiny["products"], tiny["dates"])
    day = {r.category: r for r in got.filter("order_date = '2026-01-02'").collect()}
    assert day["x"].gross_revenue == 200.20 and day["x"].total_orders == 1
    assert day[None].cancellation_rate_pct == 100.0


def test_product_performance_equals_the_fan_out(tiny):
    got = marts.mart_product_performance(tiny["products"], tiny["items"], tiny["reviews"])
    by_id = {r.product_id: r for r in got.collect()}
    assert by_id[1].total_units_sold == 9            # 3 units, counted for each of 3 reviews
    assert by_id[3].total_profit is None             # cost unknown
    assert (by_id[4].total_orders, by_id[4].total_revenue, by_id[4].avg_rating) == (0, None, 5.0)


def test_customers(tiny):
    got = marts.mart_customer_orders(tiny["customers"], tiny["orders"], AS_OF)
    by_id = {r.customer_id: r for r in got.collect()}
    assert len(by_id) == 5
    assert by_id[3].total_orders == 1 and by_id[3].frequency is None     # cancelled only
    assert by_id[3].recency_score is None and by_id[3].customer_segment == "Needs Attention"
    assert by_id[5].total_orders is None and by_id[5].customer_segment == "Needs Attention"


def test_tiles_equal_those_of_the_built_in_window(star):
    got = marts.mart_customer_orders(star.dim_customers, star.fct_orders, REPORT_AT)
    stats = marts.customer_stats(star.fct_orders, REPORT_AT).filter("frequency IS NOT NULL")
    tile = lambda order: F.ntile(5).over(Window.orderBy(order, "customer_id"))
    want = stats.select("customer_id", tile(F.col("recency_days")).alias("r"),
                        tile(F.col("frequency").desc()).alias("f"), tile(F.col("monetary").desc()).alias("m"))
    current = star.dim_customers.filter("is_current").select("customer_id")
    same(got.filter("frequency IS NOT NULL").selectExpr(
        "customer_id", "recency_score AS r", "frequency_score AS f", "monetary_score AS m"),
        want.join(current, "customer_id", "left_semi"))


def test_net_variants_count_lines_once(tiny):
    net = marts.mart_revenue_net(tiny["orders"], tiny["items"], tiny["dates"])
    assert rows(net, "category", "net_revenue", "total_orders") == [
        ("x", 31.0, 1), ("y", 39.99, 2), (None, 2.0, 2)]
    assert rows(marts.mart_product_net(tiny["items"]).filter("product_id = 1")) == [(1, 3, 31.0)]


def test_funnel(tiny):
    by_day = {str(r.order_day): r for r in marts.mart_order_funnel(tiny["orders"]).collect()}
    day = by_day["2026-01-02"]
    assert (day.total_orders, day.delivered, day.cancelled, day.pending) == (2, 1, 1, 0)
    assert (day.delivered_revenue, day.delivery_rate_pct) == (100.10, 50.0)
    third = by_day["2026-01-03"]      # three orders, one without a status
    assert (third.total_orders, third.cancellation_rate_pct, third.delivered_revenue) == (3, 33.33, 0)
    assert list(by_day) == sorted(by_day)


@pytest.mark.parametrize("r, f, name", [
    (5, 5, "Champion"), (4, 4, "Champion"), (3, 3, "Loyal"), (5, 3, "Loyal"), (3, 5, "Loyal"),
    (4, 2, "Recent"), (5, 1, "Recent"), (2, 3, "At Risk"), (1, 5, "At Risk"),
    (3, 2, "Needs Attention"), (1, 1, "Needs Attention"), (None, None, "Needs Attention")])
def test_segments(frame, r, f, name):
    df = frame([(r, f)], "r int, f int")
    assert df.select(marts.segment(F.col("r"), F.col("f"))).first()[0] == name


def test_scores_can_be_turned_round(star):
    plain, turned = (
        marts.mart_customer_orders(star.dim_customers, star.fct_orders, REPORT_AT, high_is_good=h)
        .filter("frequency IS NOT NULL") for h in (False, True))
    best = plain.orderBy("recency_days", "customer_id").first().customer_id
    assert plain.filter(f"customer_id = {best}").first().recency_score == 1
    assert turned.filter(f"customer_id = {best}").first().recency_score == 5


def test_revenue_plan_has_no_expand_and_one_distinct(star):
    text = plan(star.revenue)
    physical = text[text.index("== Physical Plan =="):]
    assert "Expand" not in physical and "CartesianProduct" not in physical
    assert "BroadcastNestedLoopJoin" not in physical


def test_scan_reads_only_what_a_mart_needs(star):
    text = plan(marts.mart_order_funnel(star.stg("orders")))
    physical = text[text.index("== Physical Plan =="):]
    assert "o_orderstatus" in physical and "n_name" not in physical


def test_calendar_bounds_and_attributes(spark):
    days = gold.day_spine(spark, "2026-02-27", "2026-03-02")
    assert [str(r[0]) for r in days.collect()] == ["2026-02-27", "2026-02-28", "2026-03-01"]
    assert gold.day_spine(spark, "2026-02-27", "2026-03-02", include_end=True).count() == 4
    assert gold.day_spine(spark).count() == 1460
    got = rows(gold.dim_date(days))
    assert got[-1] == (20260301, dt.date(2026, 3, 1), 2026, 1, 3, "Mar", 9, 1, "Sun", 0, True, "Spring")
    assert got[0][5:] == ("Feb", 9, 27, "Fri", 5, False, "Winter")


# ── reports ──────────────────────────────────────────────────────────────────

def test_unsold_products_come_first_downwards(tiny):
    products = marts.mart_product_performance(tiny["products"], tiny["items"], tiny["reviews"])
    assert reports.top_products(products, 1).first().product_name == "D"
    assert rows(reports.best_seller(products), "category", "product_name") == [
        ("x", "A"), ("y", "C"), ("z", "D")]


def test_growth_is_against_the_previous_present_month(frame):
    revenue = frame([(2026, 1, "Jan", "x", 100.0, 1), (2026, 3, "Mar", "x", 50.0, 1),
                     (2026, 4, "Apr", "x", 0.0, 1), (2026, 5, "May", "x", 10.0, 1)],
                    "year int, month int, month_name string, category string, "
                    "gross_revenue double, total_orders long")
    got = [(r.month, r.revenue_growth_pct) for r in reports.month_over_month(revenue).collect()]
    assert got == [(5, None), (4, -100.0), (3, -50.0), (1, None)]


def test_trend_starts_thirty_days_back(frame):
    revenue = frame([(dt.date(2026, 1, d), 10.0, 3) for d in (1, 2, 3)] + [(None, 1.0, 1)],
                    "order_date date, gross_revenue double, total_orders long")
    got = reports.daily_trend(revenue, "2026-02-01 08:00:00").collect()
    assert [(str(r.order_date), r.avg_order_value) for r in got] == [
        ("2026-01-03", 3.33), ("2026-01-02", 3.33)]


def test_price_history_lists_products_with_several_versions(tiny):
    versions = tiny["products"].withColumn("dbt_valid_from", F.lit(D(2026, 1, 1))).withColumn(
        "dbt_valid_to", F.when(~F.col("is_current"), F.lit(D(2026, 1, 2))))
    got = reports.price_history(versions)
    assert rows(got, "product_id", "historical_price", "record_status") == [
        (1, 10.0, "current"), (1, 9.0, "historical")]


def test_price_delta_limits_lines_before_the_join(tiny):
    got = reports.price_delta(tiny["items"], tiny["products"], n=3)
    assert rows(got, "order_item_id", "price_difference") == [(1, 0.0), (2, -1.0), (3, 0.01)]
    assert reports.price_delta(tiny["items"], tiny["products"], n=None).count() == 7


def test_results_are_rounded_and_not_what_goes_in(frame):
    """Amounts whose third decimal matters before a multiplication or a difference."""
    from tidemark.plans import reports, silver
    at = "TIMESTAMP_NTZ '2026-01-01 00:00:00'"
    raw = frame([(1, 1, 1, 1000, 0.125, 125.0), (2, 1, 1, 1, 1e17, 1e17), (3, 1, 1, 1, 1e25, 1.0)],
                "order_item_id long, order_id long, product_id long, quantity long, "
                "unit_price double, line_total double").selectExpr("*", f"{at} AS _extracted_at")
    lines = {r.order_item_id: r.calculated_line_total for r in silver.order_items(raw).collect()}
    assert lines == {1: 125.0, 2: 1e17, 3: None}
    raw = frame([(1, "a", "b", 1.005, 0.004)], "product_id long, title string, category string, "
                "price double, cost_price double").selectExpr(
        "*", "1L AS stock_quantity", "1D AS rating", "1L AS review_count", f"{at} AS updated_at",
        f"{at} AS _extracted_at")
    assert silver.products(raw).first().gross_margin == 1.0
    products = frame([(1, "a", "b", 1.005, 0.125, 1.0, True)], "product_id long, title string, "
                     "category string, price double, cost_price double, gross_margin double, "
                     "is_current boolean")
    sold = frame([(1, 1, 1, 1000, 0.004, 200.0)], "order_item_id long, order_id long, "
                 "product_id long, quantity long, unit_price double, line_total double")
    none = frame([], "review_id long, product_id long, rating double, sentiment string")
    row = marts.mart_product_performance(products, sold, none).first()
    assert (row.total_profit, row.total_revenue) == (75.0, 200.0)
    assert reports.price_delta(sold, products).first().price_difference == 1.0
