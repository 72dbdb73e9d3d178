"""All queries by name, over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce, wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import advance, delta, distinct, is_current, latest
from tidemark.operators.history import DIGEST, save_open
from tidemark.plans import gold, marts, monitor, quality, reports
from tidemark.plans.star import MONITOR_AT, REPORT_AT, Star
from tidemark.schemas import STATUSES
from tidemark.session import materialize, scratch_path
from tidemark.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def shown(df: DataFrame) -> DataFrame:
    """Days and times as text, exact numbers as double, whole numbers as long."""
    def show(f: T.StructField):
        col = F.col(f.name)
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            return col.cast("string").alias(f.name)
        if isinstance(f.dataType, T.DecimalType):
            return col.cast("double").alias(f.name)
        if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            return col.cast("long").alias(f.name)
        return col
    return df.select(*(show(f) for f in df.schema.fields))


def query(name: str):
    """Register a function of a `Star` as a query."""
    def register(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shown(build(Star(spark, sf_dir)))
        QUERIES[name] = run
        return build
    return register


# ── silver, dimensions, facts, marts: tables by their own name ───────────────

for _name in ("stg_customers", "stg_products", "stg_orders", "stg_order_items", "stg_reviews",
              "dim_customers", "dim_products", "fct_orders", "fct_order_items", "fct_reviews",
              "mart_revenue_summary", "mart_product_performance", "mart_customer_orders",
              "mart_order_funnel"):
    query(_name)(lambda s, n=_name: s.table(n))


@query("dim_date")
def _dim_date(s: Star) -> DataFrame:
    orders = testdata.table(s.spark, s.sf_dir, "orders")
    return gold.dim_date(gold.day_spine_of(orders, "o_orderdate"))


@query("dedup_latest")
def _dedup(s: Star) -> DataFrame:
    return latest(s.raw("order_items"), "order_item_id")


# ── history ──────────────────────────────────────────────────────────────────

def _three_days(s: Star, entity: str, grow, vanish=None) -> DataFrame:
    history = None
    for day in (1, 2, 3):
        stg = s.stg(entity, day)
        if vanish and day == 2:
            stg = vanish(stg)
        history = grow(history, stg, testdata.RUN_AT[day])
        if day == 2:   # read twice by the next run: stored, as a history is between runs
            history = materialize(history, "history")
    return history


@query("scd2_customers")
def _scd2_customers(s: Star) -> DataFrame:
    return _three_days(s, "customers", gold.customer_history)


@query("scd2_products")
def _scd2_products(s: Star) -> DataFrame:
    return _three_days(s, "products", gold.product_history)


@query("scd2_hard_delete")
def _scd2_hard_delete(s: Star) -> DataFrame:
    gone = testdata.table(s.spark, s.sf_dir, "customer").filter(
        "c_mktsegment = 'HOUSEHOLD'").select(F.col("c_custkey").alias("customer_id"))
    return _three_days(s, "customers", gold.customer_history,
                       vanish=lambda stg: stg.join(gone, "customer_id", "left_anti"))


@query("scd2_current")
def _scd2_current(s: Star) -> DataFrame:
    return gold.dim_customers(_scd2_customers(s)).select(
        "customer_id", "dbt_scd_id", "dbt_valid_from", "is_current")


@query("scd2_bucketed")
def _scd2_bucketed(s: Star) -> DataFrame:
    """Open versions lie in buckets of their key between the runs, closed ones apart."""
    key, checks, live, closed = "customer_id", gold.CUSTOMER_CHECKS, None, []
    for day in (1, 2, 3):
        name = f"open_versions_{uuid.uuid4().hex}"
        rows = materialize(advance(live, s.stg("customers", day), key, checks, testdata.RUN_AT[day]),
                           "history")
        closed.append(rows.filter(~is_current()))
        live = save_open(rows.filter(is_current()), name, scratch_path(s.spark, name), key, checks, 8)
    return reduce(DataFrame.unionByName, closed).unionByName(live.drop(DIGEST))


# ── parts of marts, net variants ─────────────────────────────────────────────

@query("customer_order_stats")
def _order_stats(s: Star) -> DataFrame:
    return marts.customer_order_stats(s.stg("orders"))


def _rfm(s: Star) -> DataFrame:
    stats = materialize(marts.customer_stats(s.stg("orders"), REPORT_AT), "rfm")
    return marts.rfm_scores(stats).filter("frequency IS NOT NULL")


@query("rfm_scores")
def _rfm_scores(s: Star) -> DataFrame:
    return _rfm(s).select("customer_id", "recency_days", "frequency", "monetary",
                          "recency_score", "frequency_score", "monetary_score")


@query("rfm_segments")
def _rfm_segments(s: Star) -> DataFrame:
    return _rfm(s).select(
        "customer_id", "recency_score", "frequency_score", "monetary_score",
        marts.rfm_score().alias("rfm_score"),
        marts.segment(F.col("recency_score"), F.col("frequency_score")).alias("customer_segment"))


@query("mart_revenue_net")
def _revenue_net(s: Star) -> DataFrame:
    return marts.mart_revenue_net(s.dated_orders, s.fct_order_items, s.dim_date)


@query("mart_product_net")
def _product_net(s: Star) -> DataFrame:
    return marts.mart_product_net(s.stg("order_items"))


@query("mart_funnel_kept_up")
def _funnel_kept_up(s: Star) -> DataFrame:
    """The funnel of day 1, brought up to day 2 by the orders that day has changed or added."""
    old, now = s.stg("orders", 1), s.stg("orders")
    state = materialize(marts.funnel_state(old), "funnel")
    new = materialize(now.filter(F.col("_extracted_at") > F.lit(testdata.DAYS[1]).cast("timestamp_ntz")), "new")
    replaced = old.join(new.select("order_id"), "order_id", "left_semi")
    gained = materialize(marts.funnel_changes(replaced, new), "gained")
    return marts.funnel_of(delta.kept_up(state, gained, marts.FUNNEL_DAY))


@query("customers_by_month")
def _customers_by_month(s: Star) -> DataFrame:
    """From bitmaps by day, of which those of late orders are merged in."""
    orders = s.stg("orders")
    late = F.col("order_id") % 10 == 0
    daily = marts.customer_bitmaps(orders.filter(~late)).unionByName(
        marts.customer_bitmaps(orders.filter(late)))
    return marts.customers_by_month(distinct.merged(daily, order_day="order_day"))


# ── reports ──────────────────────────────────────────────────────────────────

query("report_daily_trend")(lambda s: reports.daily_trend(s.revenue, REPORT_AT))
@query("report_daily_trend_by_month")
def _trend_by_month(s: Star) -> DataFrame:
    stored = gold.write_by_month(s.revenue, "order_date", scratch_path(s.spark, "revenue"))
    return reports.daily_trend_by_month(stored, s.dim_date, REPORT_AT)


query("report_top_products")(lambda s: reports.top_products(s.products))
query("report_segment_mix")(lambda s: reports.segment_mix(s.customers))
query("report_price_history")(lambda s: reports.price_history(s.dim_products))
query("report_mom_growth")(lambda s: reports.month_over_month(s.revenue))
query("report_price_delta")(lambda s: reports.price_delta(s.fct_order_items, s.dim_products))
query("report_price_delta_all")(
    lambda s: reports.price_delta(s.fct_order_items, s.dim_products, n=None))
query("report_segment_revenue")(lambda s: reports.segment_revenue(s.customers))
query("report_at_risk")(lambda s: reports.at_risk(s.customers))
query("report_category_aov")(lambda s: reports.category_aov(s.revenue))
query("report_best_seller")(lambda s: reports.best_seller(s.products))
query("report_daily_gmv")(lambda s: reports.daily_gmv(s.revenue))


# ── checks: over the tables they guard, and over raw ones that have findings ──

@query("dq_not_null")
def _not_null(s: Star) -> DataFrame:
    columns = {**quality.NOT_NULL["silver"], **quality.NOT_NULL["gold"]}
    return quality.not_null(s.tables(columns), columns)


@query("dq_unique")
def _unique(s: Star) -> DataFrame:
    columns = {**quality.UNIQUE["silver"], **quality.UNIQUE["gold"],
               "raw_customers": ["customer_id"], "raw_order_items": ["order_item_id"]}
    return quality.unique(s.tables(columns), columns)


@query("dq_accepted_values")
def _accepted(s: Star) -> DataFrame:
    columns = {**quality.ACCEPTED["silver"], **quality.ACCEPTED["gold"],
               "raw_orders": {"status": STATUSES}}
    return quality.accepted_values(s.tables(columns), columns)


query("dq_relationships")(lambda s: quality.relationships(
    s.fct_order_items, "order_id", s.fct_orders, "order_id"))
query("dq_duplicate_current")(lambda s: quality.duplicate_current(s.dim_customers))
query("dq_duplicate_current_found")(lambda s: quality.duplicate_current(
    s.raw("customers").withColumn("is_current", F.lit(True))))
query("dq_future_orders")(lambda s: quality.future_orders(s.fct_orders, "2001-01-01 00:00:00"))
query("dq_orphan_items")(lambda s: quality.orphan_items(s.fct_order_items, s.fct_orders))
query("dq_revenue_positive")(lambda s: quality.revenue_positive(s.raw("orders")))
query("dq_scd2_overlap")(lambda s: quality.history_overlap(s.dim_customers))
query("dq_rating_range")(lambda s: quality.rating_range(s.raw("reviews")))
query("gate_row_counts")(lambda s: quality.row_counts(s.tables(quality.GATE)))


@query("dq_overlap_found")
def _overlap_found(s: Star) -> DataFrame:
    """Lines as spans of an item, of which many overlap; the largest ones never end."""
    start = F.col("_extracted_at")
    spans = s.raw("order_items").select(
        "order_item_id", start.alias("dbt_valid_from"),
        F.when(F.col("quantity") < 45, start + F.make_dt_interval(F.col("quantity").cast("int") * 8))
        .alias("dbt_valid_to"),
        F.md5(F.concat_ws("|", "product_id", "quantity", start)).alias("dbt_scd_id"))
    return quality.overlapping_versions(spans, "order_item_id")


@query("pipeline_health")
def _health(s: Star) -> DataFrame:
    names = [n for layer in monitor.LAYERS.values() for n in layer]
    return monitor.pipeline_health(s.tables(names), MONITOR_AT)


@query("source_freshness")
def _freshness(s: Star) -> DataFrame:
    return monitor.source_freshness(s.tables(monitor.LAYERS["bronze"]), MONITOR_AT)
