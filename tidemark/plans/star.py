"""All layers over given raw tables, as lazy DataFrames: two days of history, then the star."""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans import gold, marts, silver
from tidemark.sources import testdata

# Fixed values for the test tables: the calendar, and the present of reports and of the monitor.
CALENDAR = ("1995-01-01", "2025-01-01")
REPORT_AT = "2001-08-02 12:00:00"
MONITOR_AT = "2026-01-02 12:30:00"


class Star:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cache
    def raw(self, entity: str, until: int = 2) -> DataFrame:
        return testdata.raw(self.spark, self.sf_dir, entity, until)

    @cache
    def stg(self, entity: str, until: int = 2) -> DataFrame:
        return silver.CLEAN[entity](self.raw(entity, until))

    def _history(self, entity: str, grow) -> DataFrame:
        history = None
        for day in (1, 2):
            history = grow(history, self.stg(entity, day), testdata.RUN_AT[day])
        return history

    @cached_property
    def dim_customers(self) -> DataFrame:
        return gold.dim_customers(self._history("customers", gold.customer_history))

    @cached_property
    def dim_products(self) -> DataFrame:
        return gold.dim_products(self._history("products", gold.product_history))

    @cached_property
    def dim_date(self) -> DataFrame:
        return gold.dim_date(gold.day_spine(self.spark, *CALENDAR))

    @cached_property
    def fct_orders(self) -> DataFrame:
        return gold.fct_orders(self.stg("orders"), self.dim_customers, self.dim_date)

    @cached_property
    def fct_order_items(self) -> DataFrame:
        return gold.fct_order_items(self.stg("order_items"), self.dim_products)

    @cached_property
    def fct_reviews(self) -> DataFrame:
        return gold.fct_reviews(
            self.stg("reviews"), self.dim_customers, self.dim_products, self.dim_date)

    # The marts use no column that the facts look up in a dimension, and a look-up of the unique
    # current version adds or drops no row. Where the facts are not stored, the marts are therefore
    # fed without these joins. (The daily job feeds them the stored facts.)

    @cached_property
    def dated_orders(self) -> DataFrame:
        return gold.dated_orders(self.stg("orders"), self.dim_date)

    @cached_property
    def revenue(self) -> DataFrame:
        return marts.mart_revenue_summary(
            self.dated_orders, self.stg("order_items"), self.dim_products, self.dim_date)

    @cached_property
    def products(self) -> DataFrame:
        return marts.mart_product_performance(
            self.dim_products, self.stg("order_items"), gold.rated_reviews(self.stg("reviews")))

    @cached_property
    def customers(self) -> DataFrame:
        return marts.mart_customer_orders(self.dim_customers, self.stg("orders"), REPORT_AT)

    @cached_property
    def funnel(self) -> DataFrame:
        return marts.mart_order_funnel(self.stg("orders"))

    def table(self, name: str) -> DataFrame:
        if name.startswith("raw_"):
            return self.raw(name.removeprefix("raw_"))
        if name.startswith("stg_"):
            return self.stg(name.removeprefix("stg_"))
        return getattr(self, {
            "mart_revenue_summary": "revenue", "mart_product_performance": "products",
            "mart_customer_orders": "customers", "mart_order_funnel": "funnel"}.get(name, name))

    def tables(self, names) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}
