"""Registered queries against their SQL, a few of each kind; `tools/compare.py` runs them all."""

from pathlib import Path

import duckdb
import pytest
from compare import rows as comparable

from __spark_entry__ import entry, oracle_sql, queries
from oracles import oracle_sql as orders_sql
from tidemark.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    db = duckdb.connect()
    for f in Path(SF).glob("*.parquet"):
        db.execute(f"create view {f.stem} as select * from '{f}'")
    return db


def test_every_order_query_has_sql_and_all_sql_runs(db):
    assert set(orders_sql()) == set(QUERIES)
    assert set(oracle_sql()) <= set(queries())
    for name, sql in oracle_sql().items():
        assert db.execute(sql).description, name


def test_entry(spark):
    df = entry(spark)
    assert df.count() > 0 and df.columns[0] == "order_day"


@pytest.mark.parametrize("name", [
    "bronze_quarantine", "stg_order_items", "upsert_merge", "scd2_hard_delete", "fct_reviews",
    "mart_revenue_summary", "mart_product_performance", "rfm_segments", "report_mom_growth",
    "dq_overlap_found", "bronze_variant", "bronze_day", "silver_late", "mart_funnel_kept_up",
    "customers_by_month", "scd2_bucketed", "report_daily_trend_by_month", "job_two_days"])
def test_query_equals_sql(spark, db, name):
    df = queries()[name](spark, SF)
    theirs = db.execute(oracle_sql()[name])
    columns = [c[0] for c in theirs.description]
    assert comparable(df.columns, df.collect()) == comparable(columns, theirs.fetchall())
