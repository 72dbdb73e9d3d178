"""The whole job over two days, from files to monitor, and its gates."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.plans import job, marts, quality
from tidemark.plans.quality import CheckFailed
from tidemark.schemas import ENTITIES
from tidemark.sources import ndjson, testdata

SF = "/root/testdata/sf0.001"
RUNS = [dt.datetime(2026, 1, 1, 6), dt.datetime(2026, 1, 2, 6)]


def land_day(spark, landing, day):
    """Sound data: whole snapshots, positive totals, lines of orders that exist."""
    orders = testdata.orders_on(spark, SF, day).withColumn("total_amount", F.abs("total_amount") + 1)
    stamped = lambda df: ndjson.stamp(df, f"{testdata.DAYS[day]} 00:00:00")
    batches = {"customers": testdata.customers_on(spark, SF, day),
               "products": testdata.products_on(spark, SF, day), "orders": orders}
    if day == 1:
        lines = testdata.order_items(spark, SF).dropDuplicates(["order_item_id"])
        batches["order_items"] = stamped(lines.join(orders, "order_id", "left_semi"))
        batches["reviews"] = stamped(testdata.reviews(spark, SF))
    for name, df in batches.items():
        ndjson.write_ndjson(df, landing, ENTITIES[name], dt.date.fromisoformat(testdata.DAYS[day]))


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    lake = job.Lakehouse(spark, str(root / "landing"), str(root / "tables"),
                         ("1995-01-01", "2025-01-01"), chunk_rows=2_000)
    land_day(spark, lake.landing, 1)
    job.run_day(lake, RUNS[0])
    land_day(spark, lake.landing, 2)
    job.run_day(lake, RUNS[1])
    return lake


def test_history_holds_both_days(lake, spark):
    moved = testdata.table(spark, SF, "customer").filter("c_mktsegment = 'BUILDING'").count()
    history = lake.table("snap_customers")
    assert history.filter("dbt_valid_to IS NOT NULL").count() == moved > 0
    assert history.filter("city = 'New-Town East'").count() == moved
    assert lake.table("dim_customers").filter("is_current").count() == 150


def test_orders_are_updated_and_added(lake):
    facts = lake.table("fct_orders")
    assert facts.count() == facts.select("order_id").distinct().count()
    assert facts.filter(f"order_id >= {testdata.NEW_ORDER_IDS}").count() > 0
    assert facts.filter("shipping_city = '1-Urgent'").select("status").distinct().collect() == [
        ("delivered",)]
    assert rows(lake.table("stg_orders"), "order_id", "status") == rows(facts, "order_id", "status")


def test_marts_are_built_from_the_last_state(lake):
    assert lake.table("mart_customer_orders").count() == 150
    total = lake.table("mart_order_funnel").agg(F.sum("total_orders")).first()[0]
    assert total == lake.table("fct_orders").count()


def test_the_funnel_is_kept_up_by_change(lake, monkeypatch):
    """What two days have left is what all facts give, and the second day did not read them all."""
    state = lake.store("funnel_state")
    assert state.version() == 2 and state.noted()[job.TAKEN] == lake.store("fct_orders").version()
    assert rows(lake.table("mart_order_funnel")) == rows(
        marts.mart_order_funnel(lake.table("fct_orders")))
    monkeypatch.setattr(marts, "funnel_state", None)      # nothing is made anew without need
    assert job.keep_funnel(lake, None).count() == state.rows()


def test_late_and_forced_rows_reach_the_facts(lake, spark):
    """Older than all that the facts hold, under an id that is new."""
    late = (testdata.orders_on(spark, SF, 1).limit(1)
            .withColumn("order_id", F.lit(5_000_000_000)).withColumn("total_amount", F.lit(7.125)))
    ndjson.write_ndjson(ndjson.stamp(late, "2025-12-01 00:00:00"), lake.landing, ENTITIES["orders"],
                        dt.date(2025, 12, 1))
    before = lake.table("fct_orders").count()
    job.run_day(lake, RUNS[1] + dt.timedelta(hours=2))
    got = lake.table("fct_orders")
    assert got.count() == before + 1
    assert got.filter("order_id = 5000000000").first().total_amount == 7.125
    assert rows(lake.table("mart_order_funnel")) == rows(marts.mart_order_funnel(got))


def test_settled_checks_cost_no_job(lake, spark):
    """Gate, monitor and freshness read the notes of the writers; checks of nulls and values read
    nothing, so a layer takes the jobs of its uniqueness and key checks alone."""
    sc = spark.sparkContext
    reads = []
    kept = job.Lakehouse.table
    try:
        job.Lakehouse.table = lambda self, name: reads.append(name) or kept(self, name)
        sc.setJobGroup("watch", "watch")
        job.watch_layers(lake, RUNS[1])
    finally:
        job.Lakehouse.table = kept
        sc.setJobGroup("rest", "rest")
    assert reads == ["monitoring_pipeline_health"]
    watched = {n: lake.store(n).watched() for n in quality.NOT_NULL["silver"]}
    found = quality.column_checks(lake.tables(quality.NOT_NULL["silver"]), "silver", watched)
    assert set(found) == {"unique"}
    sc.setJobGroup("checks", "checks")
    quality.require_none(found)
    jobs = len(sc.statusTracker().getJobIdsForGroup("checks"))
    sc.setJobGroup("rest", "rest")
    assert 0 < jobs <= 2 * len(quality.UNIQUE["silver"]) + 2


def test_health_covers_all_layers(lake):
    health = {r.table_name: r for r in lake.table("monitoring_pipeline_health").collect()}
    assert len(health) == 11
    assert health["fct_orders"].freshness_status == "healthy"
    assert health["fct_order_items"].freshness_status == "warning"


def test_a_run_without_new_files_changes_nothing(lake):
    before = {n: rows(lake.table(n)) for n in ("snap_customers", "fct_orders", "mart_order_funnel")}
    job.run_day(lake, RUNS[1] + dt.timedelta(hours=1))
    assert {n: rows(lake.table(n)) for n in before} == before


def test_a_failed_check_stops_the_job(lake, spark):
    bad = testdata.orders_on(spark, SF, 1).limit(1).withColumn("status", F.lit("lost"))
    bad = ndjson.stamp(bad.withColumn("total_amount", F.lit(1.0)), "2026-01-03 00:00:00")
    ndjson.write_ndjson(bad, lake.landing, ENTITIES["orders"], dt.date(2026, 1, 3))
    before = rows(lake.table("fct_orders"))
    with pytest.raises(CheckFailed, match="accepted_values.*lost"):
        job.run_day(lake, dt.datetime(2026, 1, 3, 6))
    assert rows(lake.table("fct_orders")) == before


def test_a_day_without_reviews_and_lines(spark, tmp_path):
    lake = job.Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"),
                         ("1995-01-01", "2025-01-01"))
    land_day(spark, lake.landing, 2)
    job.load(lake, RUNS[1])
    job.clean(lake)
    job.keep_history(lake, RUNS[1])
    job.check_layer(lake, "silver")
    job.build_star(lake)
    job.build_marts(lake, RUNS[1])
    assert lake.table("stg_reviews").count() == lake.table("fct_order_items").count() == 0
    assert lake.table("mart_product_performance").count() > 0
