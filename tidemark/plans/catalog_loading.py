"""Queries over loading and merging. What they read is first written by Spark from the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.operators import high_water_mark, since, sync_columns, upsert
from tidemark.plans.catalog import query
from tidemark.plans.job import Lakehouse, run_day
from tidemark.plans.silver import CLEAN
from tidemark.plans.star import CALENDAR, Star
from tidemark.schemas import ENTITIES
from tidemark.session import scratch_path
from tidemark.sources import ndjson, testdata
from tidemark.sources.tables import Table
from tidemark.streaming.bronze import bronze, force_load, load_new_files
from tidemark.streaming.silver import refresh_silver

ORDERS = ENTITIES["orders"]


def _date(day: int) -> dt.date:
    return dt.date.fromisoformat(testdata.DAYS[day])


def _extract(s: Star, entity: str, day: int) -> DataFrame:
    """What one day's extraction holds."""
    daily = {"customers": testdata.customers_on, "products": testdata.products_on,
             "orders": testdata.orders_on}
    return daily[entity](s.spark, s.sf_dir, day) if entity in daily else s.raw(entity)


def _land(s: Star, entity: str, days=(1,), root: str | None = None,
          compression: str | None = None) -> str:
    root = root or scratch_path(s.spark, "landing")
    for day in days:
        ndjson.write_ndjson(_extract(s, entity, day), root, ENTITIES[entity], _date(day), compression)
    return root


def _scan(s: Star, entity: str, days=(1,)) -> DataFrame:
    path = ndjson.entity_path(_land(s, entity, days), ENTITIES[entity])
    return ndjson.good(ndjson.scan_ndjson(s.spark, path, ENTITIES[entity]))


query("bronze_scan")(lambda s: _scan(s, "orders", (1, 2)))
query("bronze_typed")(lambda s: _scan(s, "order_items"))
query("bronze_typed_customers")(lambda s: _scan(s, "customers"))
query("bronze_typed_products")(lambda s: _scan(s, "products"))
query("bronze_typed_orders")(lambda s: _scan(s, "orders"))
query("bronze_typed_reviews")(lambda s: _scan(s, "reviews"))
query("ndjson_roundtrip")(lambda s: _scan(s, "customers", (1, 2, 3)))
query("read_day")(lambda s: ndjson.read_day(
    s.spark, _land(s, "customers", (1, 2, 3)), ENTITIES["customers"], _date(2)))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as JSON text, whole or damaged by their priority: medium ones are cut off, low ones
    have a word for a number, high ones quote their numbers, urgent ones are no objects. A third of
    them has a line each; the others of a customer are an array, of one element or many."""
    orders = testdata.table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_custkey", """
        CASE o_orderpriority
          WHEN '3-MEDIUM' THEN concat('{"order_id":', o_orderkey, ',"total_amount":')
          WHEN '5-LOW' THEN concat('{"order_id":', o_orderkey, ',"total_amount":"none"}')
          WHEN '2-HIGH' THEN concat('{"order_id":"', o_orderkey, '","total_amount":"',
            CAST(o_totalprice AS DECIMAL(18,2)), '"}')
          WHEN '1-URGENT' THEN concat('"order ', o_orderkey, '"')
          ELSE concat('{"order_id":', o_orderkey, ',"total_amount":',
            CAST(o_totalprice AS DECIMAL(18,2)), '}') END AS value""", """
        o_orderpriority = '3-MEDIUM' OR o_orderpriority <> '1-URGENT' AND o_orderkey % 3 = 0
          AS alone""")
    arrays = (orders.filter("NOT alone").groupBy("o_custkey")
              .agg(F.sort_array(F.collect_list("value")).alias("parts"))
              .selectExpr("concat('[', array_join(parts, ', '), ']') AS value"))
    return orders.filter("alone").select("value").unionAll(arrays)


@query("bronze_quarantine")
def _quarantine(s: Star) -> DataFrame:
    path = scratch_path(s.spark, "damaged")
    order_lines(s.spark, s.sf_dir).write.text(path)
    return ndjson.scan_ndjson(s.spark, path, ORDERS).select(
        F.col("_status").alias("status"), "order_id", "total_amount",
        F.col("_corrupt_record").alias("bad_text"))


def _load(s: Star, days) -> str:
    """Land and load day by day, each load run twice; the second one finds nothing new."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    for day in days:
        _land(s, "orders", (day,), landing)
        for _ in range(2):
            load_new_files(s.spark, landing, root, ORDERS, testdata.RUN_AT[day])
    return root


@query("bronze_idempotent")
def _idempotent(s: Star) -> DataFrame:
    return bronze(s.spark, _load(s, (1, 2)), ORDERS)


@query("bronze_forced")
def _forced(s: Star) -> DataFrame:
    """A day loaded, then all of its files once more by force."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    _land(s, "orders", (1,), landing)
    load_new_files(s.spark, landing, root, ORDERS, testdata.RUN_AT[1])
    force_load(s.spark, landing, root, ORDERS, "again", testdata.RUN_AT[2])
    return bronze(s.spark, root, ORDERS)


@query("bronze_variant")
def _variant(s: Star) -> DataFrame:
    """A field that nobody knew of when the days were loaded, read from the elements kept whole."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    for day in (1, 2):
        orders = testdata.orders_on(s.spark, s.sf_dir, day).withColumn(
            "channel", F.expr("IF(customer_id % 3 = 0, NULL, 'c' || customer_id % 7)"))
        ndjson.write_ndjson(orders, landing, ORDERS, _date(day))
        load_new_files(s.spark, landing, root, ORDERS, testdata.RUN_AT[day], whole=True)
    return bronze(s.spark, root, ORDERS, more={"channel": "string"}).select(
        "order_id", "total_amount", "channel")


@query("bronze_day")
def _bronze_day(s: Star) -> DataFrame:
    return bronze(s.spark, _load(s, (1, 2)), ORDERS, _date(2)).drop("_load_id")


@query("bronze_stamp")
def _stamp(s: Star) -> DataFrame:
    batch = ndjson.stamp(s.raw("order_items"), testdata.RUN_AT[1])
    return ndjson.with_load_id(batch, testdata.RUN_AT[1])


# ── merging ──────────────────────────────────────────────────────────────────

def _orders_after_day_one(s: Star) -> tuple[DataFrame, DataFrame]:
    """The clean orders of day 1, and all that was extracted since."""
    target = s.stg("orders", 1)
    return target, since(s.raw("orders"), high_water_mark(target))


query("incremental_filter")(lambda s: _orders_after_day_one(s)[1])


@query("upsert_merge")
def _upsert(s: Star) -> DataFrame:
    target, new = _orders_after_day_one(s)
    return upsert(target, CLEAN["orders"](new), "order_id")


@query("schema_sync")
def _schema_sync(s: Star) -> DataFrame:
    """The target still has a column the source has lost, and lacks one it has gained."""
    target, new = _orders_after_day_one(s)
    source = CLEAN["orders"](new).drop("shipping_city").withColumn("channel", F.lit("web"))
    return upsert(sync_columns(target, source), source, "order_id")


@query("upsert_stored")
def _upsert_stored(s: Star) -> DataFrame:
    """The same merge through a stored table, of which only the touched chunks are rewritten."""
    table = Table(s.spark, scratch_path(s.spark, "stg_orders"), "order_id", 4096)
    for day in (1, 2):
        new = since(s.raw("orders", day), table.mark())
        table.merge(CLEAN["orders"](new))
    return table.read()


@query("silver_stream")
def _silver_stream(s: Star) -> DataFrame:
    """Day 2 arrives before day 1: nothing is lost, and the newer rows stand."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    table = Table(s.spark, scratch_path(s.spark, "stg_orders"), "order_id", 65536)
    for day in (2, 1):
        _land(s, "orders", (day,), landing)
        load_new_files(s.spark, landing, root, ORDERS, testdata.RUN_AT[day])
        refresh_silver(s.spark, root, ORDERS, table)
    return table.read()


@query("silver_forced")
def _silver_forced(s: Star) -> DataFrame:
    """Day 2 is loaded by force only, and reaches the clean table."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    table = Table(s.spark, scratch_path(s.spark, "stg_orders"), "order_id", 65536)
    _land(s, "orders", (1,), landing)
    load_new_files(s.spark, landing, root, ORDERS, testdata.RUN_AT[1])
    refresh_silver(s.spark, root, ORDERS, table)
    _land(s, "orders", (2,), landing)
    force_load(s.spark, landing, root, ORDERS, "late", testdata.RUN_AT[2])
    refresh_silver(s.spark, root, ORDERS, table)
    return table.read()


@query("silver_late")
def _silver_late(s: Star) -> DataFrame:
    """An incremental entity whose second day is loaded before its first, and the first once more by
    force: none of its rows is lost, and none comes twice."""
    landing, root = scratch_path(s.spark, "landing"), scratch_path(s.spark, "bronze")
    lines = ENTITIES["order_items"]
    table = Table(s.spark, scratch_path(s.spark, "stg_order_items"), "order_item_id", 20_000)
    late = F.col("order_id") % 4 == 0
    for day, some in ((2, ~late), (1, late)):
        # filtered first, so that no day shuffles the lines of the other; in order, packed close
        ndjson.write_ndjson(s.raw("order_items").filter(some).dropDuplicates(["order_item_id"])
                            .sortWithinPartitions("order_item_id"),
                            landing, lines, _date(day), compression="gzip")
        load_new_files(s.spark, landing, root, lines, testdata.RUN_AT[day])
        refresh_silver(s.spark, root, lines, table)
    force_load(s.spark, landing, root, lines, "again", testdata.RUN_AT[2])
    refresh_silver(s.spark, root, lines, table)
    return table.read().select("order_item_id", "order_id")


@query("job_two_days")
def _job(s: Star) -> DataFrame:
    """The whole job over two days of files: what it knows of its tables at the end."""
    at = {day: dt.datetime.fromisoformat(text) for day, text in testdata.RUN_AT.items()}
    lake = Lakehouse(s.spark, scratch_path(s.spark, "landing"), scratch_path(s.spark, "lake"),
                     CALENDAR)
    orders = testdata.orders_on(s.spark, s.sf_dir, 1).filter("total_amount > 0")
    first = ndjson.stamp(s.raw("order_items").dropDuplicates(["order_item_id"])
                         .join(orders, "order_id", "left_semi"), f"{testdata.DAYS[1]} 00:00:00")
    for day in (1, 2):   # landed files are most of what the job has on disk, so they come compressed
        for entity in ("customers", "products", "orders"):
            _land(s, entity, (day,), lake.landing, "gzip")
        if day == 1:
            ndjson.write_ndjson(first.sortWithinPartitions("order_item_id"), lake.landing,
                                ENTITIES["order_items"], _date(1), "gzip")
            _land(s, "reviews", (1,), lake.landing, "gzip")
        health = run_day(lake, at[day])
    return health.select("table_name", "layer", "row_count", "last_loaded_at").withColumn(
        "last_loaded_at", F.col("last_loaded_at").cast("string"))
