"""Forms of storage and upkeep: buckets, months, bitmaps, sums by change, elements kept whole."""

import datetime as dt
import random
from decimal import Decimal

from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.operators import advance, delta, distinct, is_current, overlapping_versions, snapshot
from tidemark.operators.history import DIGEST, save_open
from tidemark.plans import gold, marts, reports
from tidemark.schemas import ENTITIES
from tidemark.session import scratch_path
from tidemark.streaming.bronze import bronze, load_new_files

D = dt.datetime


def test_open_versions_in_buckets_are_not_shuffled(spark, frame):
    schema = "id long, a string, b double, note string"
    days = [[(1, "x", 1.0, "n"), (2, None, 2.0, "n"), (3, "z", None, "n")],
            [(1, "x", 1.0, "new note"), (2, "y", 2.0, "n"), (4, "w", 4.0, "n")],
            [(1, "x", None, "n"), (2, "y", 2.0, "n"), (3, "z", None, "n")]]
    plain, live, closed = None, None, []
    for i, day in enumerate(days):
        at = f"2026-01-0{i + 1} 06:00:00"
        plain = snapshot(plain, frame(day, schema), "id", ["a", "b"], at)
        now = advance(live, frame(day, schema).repartition(3), "id", ["a", "b"], at)
        if live is not None:
            text = now._jdf.queryExecution().executedPlan().toString()
            scan = text[text.rindex("FileScan"):]
            assert "Bucketed: true" in scan and "SelectedBucketsCount" in scan
            above = text[:text.rindex("FileScan")].rsplit("Exchange", 1)[0]
            assert text.count("Exchange hashpartitioning") == 1 and "FullOuter" in above
        now = spark.createDataFrame(now.collect(), now.schema)
        closed.append(now.filter(~is_current()))
        name = f"open_{i}_{random.randint(0, 10 ** 9)}"
        live = save_open(now.filter(is_current()), name, scratch_path(spark, name), "id", ["a", "b"], 4)
    got = closed[0].unionByName(closed[1]).unionByName(closed[2]).unionByName(live.drop(DIGEST))
    assert rows(got.select(plain.columns)) == rows(plain)


def test_the_calendar_prunes_months_at_run_time(spark, frame):
    days = [D(2026, 1, 1) + dt.timedelta(days=i) for i in range(300)]
    revenue = frame([(d.date(), "c", 0.125, 2) for d in days for _ in range(4)],
                    "order_date date, category string, gross_revenue double, total_orders long")
    stored = gold.write_by_month(revenue, "order_date", scratch_path(spark, "revenue"))
    dates = gold.dim_date(gold.day_spine(spark, "2026-01-01", "2027-01-01"))
    path = scratch_path(spark, "dates")
    dates.write.parquet(path)
    got = reports.daily_trend_by_month(stored, spark.read.parquet(path), "2026-10-20 12:00:00", 30)
    assert "dynamicpruning" in plan(got).lower()
    assert rows(got) == rows(reports.daily_trend(revenue, "2026-10-20 12:00:00", 30))
    assert {r.total_revenue for r in got.collect()} == {0.5}
    read = got._jdf.queryExecution().executedPlan()
    files = [int(n) for n in __import__("re").findall(r"number of partitions read: ([0-9]+)", read.toString())]
    assert not files or max(files) <= 2


def test_bitmaps_count_what_a_distinct_count_does(frame):
    rng = random.Random(1)
    data = [(D(2026, rng.randint(1, 12), rng.randint(1, 28)), rng.choice([None, -5, rng.randint(0, 200_000)]))
            for _ in range(3000)]
    orders = frame(data, "order_date timestamp_ntz, customer_id long")
    late = F.dayofmonth("order_date") % 3 == 0
    daily = distinct.merged(marts.customer_bitmaps(orders.filter(~late)).unionByName(
        marts.customer_bitmaps(orders.filter(late))), order_day="order_day")
    want = orders.groupBy(F.year("order_date"), F.month("order_date")).agg(F.countDistinct("customer_id"))
    assert rows(marts.customers_by_month(daily)) == rows(want)
    assert marts.customers_by_month(marts.customer_bitmaps(orders.limit(0))).count() == 0


def test_sums_follow_changes_and_leave_other_groups_alone(frame):
    schema = "id long, g string, v decimal(28,8), w long"
    by = {"g": F.col("g")}
    values = {"v": F.col("v"), "w": F.when(F.col("w") > 1, 1).otherwise(0).cast("long")}
    day1 = [(1, "a", Decimal("0.125"), 1), (2, "a", Decimal("0.1"), 2), (3, "b", None, 3), (4, None, Decimal(4), 2)]
    gone = [day1[1], day1[2]]
    new = [(2, "c", Decimal("0.1"), 2), (5, "a", Decimal("0.00000001"), 0), (3, None, Decimal(1), 0)]
    day2 = [r for r in day1 if r not in gone] + new
    state = delta.sums(frame(day1, schema), by, values)
    gained = delta.changes(frame(gone, schema), frame(new, schema), by, values)
    assert rows(delta.kept_up(state, gained, ["g"])) == rows(delta.sums(frame(day2, schema), by, values))
    assert rows(delta.applied(state, gained, ["g"]), "g", "_rows") == [("a", 2), ("b", 0), ("c", 1), (None, 2)]
    nothing = delta.changes(frame(gone, schema), frame(gone, schema), by, values)
    assert nothing.count() == 0 and rows(delta.kept_up(state, nothing, ["g"])) == rows(state)


def test_a_field_nobody_knew_of_is_read_from_elements_kept_whole(spark, tmp_path):
    orders, root, lake = ENTITIES["orders"], str(tmp_path / "in"), str(tmp_path / "lake")
    from test_loading import DAY, land, order
    land(root, [order(1, channel="web", size=3), order(2, channel=7), order(3), "{broken",
                [order("4", channel={"x": 1}, size="9")]])
    load_new_files(spark, root, lake, orders, whole=True)
    land(root, [order(5, channel="shop")], day=DAY + dt.timedelta(days=1))
    load_new_files(spark, root, lake, orders)              # not kept whole: nothing to read it from
    got = bronze(spark, lake, orders, more={"channel": "string", "size": "int"})
    assert rows(got, "order_id", "channel", "size") == [
        (1, "web", 3), (2, "7", None), (3, None, None), (4, '{"x":1}', 9), (5, None, None)]
    assert bronze(spark, lake, orders).columns == [*orders.fields.names, "_load_id"]


def test_a_sound_history_of_one_key_pairs_nothing(spark):
    """Two hundred thousand versions of one key, each ending where the next begins."""
    spans = spark.range(200_000).selectExpr(
        "7L AS customer_id", "CAST(id AS STRING) AS dbt_scd_id",
        "timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP_NTZ'2020-01-01 00:00:00') AS dbt_valid_from",
        "IF(id = 199999, NULL, timestampadd(MINUTE, CAST(id AS INT) + 1, TIMESTAMP_NTZ'2020-01-01 00:00:00'))"
        " AS dbt_valid_to")
    sound = overlapping_versions(spans, "customer_id")
    assert sound.count() == 0 and "Join" not in plan(sound)
    late = spans.filter("dbt_scd_id = '100000'").selectExpr(
        "customer_id", "'late' AS dbt_scd_id", "timestampadd(SECOND, 30, dbt_valid_from) AS dbt_valid_from",
        "timestampadd(SECOND, 40, dbt_valid_from) AS dbt_valid_to")
    found = overlapping_versions(spans.unionByName(late), "customer_id")
    assert [r.b_valid_from for r in found.collect()] == [
        D(2020, 1, 1) + dt.timedelta(minutes=100_000, seconds=30)]


def test_reports_round_results_and_not_what_goes_into_them(frame):
    revenue = frame([(dt.date(2026, 1, 1), 2026, 1, "Jan", "c", 0.125, 1)] * 4
                    + [(dt.date(2026, 2, 1), 2026, 2, "Feb", "c", 0.375, 1)] * 4,
                    "order_date date, year int, month int, month_name string, category string, "
                    "gross_revenue double, total_orders long")
    assert rows(reports.daily_trend(revenue, "2026-02-02 00:00:00", 60), "total_revenue") == [(0.5,), (1.5,)]
    assert rows(reports.month_over_month(revenue), "monthly_revenue", "revenue_growth_pct") == [
        (0.5, None), (1.5, 200.0)]
    assert rows(reports.category_aov(revenue), "revenue", "avg_order_value") == [(2.0, 0.25)]
    assert rows(reports.daily_gmv(revenue), "daily_gmv") == [(0.5,), (1.5,)]
    people = frame([("Loyal", 0.125, 1, 1)] * 3, "customer_segment string, lifetime_value double, "
                   "total_orders long, recency_days int")
    assert rows(reports.segment_revenue(people), "total_revenue", "avg_ltv") == [(0.38, 0.13)]
