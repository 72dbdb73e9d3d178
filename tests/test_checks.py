import datetime as dt

import pytest
from conftest import rows

from tidemark.plans import monitor, quality
from tidemark.plans.quality import CheckFailed

D = dt.datetime


def test_not_null_counts_each_column_in_one_pass(frame):
    tables = {"t": frame([(1, None), (None, None), (3, "x")], "a long, b string"),
              "u": frame([(1,)], "c long")}
    got = quality.not_null(tables, {"t": ["a", "b"], "u": ["c"]})
    assert rows(got) == [("t", "a", 1), ("t", "b", 2), ("u", "c", 0)]


def test_unique_ignores_nulls(frame):
    tables = {"t": frame([(1, 1), (1, 2), (2, 3), (2, 4), (None, 5), (None, 6)], "a long, b long")}
    assert rows(quality.unique(tables, {"t": ["a", "b"]})) == [("t", "a", 2), ("t", "b", 0)]


def test_accepted_values_lets_nulls_pass(frame):
    tables = {"t": frame([("x",), ("y",), ("y",), (None,)], "s string")}
    assert rows(quality.accepted_values(tables, {"t": {"s": ["x"]}})) == [("t", "s", "y", 2)]
    assert rows(quality.accepted_values(tables, {"t": {"s": ["x", "y"]}})) == []


def test_relationships_and_orphans(frame):
    child = frame([(1, 1), (2, 9), (3, 9), (4, None)], "order_item_id long, order_id long")
    parent = frame([(1,)], "order_id long")
    assert rows(quality.relationships(child, "order_id", parent, "order_id")) == [(9, 2)]
    assert rows(quality.orphan_items(child, parent), "order_item_id") == [(2,), (3,), (4,)]


def test_singular_checks_find_and_pass(frame):
    versions = frame([(1, True), (1, True), (2, True), (2, False)], "customer_id long, is_current boolean")
    assert rows(quality.duplicate_current(versions)) == [(1, 2)]
    orders = frame([(1, D(2026, 1, 1, 23), 5.0), (2, D(2026, 1, 2), 0.0), (3, None, -1.0)],
                   "order_id long, order_date timestamp_ntz, total_amount double")
    assert rows(quality.future_orders(orders, "2026-01-01 00:30:00"), "order_id") == [(2,)]
    assert rows(quality.revenue_positive(orders), "order_id") == [(2,), (3,)]
    reviews = frame([(1, 1.0), (2, 5.0), (3, 0.99), (4, 5.01)], "review_id long, rating double")
    assert rows(quality.rating_range(reviews), "review_id") == [(3,), (4,)]


def test_overlap_check(frame):
    schema = ("customer_id long, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz, "
              "dbt_scd_id string")
    sound = [(1, D(2026, 1, 1), D(2026, 1, 3), "a"), (1, D(2026, 1, 3), None, "b")]
    assert quality.history_overlap(frame(sound, schema)).count() == 0
    broken = sound + [(1, D(2026, 1, 2), D(2026, 1, 2, 5), "c")]
    assert rows(quality.history_overlap(frame(broken, schema)), "a_valid_from", "b_valid_from") == [
        (D(2026, 1, 1), D(2026, 1, 2))]


def test_gate_names_all_short_tables():
    counts = {"raw_orders": 1, "stg_orders": 0, "fct_orders": 1, "mart_revenue_summary": 0}
    with pytest.raises(CheckFailed, match="stg_orders has 0 rows.*mart_revenue_summary has 0"):
        quality.gate(counts)
    quality.gate(dict.fromkeys(counts, 1))


def test_checks_that_the_write_has_settled_are_not_run(frame):
    tables = {n: frame([], "customer_id long, email string, updated_at timestamp, status string")
              for layer in (quality.NOT_NULL, quality.UNIQUE, quality.ACCEPTED)
              for n in layer["silver"]}
    clean = {t: dict.fromkeys(quality.watch(t), 0) for t in tables}
    assert set(quality.watch("stg_orders")) == {
        "null order_id", "null customer_id", "null total_amount", "value status"}
    assert "revenue_positive" in quality.watch("fct_orders")
    for t, cols in quality.UNIQUE["silver"].items():
        tables[t] = frame([], ", ".join(f"{c} string" for c in cols))
    assert set(quality.column_checks(tables, "silver", clean)) == {"unique"}


def test_require_none_reports_each_failed_check(frame):
    found, nothing = frame([(7,)], "order_id long"), frame([], "order_id long")
    quality.require_none({"a": nothing})
    with pytest.raises(CheckFailed, match="b: .*7"):
        quality.require_none({"a": nothing, "b": found})


@pytest.mark.parametrize("last, hours, label", [
    (D(2026, 1, 2, 13, 59), 24, "healthy"), (D(2026, 1, 2, 12, 0), 25, "healthy"),
    (D(2026, 1, 2, 11, 59), 26, "warning"), (D(2026, 1, 1, 13, 0), 48, "warning"),
    (D(2026, 1, 1, 12, 59), 49, "critical"), (None, None, "critical")])
def test_health_labels(frame, last, hours, label):
    df = frame([(last,)] if last else [], "_extracted_at timestamp_ntz")
    tables = {n: df for names in monitor.LAYERS.values() for n in names}
    got = monitor.pipeline_health(tables, "2026-01-03 13:30:00").collect()
    assert len(got) == 11
    assert {(r.hours_since_load, r.freshness_status, r.row_count) for r in got} == {
        (hours, label, 1 if last else 0)}


@pytest.mark.parametrize("last, status", [
    (D(2026, 1, 2, 12, 30), "pass"), (D(2026, 1, 2, 12, 29), "warn"),
    (D(2026, 1, 1, 13, 30), "warn"), (D(2026, 1, 1, 13, 29), "error"), (None, "error")])
def test_source_freshness(frame, last, status):
    df = frame([(last,)] if last else [], "_extracted_at timestamp_ntz")
    got = monitor.source_freshness({n: df for n in monitor.LAYERS["bronze"]}, "2026-01-03 13:30:00")
    assert {r.status for r in got.collect()} == {status} and got.count() == 5
