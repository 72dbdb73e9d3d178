"""What is known already is not worked out again: conversions, sums, checks, changed rows."""

import datetime as dt
import re

import pytest
from conftest import plan, rows

from tidemark.plans import job, marts, quality
from tidemark.plans.quality import CheckFailed
from tidemark.schemas import ENTITIES
from tidemark.sources import ndjson
from tidemark.sources.tables import Table

AT = dt.datetime(2026, 1, 1)
LATER = dt.datetime(2026, 1, 2)


@pytest.fixture
def lake(spark, tmp_path):
    return job.Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"))


def test_a_field_is_converted_once(frame):
    """The value and the verdict on its row rest on one conversion."""
    lines = frame([('{"order_item_id": "12", "quantity": 3.9, "unit_price": 1e2}',),
                   ('{"order_item_id": 13, "quantity": "many"}',), ("7",)], "value string")
    found = ndjson.typed(lines, ENTITIES["order_items"])
    optimized = found._jdf.queryExecution().optimizedPlan().toString()
    for f in ENTITIES["order_items"].fields.names:
        assert len(re.findall(rf"try_cast\(_raw#\d+\.{f} as", optimized)) == 1, f
    assert rows(found, "order_item_id", "quantity", "unit_price", ndjson.STATUS) == rows(frame(
        [(12, 4, 100.0, "ok"), (13, None, None, "bad"), (None, None, None, "bad")],
        "a long, b long, c double, d string"))


REVIEW = "review_id long, product_id long, rating double, sentiment string, _extracted_at timestamp_ntz"


def test_sums_are_made_anew_only_when_their_facts_were_written(lake, frame):
    facts, made = lake.store("fct_reviews"), []

    def kept():
        return job.keep(lake, "product_reviews", "fct_reviews",
                        lambda f: made.append(1) or marts.product_reviews(f))

    facts.merge(frame([(1, 7, 4.5, "positive", AT), (2, None, 2.0, "negative", AT)], REVIEW))
    first = rows(kept())
    assert rows(kept()) == first == rows(marts.product_reviews(facts.read())) and len(made) == 1
    facts.merge(frame([(1, 7, 3.5, "neutral", LATER), (3, 7, 5.0, "positive", LATER)], REVIEW))
    assert rows(kept()) == rows(marts.product_reviews(facts.read())) != first and len(made) == 2


def test_a_table_that_has_passed_is_checked_again_when_written(lake, frame, monkeypatch):
    def merge(name, values, schema):
        lake.store(name).merge(frame(values, schema), watch=quality.watch(name))

    buyer = "customer_id long, email string, updated_at timestamp_ntz"
    merge("stg_customers", [(1, "a", AT)], buyer)
    merge("stg_products", [(1, 2.0, "x")], "product_id long, price double, category string")
    merge("stg_orders", [(1, 1, 5.0, "shipped")],
          "order_id long, customer_id long, total_amount double, status string")
    merge("stg_order_items", [(1, 1, 1)], "order_item_id long, order_id long, product_id long")
    merge("stg_reviews", [(1, 4.0)], "review_id long, rating double")
    looked, check = [], quality.column_checks
    monkeypatch.setattr(quality, "column_checks",
                        lambda t, layer, w, settled: looked.append(set(t) - settled)
                        or check(t, layer, w, settled))
    job.check_layer(lake, "silver")
    job.check_layer(lake, "silver")
    assert looked == [set(quality.UNIQUE["silver"])]
    merge("stg_customers", [(2, "a", AT)], buyer)
    for _ in range(2):      # a check with findings settles nothing
        with pytest.raises(CheckFailed, match="unique.*email"):
            job.check_layer(lake, "silver")
    assert looked[1:] == [{"stg_customers"}] * 2
    merge("stg_customers", [(2, "b", AT)], buyer)
    job.check_layer(lake, "silver")
    assert looked[3:] == [{"stg_customers"}]


def test_both_sides_settle_a_reference(frame):
    tables = {"fct_order_items": frame([(1, 8, 1)], "order_item_id long, order_id long, product_id long"),
              "fct_orders": frame([(9, 1, 2.0, "shipped")],
                                  "order_id long, customer_id long, total_amount double, status string")}
    others = {n for part in (quality.NOT_NULL, quality.UNIQUE, quality.ACCEPTED) for n in part["gold"]}
    for open_ in ({"fct_order_items"}, {"fct_orders"}):
        found = quality.column_checks(tables, "gold", {}, others - open_)
        assert rows(found["fct_order_items.order_id"]) == [(8, 1)]
    assert quality.column_checks(tables, "gold", {}, others) == {}


def test_the_rows_that_came_are_stored(spark, frame, tmp_path):
    """Who keeps sums up by change does not repeat the search for changed rows."""
    table, schema = Table(spark, str(tmp_path / "t"), "id"), "id long, v string, w string"
    table.merge(frame([(1, "a", "x"), (2, None, "x"), (3, "c", "x")], schema))
    gone, came = table.merge(frame([(1, "a", "y"), (2, None, "y"), (3, "d", "y"), (4, "e", "y")], schema),
                             same=["id", "v"])
    assert "Join" not in plan(came)
    assert rows(came) == [(3, "d", "y"), (4, "e", "y")] and rows(gone) == [(3, "c", "x")]
    assert rows(table.read()) == [(1, "a", "x"), (2, None, "x"), (3, "d", "y"), (4, "e", "y")]


def test_chunks_are_looked_over_in_one_pass(spark, frame, tmp_path):
    schema = "id long, v string, _extracted_at timestamp_ntz"
    table = Table(spark, str(tmp_path / "t"), "id")
    met = table._met(frame([(1, "a", AT), (1, "b", LATER), (60, "c", None), (None, "d", AT)], schema),
                     [50], "_extracted_at")
    assert {c: (r["n"], r["keys"], r["mark"]) for c, r in met.items()} == {
        "first": (2, 1, LATER), "50": (1, 1, None), "none": (1, 0, AT)}
