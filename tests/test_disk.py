"""What the job keeps on disk: landed files compressed, no copies of rows that are stored already."""

import datetime as dt
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tidemark.operators import DuplicateKeys
from tidemark.plans import catalog_loading, job
from tidemark.plans.star import Star
from tidemark.schemas import ENTITIES
from tidemark.session import shared_root
from tidemark.sources import ndjson
from tidemark.sources.tables import Table

AT, LATER = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
SCHEMA = "id long, v string, _extracted_at timestamp_ntz"


def copies(spark):
    return {p.name for p in Path(shared_root(spark)).iterdir() if p.name.startswith(("batch-", "changed-"))}


def test_the_job_lands_compressed_files(spark, frame, monkeypatch):
    lakes = []
    health = frame([("raw_orders", "bronze", 1, AT)],
                   "table_name string, layer string, row_count long, last_loaded_at timestamp_ntz")
    monkeypatch.setattr(catalog_loading, "run_day", lambda lake, at: lakes.append(lake) or health)
    catalog_loading._job(Star(spark, "/root/testdata/sf0.001"))
    landed = [p for p in Path(lakes[0].landing).rglob("part-*")]
    assert {p.relative_to(lakes[0].landing).parts[0] for p in landed} == set(ENTITIES)
    assert all(p.name.endswith(".json.gz") for p in landed)


def test_compressed_files_stay_small_enough_to_share_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ndjson, "PACKED_ROWS", 10, raising=False)
    entity, day = ENTITIES["order_items"], dt.date(2026, 1, 1)
    lines = spark.range(95).coalesce(1).selectExpr(
        "id AS order_item_id", "id DIV 3 AS order_id", "id AS product_id", "1L AS quantity", "2.5D AS unit_price",
        "2.5D AS line_total", "TIMESTAMP_NTZ '2026-01-01 00:00:00' AS _extracted_at")
    for name, compression, files in (("packed", "gzip", 10), ("plain", None, 1)):
        path = ndjson.write_ndjson(lines, str(tmp_path / name), entity, day, compression)
        assert len(list(Path(path).glob("part-*"))) == files
        assert rows(ndjson.read_day(spark, str(tmp_path / name), entity, day)) == rows(lines)


def test_rows_made_of_stored_ones_are_not_copied_first(spark, frame, tmp_path):
    """The first rows are made by the write; later on only those that have changed are made and kept."""
    names = frame([(i, f"n{i}") for i in range(40)], "id long, name string")
    made = []

    def look_up(new):
        made.append(new)
        return new.join(names, "id", "left")

    table, plain = (Table(spark, str(tmp_path / n), "id", 8) for n in ("made", "plain"))
    before = copies(spark)
    first = frame([*((i, f"v{i}", AT) for i in range(40)), (None, "none", AT)], SCHEMA)
    gone, came = table.merge(first, made=look_up)
    assert copies(spark) == before
    assert rows(gone) == [] and rows(came) == rows(look_up(first)) == rows(table.read())

    made.clear()
    second = frame([(0, "v0", AT), (1, "w", LATER), (39, "v39", AT), (50, "x", LATER), (None, "none", AT)], SCHEMA)
    gone, came = table.merge(second, made=look_up, same=["id", "v", "_extracted_at"])
    assert [rows(new, "id") for new in made] == [[(1,), (50,)]]
    plain.merge(look_up(first))
    old_gone, old_came = plain.merge(look_up(second), same=["id", "v", "_extracted_at"])
    assert rows(gone) == rows(old_gone) == [(1, "v1", AT, "n1")]
    assert rows(came) == rows(old_came) == [(1, "w", LATER, "n1"), (50, "x", LATER, None)]
    assert rows(table.read()) == rows(plain.read())
    assert table.version() == plain.version() == 2 and table.mark() == plain.mark() == LATER


def test_nothing_to_make(spark, frame, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "id")
    none = frame([], SCHEMA)
    gone, came = table.merge(none, made=lambda new: new.withColumn("w", F.lit("w")))
    assert table.read().columns == came.columns == ["id", "v", "_extracted_at", "w"]
    table.merge(frame([(1, "a", AT)], SCHEMA), made=lambda new: new.withColumn("w", F.lit("w")))
    table.merge(none, made=lambda new: new.withColumn("w", F.lit("w")))
    assert rows(table.read()) == [(1, "a", AT, "w")]


def test_a_row_that_would_come_twice_is_refused(spark, frame, tmp_path):
    table = Table(spark, str(tmp_path / "t"), "id")
    twice = lambda new: new.unionAll(new)
    with pytest.raises(DuplicateKeys):
        table.merge(frame([(1, "a", AT)], SCHEMA), made=twice)
    assert not table.exists()
    table.merge(frame([(1, "a", AT)], SCHEMA), made=lambda new: new)
    with pytest.raises(DuplicateKeys):
        table.merge(frame([(1, "b", LATER)], SCHEMA), made=twice)
    with pytest.raises(DuplicateKeys):
        table.merge(frame([(1, "b", LATER), (1, "c", LATER)], SCHEMA), made=lambda new: new)
    assert rows(table.read()) == [(1, "a", AT)]


def test_first_facts_leave_no_copy(spark, frame, tmp_path):
    lake = job.Lakehouse(spark, str(tmp_path / "landing"), str(tmp_path / "tables"))
    lake.store("stg_order_items").merge(frame([(1, 7, 3, AT), (2, 7, None, AT)],
                                              "order_item_id long, order_id long, product_id long, "
                                              "_extracted_at timestamp_ntz"))
    before = copies(spark)
    got = job._follow(lake.store("stg_order_items"), lake.store("fct_order_items"),
                      lambda new: new.withColumn("title", F.concat(F.lit("t"), "product_id")), None)
    assert copies(spark) == before
    assert got[0] == 0 and rows(got[2]) == rows(lake.table("fct_order_items")) == [
        (1, 7, 3, AT, "t3"), (2, 7, None, AT, None)]
