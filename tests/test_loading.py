import datetime as dt
import gzip
import json
from pathlib import Path

import pytest
from conftest import plan, rows

from tidemark.plans.silver import CLEAN
from tidemark.schemas import ENTITIES
from tidemark.session import scratch_path
from tidemark.sources import ndjson
from tidemark.sources.tables import Table
from tidemark.streaming import bronze as streaming_bronze
from tidemark.streaming.bronze import (
    bronze, force_load, load_new_files, loads, raw_path, rejected, stored)
from tidemark.streaming.silver import refresh_silver

ORDERS, REVIEWS = ENTITIES["orders"], ENTITIES["reviews"]
DAY = dt.date(2026, 6, 3)
AT = "2026-06-03 06:00:00"


def order(i, total=10.0, stamp="2026-06-03T06:00:00.123456", **more):
    return {"order_id": i, "customer_id": 1, "order_date": "2026-06-01T10:00:00", "status": "Pending ",
            "payment_method": "upi", "shipping_city": "el paso", "total_amount": total,
            "updated_at": "2026-06-01T10:00:00.5", "_extracted_at": stamp, **more}


def land(root, lines, entity=ORDERS, day=DAY, name="orders.json"):
    folder = Path(ndjson.day_path(root, entity, day))
    folder.mkdir(parents=True, exist_ok=True)
    text = "\n".join(line if isinstance(line, str) else json.dumps(line) for line in lines)
    if name.endswith(".gz"):
        (folder / name).write_bytes(gzip.compress(text.encode()))
    else:
        (folder / name).write_text(text)


def scan(spark, root, **options):
    return ndjson.scan_ndjson(spark, ndjson.entity_path(root, ORDERS), ORDERS, **options)


def test_paths_are_padded():
    assert ndjson.day_path("/x/", ORDERS, DAY) == "/x/orders/incremental/year=2026/month=06/day=03"
    assert ndjson.day_path("/x", ENTITIES["products"], DAY).startswith("/x/products/snapshot/")


def test_types_times_and_microseconds(spark, tmp_path):
    land(str(tmp_path), [order(1)])
    row = ndjson.good(scan(spark, str(tmp_path))).first()
    assert row.order_date == dt.datetime(2026, 6, 1, 10)
    assert row.updated_at == dt.datetime(2026, 6, 1, 10, 0, 0, 500000)
    assert row._extracted_at == dt.datetime(2026, 6, 3, 6, 0, 0, 123456)
    assert row.asDict().keys() == set(ORDERS.fields.names)


@pytest.mark.parametrize("line, status, order_id, total", [
    (order(1), "ok", 1, 10.0),
    (order("12"), "ok", 12, 10.0),                      # numbers as text
    (order(1, "7.5"), "ok", 1, 7.5),
    (order(12.0), "ok", 12, 10.0),
    (order(1, None), "ok", 1, None),
    ({"order_id": 1}, "ok", 1, None),                   # fields left out
    (order(1, more="unknown field"), "ok", 1, 10.0),
    ([order(1)], "ok", 1, 10.0),                        # array of objects
    (order(1, "cheap"), "bad", 1, None),                # wrong type
    (order("x"), "bad", None, 10.0),
    (order(1, order_date="someday"), "bad", 1, 10.0),
    ('{"order_id": 1, "total_amount": ', "bad", None, None),
    ("no json", "bad", None, None)])
def test_rows_are_read_leniently_or_quarantined(spark, tmp_path, line, status, order_id, total):
    land(str(tmp_path), [order(99), line])
    got = [r for r in scan(spark, str(tmp_path)).collect() if r.order_id != 99]
    assert [(r._status, r.total_amount) for r in got] == [(status, total)]
    assert (got[0]._corrupt_record is not None) == (status == "bad")
    if status == "ok" or order_id is None:
        assert got[0].order_id == order_id


def test_counting_and_collecting_agree(spark, tmp_path):
    land(str(tmp_path), [order(1), "{broken", order(2), order(3, "cheap")])
    rows_ = scan(spark, str(tmp_path))
    assert (rows_.count(), len(rows_.collect())) == (4, 4)
    assert ndjson.good(rows_).count() == len(ndjson.good(rows_).collect()) == 2
    assert rows(ndjson.good(rows_), "order_id") == [(1,), (2,)]      # one column, same verdict
    assert sorted(r[0][:7] for r in ndjson.quarantined(rows_).collect()) == ['{"order', "{broken"]


def test_arrays_compression_and_several_days(spark, tmp_path):
    root = str(tmp_path)
    land(root, [[order(1), order(2)]])
    land(root, [order(3)], name="more.json.gz")
    land(root, [order(4)], day=dt.date(2026, 7, 1))
    assert rows(ndjson.good(scan(spark, root)), "order_id") == [(1,), (2,), (3,), (4,)]


def test_elements_of_an_array_are_judged_one_by_one(spark, tmp_path):
    land(str(tmp_path), [[order("1"), order("2")], [order(3), order(4, "cheap"), order("5")],
                         '[7, null, "no", {"order_id": 6}, [{"order_id": 8}]]', "[]", "  ",
                         '[{"order_id": 9}, {"order_id": '])
    found = scan(spark, str(tmp_path))
    assert rows(ndjson.good(found), "order_id") == [(1,), (2,), (3,), (5,), (6,)]
    texts = sorted(r[0] for r in ndjson.quarantined(found).collect())
    assert [t for t in texts if "cheap" not in t] == [
        "7", '[{"order_id": 9}, {"order_id": ', '[{"order_id":8}]', "no", "null"]
    assert len(texts) == 6


def test_one_array_over_several_lines(spark, tmp_path):
    land(str(tmp_path), [json.dumps([order(1), order(2)], indent=1)])
    assert rows(ndjson.good(scan(spark, str(tmp_path), multi_line=True)), "order_id") == [(1,), (2,)]


def test_written_days_are_read_back_and_replaced(spark, tmp_path):
    root = str(tmp_path)
    land(root, [order(1), order(2)])
    df = ndjson.good(scan(spark, root)).cache()
    out = str(tmp_path / "out")
    assert ndjson.write_ndjson(df, out, ORDERS, DAY, compression="gzip").endswith("day=03")
    assert rows(ndjson.read_day(spark, out, ORDERS, DAY)) == rows(df)
    ndjson.write_ndjson(df.filter("order_id = 2"), out, ORDERS, DAY)
    assert rows(ndjson.read_day(spark, out, ORDERS, DAY), "order_id") == [(2,)]
    df.unpersist()


def test_no_rows_write_nothing_and_a_missing_day_is_empty(spark, frame, tmp_path):
    root = str(tmp_path)
    assert ndjson.write_ndjson(frame([], ORDERS.fields), root, ORDERS, DAY) is None
    assert list(tmp_path.iterdir()) == []
    empty = ndjson.read_day(spark, root, ORDERS, DAY)
    assert empty.count() == 0 and empty.columns == ORDERS.fields.names


def test_one_stamp_and_one_load_id_for_a_batch(frame):
    df = ndjson.with_load_id(ndjson.stamp(frame([(1,), (2,)], "id long"), AT), AT)
    assert len(rows(df.select("_extracted_at", "_load_id").distinct())) == 1
    ids = ndjson.with_load_id(frame([(1,), (2,)], "id long")).select("_load_id").distinct().collect()
    assert len(ids) == 1 and len(ids[0][0]) == 32


# ── streams ──────────────────────────────────────────────────────────────────

def test_a_file_is_loaded_once(spark, tmp_path):
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    assert load_new_files(spark, root, lake, ORDERS) is False
    assert bronze(spark, lake, ORDERS).count() == 0
    land(root, [order(1), "{broken"])
    for _ in range(2):
        assert load_new_files(spark, root, lake, ORDERS, AT)
    assert rows(bronze(spark, lake, ORDERS), "order_id") == [(1,)]
    assert rows(rejected(spark, lake, ORDERS)) == [("{broken",)]
    land(root, [order(2)], day=dt.date(2026, 6, 4))
    load_new_files(spark, root, lake, ORDERS, "2026-06-04 06:00:00", max_files=1)
    assert rows(bronze(spark, lake, ORDERS), "order_id") == [(1,), (2,)]
    assert bronze(spark, lake, ORDERS).select("_load_id").distinct().count() == 2


def test_a_forced_load_appends_all_files_again(spark, tmp_path):
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    land(root, [order(1)])
    load_new_files(spark, root, lake, ORDERS)
    for _ in range(2):      # repeating a reload replaces what it wrote
        force_load(spark, root, lake, ORDERS, "fix-1")
    assert rows(bronze(spark, lake, ORDERS), "order_id") == [(1,), (1,)]
    load_new_files(spark, root, lake, ORDERS)
    assert bronze(spark, lake, ORDERS).count() == 2
    assert CLEAN["orders"](bronze(spark, lake, ORDERS)).count() == 1


def test_raw_tables_lie_by_day_and_a_day_reads_its_folders_alone(spark, tmp_path):
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    days = [dt.date(2026, 6, 3), dt.date(2026, 6, 4)]
    for i, day in enumerate(days):
        land(root, [order(i), "{broken"], day=day)
    load_new_files(spark, root, lake, ORDERS, AT)
    day = bronze(spark, lake, ORDERS, days[1])
    assert rows(day, "order_id") == [(1,)]
    text = plan(day)
    assert "MetadataLogFileIndex" not in text and "PartitionFilters" in text
    from urllib.parse import unquote
    read = day._jdf.queryExecution().executedPlan().toString()
    assert "day" in read[read.index("PartitionFilters"):]
    assert len(day.select("order_id").inputFiles()) >= 1
    files = {unquote(f).split("/rows/")[1].rsplit("/", 1)[0]
             for f in stored(spark, lake, ORDERS).inputFiles()}
    assert files == {f"_load=files-0/year=2026/month=6/day={d}/_status={s}"
                     for d in (3, 4) for s in ("ok", "bad")}
    assert [tuple(r) for r in loads(spark, lake, ORDERS).collect()] == [
        ("files-0", 2, dt.datetime(2026, 6, 3, 6, 0, 0, 123456))]


def test_a_load_that_broke_off_is_replaced(spark, tmp_path, monkeypatch):
    """The rows are written, then the run dies before the batch is done; the next run repeats it."""
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    land(root, [order(1), order(2)])
    kept = streaming_bronze._append

    def dies(*args):
        kept(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(streaming_bronze, "_append", dies)
    with pytest.raises(Exception, match="executor lost"):
        load_new_files(spark, root, lake, ORDERS, AT)
    monkeypatch.setattr(streaming_bronze, "_append", kept)
    load_new_files(spark, root, lake, ORDERS, AT)
    assert rows(bronze(spark, lake, ORDERS), "order_id") == [(1,), (2,)]
    assert loads(spark, lake, ORDERS).agg({"row_count": "sum"}).first()[0] == 2
    assert Path(raw_path(lake, ORDERS)).exists()


def test_silver_stream_keeps_the_newest_of_late_and_repeated_batches(spark, tmp_path):
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    table = Table(spark, scratch_path(spark, "stg"), "order_id", 10)
    batches = [(4, [order(1, 20.0, "2026-06-04T06:00:00")]),
               (3, [order(1, 10.0), order(2, 5.0), order(3, -1.0)]),     # older, comes later
               (5, [order(3, 3.0, "2026-06-05T06:00:00"), order(2, 0.0, "2026-06-05T06:00:00")])]
    for day, lines in batches:
        land(root, lines, day=dt.date(2026, 6, day))
        load_new_files(spark, root, lake, ORDERS)
        for _ in range(2):
            refresh_silver(spark, lake, ORDERS, table)
    assert rows(table.read(), "order_id", "total_amount") == [(1, 20.0), (2, 5.0), (3, 3.0)]
    assert table.read().first().status == "pending"
    assert rows(table.read(), *table.read().columns) == rows(
        CLEAN["orders"](bronze(spark, lake, ORDERS)), *table.read().columns)


def test_a_forced_load_reaches_the_clean_table(spark, tmp_path):
    root, lake = str(tmp_path / "in"), str(tmp_path / "lake")
    table = Table(spark, scratch_path(spark, "stg"), "order_id", 10)
    refresh_silver(spark, lake, ORDERS, table)                # nothing landed yet: an empty table
    assert table.read().count() == 0 and "status" in table.read().columns
    land(root, [order(1, 10.0)])
    load_new_files(spark, root, lake, ORDERS)
    refresh_silver(spark, lake, ORDERS, table)
    land(root, [order(1, 20.0)])                              # mended in place, under its old name
    load_new_files(spark, root, lake, ORDERS)
    force_load(spark, root, lake, ORDERS, "mended")
    for _ in range(2):
        refresh_silver(spark, lake, ORDERS, table)
    assert rows(table.read(), "order_id", "total_amount") == [(1, 20.0)]


# ── cleaning ─────────────────────────────────────────────────────────────────

def test_an_invalid_newest_row_lets_an_older_one_through(frame):
    t1, t2 = dt.datetime(2026, 1, 1), dt.datetime(2026, 1, 2)
    schema = ENTITIES["products"].fields
    make = lambda i, price, stock, at: (
        i, " Mug ", " Home ", price, 4.0, stock, 4.5, 3, t1, at)
    got = CLEAN["products"](frame(
        [make(1, 10.005, -3, t1), make(1, 0.0, 5, t2), make(2, 5.0, None, t1), make(None, 5.0, 1, t1),
         make(3, None, 1, t1)], schema))
    assert rows(got, "product_id", "title", "category", "price", "stock_quantity") == [
        (1, "Mug", "home", 10.005, 0), (2, "Mug", "home", 5.0, None)]


def test_review_scale_is_inclusive(frame):
    at = dt.datetime(2026, 1, 1)
    got = CLEAN["reviews"](frame(
        [(i, 1, 1, 1, r, " ok ", at, at, at) for i, r in enumerate([0.9, 1.0, 5.0, 5.1, None])],
        REVIEWS.fields))
    assert rows(got, "rating", "review_text") == [(1.0, "ok"), (5.0, "ok")]
