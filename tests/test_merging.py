import datetime as dt
import random
from pathlib import Path

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from tidemark.operators import (
    DuplicateKeys, high_water_mark, latest, require_unique, since, sync_columns, upsert)
from tidemark.plans import silver
from tidemark.schemas import ENTITIES
from tidemark.session import scratch_path, shared_root
from tidemark.sources import ndjson
from tidemark.sources.tables import FIRST, NONE, Table, chunk_of
from tidemark.streaming.bronze import load_new_files
from tidemark.streaming.silver import refresh_silver

T1, T2, T3 = (dt.datetime(2026, 1, d) for d in (1, 2, 3))
SCHEMA = "id long, v string, _extracted_at timestamp_ntz"


def test_latest_takes_the_newest_and_null_counts_as_newest(frame):
    df = frame([(1, "old", T1), (1, "new", T2), (2, "only", T1), (3, "dated", T3),
                (3, "undated", None)], SCHEMA)
    assert rows(latest(df, "id"), "id", "v") == [(1, "new"), (2, "only"), (3, "undated")]


def test_latest_breaks_ties_by_content_whatever_the_order(frame):
    data = [(1, "a", T1), (1, "c", T1), (1, "b", T1)]
    for order in (data, data[::-1]):
        assert rows(latest(frame(order, SCHEMA).repartition(3), "id"), "v") == [("c",)]


def test_latest_prunes_before_the_shuffle(frame):
    text = plan(latest(frame([(1, "a", T1)], SCHEMA), "id"))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("WindowGroupLimit") == 2
    assert physical.rindex("Partial") > physical.index("Exchange")   # plans print top down


def test_mark_of_nothing_takes_everything(frame):
    df = frame([(1, "a", T1), (2, "b", T2)], SCHEMA)
    assert high_water_mark(None) is None
    assert high_water_mark(df.limit(0)) is None
    assert since(df, None).count() == 2


def test_mark_is_strict(frame):
    df = frame([(1, "older", T1), (2, "same", T2), (3, "newer", T3)], SCHEMA)
    target = frame([(9, "x", T2)], SCHEMA)
    assert rows(since(df, high_water_mark(target)), "v") == [("newer",)]


def test_mark_reaches_the_scan(spark, frame):
    path = scratch_path(spark, "mark")
    frame([(1, "a", T1)], SCHEMA).write.parquet(path)
    text = plan(since(spark.read.parquet(path), T1))
    assert "GreaterThan(_extracted_at,2026-01-01T00:00" in text


def test_upsert_updates_inserts_keeps_and_can_be_repeated(frame):
    target = frame([(1, "a", T1), (2, "b", T1)], SCHEMA)
    source = frame([(2, "B", T2), (3, "C", T2)], SCHEMA)
    once = upsert(target, source, "id")
    assert rows(once, "id", "v") == [(1, "a"), (2, "B"), (3, "C")]
    assert rows(upsert(once, source, "id")) == rows(once)


def test_upsert_by_age_ignores_late_rows_and_lets_equal_ones_win(frame):
    target = frame([(1, "new", T2), (2, "same", T2)], SCHEMA)
    source = frame([(1, "late", T1), (2, "again", T2), (3, "first", T1)], SCHEMA)
    assert rows(upsert(target, source, "id", newer_by="_extracted_at"), "id", "v") == [
        (1, "new"), (2, "again"), (3, "first")]


def test_columns_follow_the_source(frame):
    target = frame([(1, "a", 7)], "id long, gone string, kept int")
    source = frame([(2, 8, "n")], "id long, kept long, fresh string")
    got = upsert(target, source, "id")
    assert got.columns == ["id", "kept", "fresh"]
    assert got.schema["kept"].dataType.simpleString() == "bigint"
    assert rows(got) == [(1, 7, None), (2, 8, "n")]
    assert sync_columns(target, source).columns == source.columns


def test_duplicate_source_keys_are_refused(frame):
    require_unique(frame([(1,), (2,), (None,), (None,)], "id long"), "id")
    with pytest.raises(DuplicateKeys, match="id = 1 occurs 2 times"):
        require_unique(frame([(1,), (1,)], "id long"), "id")


def test_table_divides_by_its_keys_and_rewrites_touched_chunks_only(spark, frame):
    table = Table(spark, scratch_path(spark, "table"), "id", chunk_rows=10)
    assert table.read() is None and not table.exists() and table.mark() is None
    table.merge(frame([(i, "a", T1) for i in range(100)], SCHEMA))
    first = table._commits()
    assert 8 <= len(first) <= 11 and {c["version"] for c in first.values()} == {1}
    assert sum(c["rows"] for c in first.values()) == table.rows() == 100
    table.merge(frame([(15, "B", T2), (16, "d", T2), (200, "e", T2)], SCHEMA))
    assert table.rows() == 101 == table.read().count() and table.mark() == T2
    assert rows(table.read().filter("v <> 'a'"), "id", "v") == [(15, "B"), (16, "d"), (200, "e")]
    changed = [n for n, c in table._commits().items() if c["version"] == 2]
    assert 2 <= len(changed) <= 3 and table.read(after=1).count() < 40
    assert len([*table.read(changed).inputFiles()]) == len(changed)


def test_random_keys_give_a_handful_of_chunks(spark):
    table = Table(spark, scratch_path(spark, "table"), "id", chunk_rows=2000)
    keys = spark.range(10_000).selectExpr("xxhash64(id) AS id", "id AS v")
    table.merge(keys)
    sizes = [c["rows"] for c in table._commits().values()]
    assert 4 <= len(sizes) <= 6 and sum(sizes) == 10_000 and max(sizes) < 3000
    table.merge(keys.filter("v < 3").withColumn("v", F.lit(-1).cast("long")))
    assert sum(c["version"] == 2 for c in table._commits().values()) <= 3
    assert table.read().count() == 10_000 and table.read().filter("v = -1").count() == 3
    table.merge(spark.range(20_000, 30_000).selectExpr("xxhash64(id) AS id", "id AS v"))
    assert table.rows() == 20_000 == table.read().select("id").distinct().count()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7, 8, 100])
def test_chunk_of_finds_the_last_border_not_above(frame, n):
    borders = [10 * i - 30 for i in range(n)]
    keys = [None, *range(-45, 10 * n, 3), *borders]
    got = frame([(k,) for k in keys], "id long").select("id", chunk_of("id", borders)).collect()
    for k, chunk in got:
        below = [b for b in borders if k is not None and b <= k]
        assert chunk == (NONE if k is None else str(below[-1]) if below else FIRST)


def test_table_ignores_what_was_not_committed(spark, frame):
    table = Table(spark, scratch_path(spark, "table"), "id")
    table.merge(frame([(1, "a", T1)], SCHEMA))
    frame([(1, "lost", T2)], SCHEMA).write.parquet(f"{table.root}/data/version=2/chunk=first")
    assert rows(table.read(), "v") == [("a",)]
    table.merge(frame([(1, "next", T3)], SCHEMA))
    assert rows(table.read(), "v") == [("next",)]


def test_table_follows_the_columns_of_its_last_batch(spark, frame):
    table = Table(spark, scratch_path(spark, "table"), "id", chunk_rows=1)
    table.merge(frame([(i, "a") for i in range(9)], "id long, gone string"))
    table.merge(frame([(1, 5)], "id long, fresh int"))
    assert rows(table.read()) == sorted([(1, 5), *((i, None) for i in range(9) if i != 1)])
    assert table.read().columns == ["id", "fresh"]


def test_table_refuses_duplicates_and_takes_empty_batches(spark, frame):
    table = Table(spark, scratch_path(spark, "table"), "id")
    table.merge(frame([], SCHEMA))
    assert table.exists() and table.rows() == table.read().count() == 0
    with pytest.raises(DuplicateKeys):
        table.merge(frame([(1, "a", T1), (1, "b", T1)], SCHEMA))
    table.merge(frame([(1, "a", T1), (None, "n", T1)], SCHEMA))
    table.merge(frame([], SCHEMA))
    assert rows(table.read(), "id") == [(1,), (None,)]


def test_the_write_counts_what_is_watched(spark, frame):
    """Sums over the versions in use: zero is exact, more may be too many."""
    table = Table(spark, scratch_path(spark, "table"), "id", chunk_rows=10)
    watch = {"null v": F.col("v").isNull(), "value v": ~F.col("v").isin("a", "b")}
    table.merge(frame([(i, "a", T1) for i in range(100)], SCHEMA), watch=watch)
    assert table.watched() == {"null v": 0, "value v": 0}
    table.merge(frame([(5, None, T2), (50, "x", T2)], SCHEMA), watch=watch)
    assert table.watched() == {"null v": 1, "value v": 1}
    table.merge(frame([(5, "b", T2), (50, "b", T2)], SCHEMA), watch=watch)
    assert table.watched() == {"null v": 0, "value v": 0}
    table.merge(frame([(5, "c", T3)], SCHEMA), watch={"null v": watch["null v"]})
    assert table.watched() == {"null v": 0}     # not all versions have watched the other
    table.replace_chunks({"first": frame([(1, None, T1)], SCHEMA)}, watch)
    assert table.watched() == {"null v": 1, "value v": 0}     # and that version has no chunk now


def test_rows_that_are_stored_already_are_left_out_on_request(spark, frame):
    table = Table(spark, scratch_path(spark, "table"), "id")
    table.merge(frame([(1, "a", T1, "then"), (2, None, T1, "then")], SCHEMA + ", looked_up string"))
    table.merge(frame([(1, "a", T1, "now"), (2, None, T1, "now"), (3, "c", T1, "now")],
                      SCHEMA + ", looked_up string"), same=["id", "v", "_extracted_at"])
    assert rows(table.read(), "id", "looked_up") == [(1, "then"), (2, "then"), (3, "now")]


def test_replace_takes_an_empty_table_and_several_chunks(spark, frame):
    table = Table(spark, scratch_path(spark, "table"))
    table.replace(frame([], SCHEMA))
    assert table.exists() and table.read().count() == 0
    one = frame([(1, "a", T1)], SCHEMA)
    table.replace_chunks({"x": one, "y": one.withColumn("id", F.lit(2).cast("long"))})
    assert rows(table.read(), "id") == [(1,), (2,)]


def test_a_hot_key_is_split_by_the_join(spark, frame):
    """A third of the facts share one key; the look-up join splits that shuffle partition."""
    settings = {
        "spark.sql.shuffle.partitions": "64",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB"}
    old = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        facts = spark.range(0, 60000, 1, 8).selectExpr(
            "id", "IF(id % 3 = 0, 7, id % 5000) AS k", "uuid() AS pad")
        lookup = spark.range(5000).selectExpr("id AS k", "id * 2 AS v")
        df = facts.join(lookup, "k", "left")
        assert all(r.v == r.k * 2 for r in df.collect())
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_rows_absorbed_as_they_came_stand_as_ranked_and_merged_ones_would(spark, frame):
    rng = random.Random(7)
    entity, at = ENTITIES["products"], dt.datetime(2026, 1, 1)
    copies = lambda: set(Path(shared_root(spark)).glob("batch-*"))

    def batch(n, keys):
        return frame([(rng.choice([None, *range(keys)]), rng.choice([" a", "b ", None]), rng.choice(["X ", "y"]),
                       rng.choice([1.0, 2.5, -1.0]), rng.choice([None, 0.5]), rng.choice([-3, 4, None]), None, 1,
                       None, rng.choice([None, *(at + dt.timedelta(days=d) for d in range(3))]))
                      for _ in range(n)], entity.fields)

    plain, table = None, Table(spark, scratch_path(spark, "absorbed"), entity.key, 20)
    for n, keys, repeated in ((40, 400, False), (30, 500, False), (300, 60, True), (0, 1, False)):
        rows_ = batch(n, keys)
        if not repeated:
            rows_ = rows_.dropDuplicates([entity.key])
        clean = spark.createDataFrame(silver.products(rows_).collect(), silver.products(rows_).schema)
        plain = clean if plain is None else upsert(plain, clean, entity.key, "_extracted_at")
        plain = spark.createDataFrame(plain.collect(), plain.schema)
        before = copies()
        table.absorb(silver.valid(rows_, "products"), "_extracted_at", silver.tidied("products"))
        assert repeated or copies() == before   # shuffled once, and not stored in between
        assert rows(table.read().select(plain.columns)) == rows(plain)
    assert len(table._commits()) > 2


def test_an_empty_first_batch_is_absorbed_as_an_empty_table(spark, frame):
    table = Table(spark, scratch_path(spark, "absorbed"), "product_id")
    none = frame([], ENTITIES["products"].fields)
    table.absorb(silver.valid(none, "products"), "_extracted_at", silver.tidied("products"))
    assert table.exists() and table.read().columns == silver.products(none).columns
    assert table.read().count() == 0


def test_refreshing_a_clean_table_stores_no_batch_beside_it(spark, frame):
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    orders, at = ENTITIES["orders"], dt.datetime(2026, 1, 1)
    table = Table(spark, scratch_path(spark, "stg_orders"), "order_id", 4)
    before = set(Path(shared_root(spark)).glob("batch-*"))
    for day in (2, 1):
        ndjson.write_ndjson(frame([(i, i, at, "Shipped", None, "x", float(day), at, at + dt.timedelta(days=day))
                                   for i in range(day, 30, day)], orders.fields), landing, orders,
                            dt.date(2026, 1, day))
        load_new_files(spark, landing, root, orders, at)
        refresh_silver(spark, root, orders, table)
    assert set(Path(shared_root(spark)).glob("batch-*")) == before
    assert rows(table.read(), "order_id", "total_amount") == [
        (i, float(1 + (i % 2 == 0))) for i in sorted(range(1, 30), key=str)]
