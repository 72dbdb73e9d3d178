import random
from decimal import Decimal

import pytest
from conftest import plan
from pyspark.sql import Window, functions as F

from tidemark.operators import Order, ntile_scores
from tidemark.operators.ntile import tile_ends


def check(df, order, tiles=5):
    got = ntile_scores(df, "id", {"tile": order}, tiles)
    by = F.col(order.column)
    by = by.desc_nulls_first() if order.descending else by.asc_nulls_last()
    want = df.withColumn("tile", F.ntile(tiles).over(Window.orderBy(by, "id")))
    assert sorted(map(tuple, got.select("id", "tile").collect())) == sorted(
        map(tuple, want.select("id", "tile").collect()))
    return got


@pytest.mark.parametrize("n", [1, 3, 5, 10, 13])
def test_small_tables(frame, n):
    check(frame([(i, (i * 7) % 5) for i in range(n)], "id long, k long"), Order("k"))


def test_empty_table(frame):
    assert ntile_scores(frame([], "id long, k long"), "id", {"tile": Order("k")}).count() == 0


@pytest.mark.parametrize("descending", [False, True])
def test_ties_nulls_and_a_heavy_value(frame, descending):
    rng = random.Random(5)
    data = [(i, rng.choice([None, 4, 4, 4, rng.randint(0, 9), rng.randint(0, 10 ** 6)]))
            for i in range(3007)]
    df = frame(data, "id long, k long").repartition(8)
    check(df, Order("k", descending))


def test_decimals_and_several_scores_at_once(frame):
    rng = random.Random(6)
    data = [(i, Decimal(rng.randint(-500, 500)) / 100, float(rng.randint(0, 3))) for i in range(999)]
    df = frame(data, "id long, k decimal(28,2), d double")
    got = ntile_scores(df, "id", {"a": Order("k", True), "b": Order("d")})
    want = df.select("id", F.ntile(5).over(Window.orderBy(F.desc("k"), "id")).alias("a"),
                     F.ntile(5).over(Window.orderBy("d", "id")).alias("b"))
    assert sorted(map(tuple, got.select("id", "a", "b").collect())) == sorted(
        map(tuple, want.collect()))


def test_one_value_everywhere_is_dealt_to_many_tasks(spark, frame, monkeypatch):
    """Ids part equal keys, so a value that all rows share makes no large task, and the order of the
    tasks is the order of the rows."""
    from tidemark.operators import ntile
    seen = []
    kept = ntile._nth
    monkeypatch.setattr(ntile, "_nth", lambda stored: seen.append(stored) or kept(stored))
    with_parts = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                  "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in with_parts}
    for k, v in with_parts.items():
        spark.conf.set(k, v)
    try:
        check(frame([(i, 7) for i in range(5000)], "id long, k long").repartition(5), Order("k"), 7)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    sizes = [r["count"] for r in seen[0].groupBy(F.shiftright("at", 33)).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 3 * 5000 / 16
    assert "SinglePartition" not in plan(seen[0])


def test_no_row_is_moved_to_label_it(frame):
    got = ntile_scores(frame([(i, i) for i in range(50)], "id long, k long"), "id",
                       {"tile": Order("k")})
    text = plan(got)
    assert "Exchange" not in text and "Window" not in text


def test_tile_ends():
    assert tile_ends(13, 5) == {1: 3, 2: 6, 3: 9, 4: 11}
    assert tile_ends(3, 5) == {1: 1, 2: 2}
    assert tile_ends(0, 5) == {}
