import hashlib

from conftest import plan, rows

from pyspark.sql import functions as F

from tidemark.operators import advance, overlapping_versions, snapshot
from tidemark.session import materialize

SCHEMA = "id long, city string, name string"
DAY = ["2026-01-01 06:00:00", "2026-01-02 06:00:00", "2026-01-03 06:00:00", "2026-01-04 06:00:00"]


def run(frame, *days, **options):
    history = None
    for when, data in zip(DAY, days):
        history = snapshot(history, frame(data, SCHEMA), "id", ["city"], when, **options)
    return history


def spans(history):
    """(id, city, first day, last day) with days by number, 0 for open."""
    day = {w: i + 1 for i, w in enumerate(DAY)}
    return sorted((r.id, r.city or "", day[str(r.dbt_valid_from)],
                   day[str(r.dbt_valid_to)] if r.dbt_valid_to else 0) for r in history.collect())


def test_first_run_opens_everything(frame):
    history = run(frame, [(1, "a", "x"), (2, None, "y")])
    assert spans(history) == [(1, "a", 1, 0), (2, "", 1, 0)]
    assert history.filter("id = 1").first().dbt_scd_id == hashlib.md5(
        f"1|{DAY[0]}".encode()).hexdigest()


def test_change_closes_and_opens(frame):
    history = run(frame, [(1, "a", "x"), (2, "b", "y")], [(1, "A", "x"), (2, "b", "y")])
    assert spans(history) == [(1, "A", 2, 0), (1, "a", 1, 2), (2, "b", 1, 0)]


def test_unchecked_column_leaves_the_row_as_it_was(frame):
    history = run(frame, [(1, "a", "old")], [(1, "a", "new")])
    assert rows(history, "name", "dbt_valid_to") == [("old", None)]


def test_null_to_value_and_back_are_changes(frame):
    history = run(frame, [(1, None, "x")], [(1, "a", "x")], [(1, None, "x")])
    assert spans(history) == [(1, "", 1, 2), (1, "", 3, 0), (1, "a", 2, 3)]


def test_there_and_back_gives_three_versions(frame):
    assert spans(run(frame, [(1, "a", "x")], [(1, "b", "x")], [(1, "a", "x")])) == [
        (1, "a", 1, 2), (1, "a", 3, 0), (1, "b", 2, 3)]


def test_vanished_key_is_closed_and_may_reappear(frame):
    history = run(frame, [(1, "a", "x"), (2, "b", "y")], [(2, "b", "y")],
                  [(2, "b", "y")], [(1, "a", "x"), (2, "b", "y")])
    assert spans(history) == [(1, "a", 1, 2), (1, "a", 4, 0), (2, "b", 1, 0)]


def test_vanished_key_stays_open_if_asked(frame):
    history = run(frame, [(1, "a", "x")], [(2, "b", "y")], close_vanished=False)
    assert spans(history) == [(1, "a", 1, 0), (2, "b", 2, 0)]


def test_rerun_changes_nothing(frame):
    data = [(1, "a", "x"), (2, None, "y")]
    assert rows(run(frame, data, data, data)) == rows(run(frame, data))


def test_one_join_and_closed_rows_are_not_shuffled(frame):
    history = materialize(run(frame, [(1, "a", "x")]), "history")
    text = plan(advance(history, frame([(1, "b", "x")], SCHEMA), "id", ["city"], DAY[1]))
    physical = text[text.index("== Physical Plan =="):]
    assert physical.count("FullOuter") == 1


def overlaps_by_hand(data):
    far = "9999"
    return sorted((a[0], a[1], b[1]) for a in data for b in data
                  if a[0] == b[0] and a[3] != b[3] and a[1] < b[1]
                  and b[1] < (a[2] or far) and a[1] < (b[2] or far))


def as_spans(frame, data):
    return frame(data, "id long, f string, t string, sid string").selectExpr(
        "id", "CAST(f AS TIMESTAMP_NTZ) AS dbt_valid_from",
        "CAST(t AS TIMESTAMP_NTZ) AS dbt_valid_to", "sid AS dbt_scd_id")


def test_overlap_equals_brute_force(frame):
    import random
    rng = random.Random(3)
    data = []
    for i in range(150):
        a, length = rng.randint(1, 27), rng.choice([0, 1, 3, 400, 900])
        month, year = rng.randint(1, 12), 2024 + rng.randint(0, 1)
        start = f"{year}-{month:02d}-{a:02d} 00:00:00"
        end = None if length == 900 else f"{year + length // 365}-{month:02d}-{min(28, a + length % 365):02d} 00:00:00"
        data.append((rng.choice([1, 1, 1, 2, 3, i + 10]), start, end, f"s{i}"))
    for grid in (1, 28, 1000):
        got = overlapping_versions(as_spans(frame, data), "id", grid_days=grid)
        assert sorted((r.id, str(r.a_valid_from), str(r.b_valid_from)) for r in got.collect()) == \
            overlaps_by_hand(data)


def test_sound_history_has_no_overlap(frame):
    data = [(1, DAY[0], DAY[1], "a"), (1, DAY[1], DAY[2], "b"), (1, DAY[2], None, "c"),
            (2, DAY[0], None, "d"), (3, DAY[0], None, "e"), (3, DAY[0], DAY[1], "f")]
    assert overlapping_versions(as_spans(frame, data), "id").count() == 0


def test_many_adjacent_versions_of_one_key_pair_up_with_none(spark):
    second = "timestamp_ntz'2026-01-01 00:00:00' + make_dt_interval(0, 0, 0, id"
    sound = spark.range(100_000).selectExpr(
        "1L AS id", f"{second}) AS dbt_valid_from", f"{second} + 1) AS dbt_valid_to",
        "string(id) AS dbt_scd_id")
    assert overlapping_versions(sound, "id").count() == 0
    longer = sound.withColumn("dbt_valid_to", F.when(
        F.col("dbt_scd_id") == "10", F.col("dbt_valid_to") + F.expr("make_dt_interval(0, 0, 0, 3)"))
        .otherwise(F.col("dbt_valid_to")))
    assert overlapping_versions(longer, "id").count() == 3


def test_overlap_keeps_repeated_rows_and_drops_nulls(frame):
    data = [(1, DAY[0], None, "a"), (1, DAY[0], None, "a"), (1, DAY[1], None, "b"),
            (None, DAY[0], None, "c"), (None, DAY[1], None, "d"), (1, None, None, "e")]
    assert overlapping_versions(as_spans(frame, data), "id").count() == 2
