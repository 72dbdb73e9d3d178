
import pytest
from pyspark.sql import functions as F

from tidemark.functions import hours_crossed, money, per, title_case
from tidemark.session import materialize, shared_root


@pytest.mark.parametrize("text, expected", [
    ("winston-salem", "Winston-Salem"), ("NEW YORK", "New York"), ("o'fallon", "O'fallon"),
    ("a.b,c/d\\e", "A.B,C/D\\E"), ("one\ttwo\nthree", "One\tTwo\nThree"), ("", ""), (None, None),
    ("x  y", "X  Y"), ("[st] (paul)", "[St] (Paul)"), ("3rd ave", "3rd Ave"),
    ("$tone $1", "$Tone $1")])
def test_title_case(frame, text, expected):
    assert frame([(text,)], "s string").selectExpr(title_case("s")).first()[0] == expected


@pytest.mark.parametrize("start, end, hours", [
    ("2026-01-01 00:59:00", "2026-01-01 01:01:00", 1),
    ("2026-01-01 01:00:00", "2026-01-01 01:59:59", 0),
    ("2026-01-01 23:59:59", "2026-01-02 00:00:00", 1),
    ("2026-01-01 10:00:00", "2026-01-03 09:30:00", 47),
    ("2026-01-01 10:00:00", "2026-01-01 08:30:00", -2),
    (None, "2026-01-01 08:30:00", None)])
def test_hours_crossed(frame, start, end, hours):
    df = frame([(start, end)], "a string, b string").select(
        F.col("a").cast("timestamp_ntz").alias("a"), F.col("b").cast("timestamp_ntz").alias("b"))
    assert df.select(hours_crossed(F.col("a"), F.col("b"))).first()[0] == hours


def test_money_does_not_depend_on_order(frame):
    values = [(0.1,), (0.2,), (1e9,), (-1e9,), (0.3,)]
    sums = {frame(v, "a double").select(F.sum(money("a"))).first()[0]
            for v in (values, values[::-1])}
    assert [str(s) for s in sums] == ["0.60000000"]


def test_per_rounds_half_up_and_knows_no_zero_division(frame):
    df = frame([(1.005, 1), (1.0, 0), (1.0, None), (1.0, 3), (None, 3), (-0.125, 1)],
               "a double, n long")
    got = [r[0] for r in df.select(per(F.col("a").cast("decimal(20,3)"), F.col("n"))).collect()]
    assert [None if g is None else float(g) for g in got] == [1.01, None, None, 0.33, None, -0.13]


def test_materialize_writes_below_the_shared_folder(spark, frame):
    df = materialize(frame([(1, "a")], "i int, s string"), "probe")
    assert [tuple(r) for r in df.collect()] == [(1, "a")]
    assert all(shared_root(spark) in f for f in df.inputFiles())
