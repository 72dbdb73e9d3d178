from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

from tidemark.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = session("tests", "local[8]", spark__sql__shuffle__partitions="4",
                spark__ui__enabled="false", spark__driver__memory="8g",
                spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def frame(spark):
    """Rows under a schema given as text."""
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)
    return make


def rows(df, *order):
    """The rows as plain tuples, sorted."""
    df = df.select(*order) if order else df
    return sorted((tuple(r) for r in df.collect()), key=lambda r: [(v is None, str(v)) for v in r])


def plan(df) -> str:
    return df._jdf.queryExecution().toString()
