"""Every query against its SQL twin, and the flagship query."""

from __future__ import annotations

import pytest

import __spark_entry__ as driver
from tests.conftest import SF, sorted_rows

QUERIES, TWINS = driver.queries(), driver.oracle_sql()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    result = QUERIES[name](spark, SF)
    rows = result.collect()
    if name not in TWINS:
        assert rows
        return
    cursor = duck.execute(TWINS[name])
    expected = sorted_rows([c[0] for c in cursor.description], cursor.fetchall())
    assert sorted_rows(result.columns, rows) == expected


def test_twins_have_queries():
    assert set(TWINS) <= set(QUERIES)


def test_entry(spark):
    df = driver.entry(spark)
    assert df.columns == ["class_idx", "cell", "n", "south", "north", "west", "east"]
    assert df.count() == 13
