"""Every registered query against its SQL, at the smallest scale."""

import pytest

from checks import REGISTRY
from tests.compare import compare, connect


@pytest.fixture(scope="module")
def duck(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, duck, sf, name):
    fn, sql = REGISTRY[name]
    problem, _, _ = compare(spark, duck, fn, sql, sf)
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry
    row = entry.entry(spark).first()
    assert row["total_rows"] == row["current_rows"] + row["historical_rows"] and row["historical_rows"] > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
