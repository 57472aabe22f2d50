"""Every registered query against its check SQL on the smallest tables."""

from __future__ import annotations

import os

import pytest

from tests.conftest import SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="no test tables")


def _names():
    from tarnlake.registry import load_registry

    return sorted(load_registry())


@pytest.fixture(scope="module")
def checker():
    import check_queries

    return check_queries, check_queries.connect(SMALL)


@pytest.mark.parametrize("name", _names())
def test_query(name, spark, checker):
    from __spark_entry__ import oracle_sql, queries

    module, con = checker
    df = queries()[name](spark, SMALL)
    sql = oracle_sql().get(name)
    if sql is None:
        df.count()
    else:
        assert module.compare(df, con, sql) == ""


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 0
    assert "average_order_value" in df.columns
