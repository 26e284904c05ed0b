"""Every query of the screening engine: against its SQL where there is one."""

from __future__ import annotations

import pytest
from compare import differences

from liftwork import catalog

TINY = "/root/testdata/sf0.001"
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.mark.parametrize("name", [k for k in QUERIES if k in SQL])
def test_query_equals_its_sql(spark, name):
    assert differences(spark, TINY, QUERIES[name], SQL[name]) == ""


@pytest.mark.parametrize("name", [k for k in QUERIES if k not in SQL])
def test_query_without_sql_runs(spark, name):
    frame = QUERIES[name](spark, TINY)
    assert frame.count() > 0
    assert len(set(frame.columns)) == len(frame.columns)


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)
