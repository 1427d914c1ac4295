"""Every registered query equals its DuckDB oracle on the smallest data folder."""

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from metroflow.plans import catalog
from tools.check_oracle import rows


catalog.load_all()
QUERIES = dict(catalog.QUERIES)  # the training-data operators have tests of their own
ORACLES = dict(catalog.ORACLES)
FAST = [n for n in QUERIES if not n.startswith(catalog.STORED)]


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    out = df.collect()
    assert 0 < len(out) <= 10
    assert df.columns == ["route_id", "line_id", "count", "label", "color"]


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    s = QUERIES[name](spark, SF_SMALL).toPandas()
    o = duck.execute(ORACLES[name]).df()
    assert sorted(s.columns) == sorted(o.columns)
    assert rows(s) == rows(o)
