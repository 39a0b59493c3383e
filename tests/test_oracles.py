"""Every registered query against its SQL counterpart."""

import __spark_entry__ as entry_point
import pytest
from oracle import difference, duck

from tidelog.plans.oracles import ORACLES
from tidelog.plans.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    result = QUERIES[name](spark, sf_dir)
    if name in ORACLES:
        assert difference(result, con, ORACLES[name]) is None
    else:
        assert result.count() > 0


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry_point_registers_them():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())


def test_entry(spark):
    assert entry_point.entry(spark).columns == ["id", "actor", "alias"]
