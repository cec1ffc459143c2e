"""Every registered query against its SQL twin on the smallest tables."""

import warnings

import pytest

from kliping.queries import ORACLE, QUERIES, load_all
from tests.oracle import compare, connect

load_all()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert name in ORACLE
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert compare(spark, con, name, QUERIES[name], ORACLE[name], SF) is None


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).columns[0] == "post_id"
    assert set(entry.oracle_sql()) <= set(entry.queries())
