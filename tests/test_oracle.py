"""Every query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
from comparing import compare, duck

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = QUERIES[name](spark, SF)
    if name in ORACLE:
        assert compare(frame, con, ORACLE[name]) is None
    else:
        assert frame.columns and frame.count() >= 0


def test_every_query_has_sql():
    """But for the optional part, whose own tests compare what SQL cannot say."""
    own = {n for n in QUERIES if n != "pipeline" and not n.startswith("op")}
    assert own and own == set(ORACLE) & own and set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert contract.entry(spark).count() == 7
