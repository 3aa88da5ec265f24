"""Every registered query against its SQL, or at least that it gives rows."""

import pytest
from oracle import compare, duck

from voxtab.plans import queries


@pytest.fixture(scope="module")
def con(sf):
    return duck(sf)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_equals_sql(spark, sf, con, name):
    compare(spark, con, sf, queries.QUERIES[name], queries.SQL[name])


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_gives_rows(spark, name):
    # The smallest tables hold one plane only, whose points have no tetrahedra.
    assert queries.QUERIES[name](spark, "/root/testdata/sf0.01").count() > 0


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
