"""Every connectome query against its SQL, on the smallest tables."""

import pytest

from axonlake import queries_more, queries_tables  # noqa: F401
from axonlake.queries import QUERIES, SQL

from .oracle import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert difference(spark, con, FOLDER, QUERIES[name], SQL[name]) in ("", "no rows")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, name):
    assert QUERIES[name](spark, FOLDER).count() >= 0


def test_sums(spark):
    from axonlake.queries import World

    w = World(spark, FOLDER)
    n = w.syn.count()
    x = QUERIES["a03_confidence_weights"](spark, FOLDER).selectExpr("sum(weightHR)", "min(weightHR - weight)", "min(weight - weightHP)").first()
    assert x[0] == n and x[1] >= 0 and x[2] >= 0
    y = QUERIES["a04_body_stats"](spark, FOLDER).selectExpr("sum(downstream)", "sum(upstream)", "sum(post)").first()
    assert y[0] == n and y[1] == y[2] == n
