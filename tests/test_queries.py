"""Every query that has SQL gives the same rows, columns, types and values as that SQL."""

import pytest

from tests.oracle import compare, connect
from tidemark.plans.catalog import load

QUERIES, SQL = load()


@pytest.fixture(scope="module")
def con(sf):
    return connect(sf)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, sf, con, name):
    assert compare(QUERIES[name](spark, sf), con, SQL[name]) == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert rows and all(0 <= r["churn_rate_pct"] <= 100 for r in rows)


@pytest.mark.parametrize("name", ["schema_report", "latency_quantiles_approx", "positive_score", "feature_importance",
                                  "importance_csv", "score_with_model", "stream_latency"])
def test_rows_only(spark, sf, name):
    assert QUERIES[name](spark, sf).collect()
