"""Every registered query against its SQL on the smallest tables."""

import pytest

from tests.compare import differences, duck, duck_rows, spark_rows
from tierweave.plans.oracle import ORACLE
from tierweave.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(ORACLE) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, connection, name):
    mine = spark_rows(QUERIES[name](spark, FOLDER))
    assert mine[1], "a query without rows tests nothing"
    assert differences(mine, duck_rows(connection, ORACLE[name])) is None


def test_entry(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


def test_session_zone_does_not_matter(spark, connection):
    for name in ("silver_tickets", "revenue_daily", "dq_suite_tickets", "incremental_window", "asof_train"):
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        try:
            mine = spark_rows(QUERIES[name](spark, FOLDER))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert differences(mine, duck_rows(connection, ORACLE[name])) is None
