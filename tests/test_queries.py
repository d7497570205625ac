"""Every registered query beside its SQL twin on the smallest data folder."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.compare import compare, connect
from txnrisk.plans.catalogue import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) & set(QUERIES)))
def test_equals_sql(spark, connection, name):
    assert compare(connection, queries()[name](spark, FOLDER), oracle_sql()[name]) == []


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(oracle_sql())))
def test_runs(spark, name):
    assert queries()[name](spark, FOLDER).count() > 0


def test_entry(spark):
    assert entry(spark).columns == [
        "transaction_id", "user_id", "merchant_id", "transaction_date", "fraud_probability", "risk_tier"]


def test_every_statement_has_a_query():
    assert set(oracle_sql()) <= set(queries())
