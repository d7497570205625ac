"""The sliced forms must give what the plain forms give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.helpers import FOLDER, rows_of
from txnrisk.operators.baselines import merchant_risk, user_baseline, user_baseline_point_in_time
from txnrisk.operators.behaviour import behaviour_windows, user_frequency
from txnrisk.operators.clean import clean
from txnrisk.operators.features import build_features
from txnrisk.operators.scd2 import asof_join, scd2_from_events
from txnrisk.operators.skew import heavy_keys, join_salted, neighbour, sums_before
from txnrisk.sources.events import read_raw

HOURS = [1, 24, 24 * 7]


@pytest.fixture(scope="module")
def fact(spark):
    return clean(read_raw(spark, FOLDER)).cache()


@pytest.fixture(scope="module")
def users(fact):
    return [r.user_id for r in fact.select("user_id").distinct().orderBy("user_id").collect()][::2]


@pytest.mark.parametrize("hours", HOURS)
def test_behaviour_windows(fact, users, hours):
    assert rows_of(behaviour_windows(fact, heavy=users, hours=hours)) == rows_of(behaviour_windows(fact))


def test_behaviour_windows_when_all_users_are_heavy(fact):
    everyone = [r.user_id for r in fact.select("user_id").distinct().collect()]
    assert rows_of(behaviour_windows(fact, heavy=everyone)) == rows_of(behaviour_windows(fact))


@pytest.mark.parametrize("hours", HOURS)
def test_user_frequency(fact, users, hours):
    assert rows_of(user_frequency(fact, heavy=users, hours=hours)) == rows_of(user_frequency(fact))


@pytest.mark.parametrize("hours", HOURS)
def test_point_in_time_baseline(fact, users, hours):
    sliced = user_baseline_point_in_time(fact, days=7, heavy=users, hours=hours)
    assert rows_of(sliced) == rows_of(user_baseline_point_in_time(fact, days=7))


@pytest.mark.parametrize("hours", HOURS)
@pytest.mark.parametrize("columns", [["billing_country"], ["billing_country", "payment_method"]])
def test_event_time_versions(fact, users, hours, columns):
    arguments = (fact, "user_id", "transaction_date", columns, "transaction_id")
    assert rows_of(scd2_from_events(*arguments, heavy=users, hours=hours)) == rows_of(scd2_from_events(*arguments))


@pytest.mark.parametrize("hours", HOURS)
def test_asof(fact, users, hours):
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country", "payment_method"],
                                "transaction_id")
    # Cut a gap into the history so that ended versions matter.
    versions = versions.filter(F.col("payment_method") != "UPI")
    arguments = (fact, versions, "user_id", "transaction_date", "transaction_id", {"payment_method": "then"})
    assert rows_of(asof_join(*arguments, heavy=users, hours=hours)) == rows_of(asof_join(*arguments))


def test_features(fact, users):
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country"], "transaction_id")
    inputs = (fact, versions, user_baseline(fact, "2024-02-10"), merchant_risk(fact, "2024-04-10"))
    sliced = build_features(*inputs, heavy_users=users, heavy_merchants=["M00001", "M00002"])
    assert rows_of(sliced) == rows_of(build_features(*inputs))


def test_neighbour_both_ways(spark):
    rows = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1, h // 60, h % 60), h) for h in range(0, 600, 25)], "k string, at timestamp, n int")
    value = F.struct("n")
    for back in (True, False):
        plain = neighbour(rows, "k", ["at", "n"], value, "other", back=back)
        sliced = neighbour(rows, "k", ["at", "n"], value, "other", back=back, heavy=["a"], hours=2)
        assert rows_of(sliced, "n", "other.n") == rows_of(plain, "n", "other.n")


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_salted_join(spark, how):
    left = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 50), ("c", 51), (None, 52)], "k string, n int")
    right = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("d", 3.0)], "k string, v double")
    salted = join_salted(left, right, "k", "n", heavy=["a", "d"], how=how, salts=4)
    assert rows_of(salted) == rows_of(left.join(right, "k", how))


def test_heavy_keys(spark):
    rows = spark.range(10_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"))
    assert heavy_keys(rows, "k", min_rows=1000) == ["hot"]
    assert heavy_keys(rows, "k", min_rows=100_000) == []
    assert heavy_keys(rows.limit(0), "k", min_rows=1) == []


def test_moves_that_no_row_asks_for_are_not_summed(spark):
    """Keys without rows are left out before the measures are made, which would fail on them."""
    rows = spark.createDataFrame([("a", 5, "x"), ("b", 9, "y"), (None, 3, "z")], "k string, at int, id string").withColumn(
        "at", F.timestamp_seconds("at"))
    moves = spark.createDataFrame([("a", 1, 2), ("a", 4, 3), ("a", 5, 9), ("b", 9, 1), ("c", 1, -1), (None, 1, 4)],
                                  "k string, at int, n int").withColumn("at", F.timestamp_seconds("at"))
    total = {"total": F.when(F.col("n") < 0, F.raise_error(F.lit("not asked for")).cast("int")).otherwise(F.col("n"))}
    for heavy in ([], ["b"]):
        found = sums_before(rows, moves, "k", "at", total, heavy=heavy, sparse=True)
        assert rows_of(found, "id", "total") == [("x", 5), ("y", 0), ("z", 4)]
