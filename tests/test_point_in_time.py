"""Features as known just before a transaction, beside plain Python over the same rows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from tests.helpers import FOLDER, at, rows_of, transactions
from txnrisk.operators.point_in_time import (features_point_in_time, prior_baseline, prior_merchant_rate,
                                             sliding_quantile)
from txnrisk.plans import layers

START = at("2024-01-01 00:00:00")


@pytest.fixture(scope="module")
def made(spark):
    """Forty days of three users, one with most rows; instants and amounts repeat."""
    random.seed(7)
    rows = [{"user_id": random.choice(["U1", "U1", "U1", "U2", "U3"]), "merchant_id": random.choice(["M1", "M1", "M2"]),
             "transaction_amount": random.choice([0.01, 5, 5, 19.99, 20, 300, round(random.uniform(1, 99999), 2)]),
             "transaction_date": START + timedelta(hours=6 * random.randrange(160)),
             "is_fraud_label": random.random() < 0.3} for _ in range(300)]
    return transactions(spark, rows)


def plain_baseline(rows, row, days):
    """What the user's rows of the ``days`` before ``row`` say."""
    seen = [r for r in rows if r.user_id == row.user_id
            and row.transaction_date - timedelta(days=days) <= r.transaction_date < row.transaction_date]
    if not seen:
        return 0, None, None, None, None
    amounts = sorted(r.transaction_amount for r in seen)
    used = [r.transaction_date.hour for r in seen]
    return (len(seen), amounts[-(-9 * len(seen) // 10) - 1], min(used), max(used),
            round(float(sum(amounts)) / len(amounts), 4))


@pytest.mark.parametrize("heavy,hours", [((), 1), (("U1",), 24), (("U1", "U3"), 5)])
def test_baseline_equals_plain(made, heavy, hours):
    found = prior_baseline(made, 10, heavy=heavy, hours=hours)
    held = made.collect()
    got = {r.transaction_id: (r.transaction_count_30d, r.p90_amount_30d, r.earliest_active_hour, r.latest_active_hour,
                              None if r.avg_amount_30d is None else round(float(r.avg_amount_30d), 4))
           for r in found.collect()}
    assert got == {r.transaction_id: plain_baseline(held, r, 10) for r in held}


@pytest.mark.parametrize("heavy,hours", [((), 1), (("M1",), 24)])
def test_merchant_rate_waits_for_labels(made, heavy, hours):
    got = {r.transaction_id: r.merchant_risk_rate
           for r in prior_merchant_rate(made, 12, 3, heavy=heavy, hours=hours).collect()}
    held = made.collect()
    for row in held:
        until = row.transaction_date - timedelta(days=3)
        known = [r.is_fraud_label for r in held if r.merchant_id == row.merchant_id
                 and until - timedelta(days=12) <= r.transaction_date < until]
        assert got[row.transaction_id] == (pytest.approx(sum(known) / len(known)) if known else None)


def test_later_rows_and_fresh_labels_change_nothing(spark):
    """The same rows come out when everything after a day is missing and its week's labels are turned."""
    fact, versions = layers.fact(spark, FOLDER), layers.country_versions(spark, FOLDER)
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    past = fact.filter(F.col("transaction_date") < cut)
    turned = past.withColumn("is_fraud_label", F.when(
        F.col("transaction_date") >= F.lit("2024-01-13").cast("timestamp_ntz"), ~F.col("is_fraud_label"))
        .otherwise(F.col("is_fraud_label")))
    whole = features_point_in_time(fact, versions).filter(F.col("transaction_date") < cut).drop("is_fraud_label")
    assert rows_of(features_point_in_time(turned, versions).drop("is_fraud_label")) == rows_of(whole)


def test_heavy_keys_change_nothing(spark):
    fact, versions = layers.fact(spark, FOLDER), layers.country_versions(spark, FOLDER)
    users = [r[0] for r in fact.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(2).collect()]
    merchants = [r[0] for r in fact.groupBy("merchant_id").count().orderBy(F.desc("count"), "merchant_id").limit(1).collect()]
    sliced = features_point_in_time(fact, versions, heavy_users=users, heavy_merchants=merchants, hours=24)
    assert rows_of(sliced) == rows_of(features_point_in_time(fact, versions))


def test_nulls_and_empty_tables(spark, made):
    holes = spark.createDataFrame(
        [("a", None, START, 5), ("b", "U", START, None), ("c", "U", START + timedelta(hours=1), -3),
         ("d", "U", START + timedelta(hours=2), 9), ("e", "U", START + timedelta(hours=3), 9)],
        "id string, user string, ts timestamp_ntz, value long")
    found = sliding_quantile(holes, "user", "ts", "id", "value", timedelta(days=1))
    assert rows_of(found, "id", "quantile") == [("d", -3), ("e", 9)]
    assert sliding_quantile(holes.limit(0), "user", "ts", "id", "value", timedelta(days=1)).count() == 0
    assert prior_baseline(made.limit(0)).count() == 0
    assert prior_merchant_rate(made.limit(0)).count() == 0
