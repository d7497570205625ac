from decimal import Decimal

from pyspark.sql import functions as F

from tests.helpers import rows_of, transactions
from txnrisk.functions.geo import haversine_km
from txnrisk.operators.baselines import merchant_risk, user_baseline, user_baseline_point_in_time
from txnrisk.operators.behaviour import behaviour_windows, user_frequency
from txnrisk.operators.dims import device_lifetime, device_risk, user_lifetime
from txnrisk.operators.features import build_features
from txnrisk.operators.scd2 import scd2_from_events


def featured(fact, as_of="2024-01-10", **options):
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country"], "transaction_id")
    return build_features(fact, versions, user_baseline(fact, as_of), merchant_risk(fact, as_of), **options)


def test_one_transaction_has_no_zscore(spark):
    rows = featured(transactions(spark, [dict()]))
    assert rows_of(rows, "amount_zscore", "device_amount_percentile") == [(None, Decimal("1.000000000000000"))]


def test_constant_amounts_do_not_divide_by_zero(spark):
    rows = featured(transactions(spark, [dict(transaction_date=f"2024-01-01 0{i}:00:00") for i in range(3)]))
    assert {r.amount_zscore for r in rows.collect()} == {None}


def test_antipodal_points_have_a_distance(spark):
    points = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (10.0, 20.0, -10.0, -160.0), (89.9999, 0.0, -89.9999, 180.0)],
                                   "a double, b double, c double, d double")
    distances = [r[0] for r in points.select(haversine_km(*map(F.col, "abcd"))).collect()]
    assert all(20000 < d < 20016 for d in distances)


def test_same_second_counts_as_one_second(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00.100000"),
        dict(transaction_date="2024-01-01 00:00:00.900000", location_lat=0.1)])
    assert rows_of(featured(fact), "transaction_id", "impossible_travel_flag") == [("T0", 0), ("T1", 1)]


def test_missing_coordinates_are_no_travel(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00", location_lat=None),
        dict(transaction_date="2024-01-01 00:00:01", location_lat=50.0),
        dict(transaction_date="2024-01-01 00:00:02", location_lat=None),
        dict(transaction_date="2024-01-01 00:00:03", location_lat=-50.0)])
    assert {r.impossible_travel_flag for r in featured(fact).collect()} == {0}


def test_velocity_frame_includes_its_edge(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00"), dict(transaction_date="2024-01-01 01:00:00"),
        dict(transaction_date="2024-01-01 02:00:00.000001")])
    assert rows_of(featured(fact), "transaction_id", "velocity_1hr") == [("T0", 0), ("T1", 1), ("T2", 0)]


def test_velocity_counts_rows_of_the_same_instant(spark):
    fact = transactions(spark, [dict(), dict(), dict(user_id="U2")])
    assert rows_of(featured(fact), "transaction_id", "velocity_1hr") == [("T0", 1), ("T1", 1), ("T2", 0)]


def test_new_device_flags_every_row_of_the_first_instant(spark):
    fact = transactions(spark, [dict(), dict(), dict(transaction_date="2024-01-02 00:00:00"),
                                dict(transaction_date="2024-01-03 00:00:00", device_id="D2")])
    assert rows_of(featured(fact), "transaction_id", "new_device_flag") == [("T0", 1), ("T1", 1), ("T2", 0), ("T3", 1)]


def test_off_hours_and_baseline_window(spark):
    fact = transactions(spark, [
        dict(transaction_date="2023-11-01 23:00:00"), dict(transaction_date="2024-01-05 09:00:00"),
        dict(transaction_date="2024-01-06 17:00:00")])
    # The first row lies outside the 30 days, so hour 23 is no usual hour.
    assert rows_of(featured(fact), "transaction_id", "off_hours_flag") == [("T0", 1), ("T1", 0), ("T2", 0)]


def test_user_without_baseline_gets_nulls_and_zero_flags(spark):
    fact = transactions(spark, [dict(transaction_date="2023-01-01 00:00:00")])
    assert rows_of(featured(fact), "amount_zscore", "device_amount_percentile", "off_hours_flag", "merchant_risk_rate") == [
        (None, None, 0, None)]


def test_window_start_is_inclusive(spark):
    fact = transactions(spark, [dict(transaction_date="2023-12-11 00:00:00"), dict(transaction_date="2023-12-10 23:59:59")])
    assert rows_of(user_baseline(fact, "2024-01-10"), "transaction_count_30d") == [(1,)]


def test_location_mismatch_uses_the_country_of_the_time(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00", billing_country="IN", ip_country="IN"),
        dict(transaction_date="2024-01-05 00:00:00", billing_country="US", ip_country="IN"),
        dict(transaction_date="2024-01-06 00:00:00", billing_country="US", ip_country=None)])
    assert rows_of(featured(fact), "transaction_id", "location_mismatch_flag") == [("T0", 0), ("T1", 1), ("T2", 0)]


def test_only_new_rows_with_history_as_context(spark):
    fact = transactions(spark, [dict(), dict(transaction_date="2024-01-01 00:30:00")])
    new = fact.filter(F.col("transaction_id") == "T1")
    assert rows_of(featured(fact, new_ids=new), "transaction_id", "velocity_1hr", "new_device_flag") == [("T1", 1, 0)]


def test_merchant_risk(spark):
    fact = transactions(spark, [dict(is_fraud_label=True, transaction_amount=1), dict(transaction_amount=2),
                                dict(user_id="U2", transaction_amount=4), dict(user_id=None, transaction_amount=5)])
    assert rows_of(merchant_risk(fact, "2024-01-10"), "transaction_count_90d", "fraud_count_90d", "fraud_rate_90d",
                   "avg_transaction_amount_90d", "distinct_customer_count_90d") == [(4, 1, 0.25, Decimal("3.000000"), 2)]


def test_frequency_edges(spark):
    fact = transactions(spark, [dict(transaction_date=d) for d in (
        "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-08 00:00:00", "2024-01-08 00:00:00.000001")])
    assert rows_of(user_frequency(fact), "transaction_id", "transactions_24h", "transactions_7d") == [
        ("T0", 1, 1), ("T1", 2, 2), ("T2", 1, 3), ("T3", 2, 3)]


def test_point_in_time_baseline_leaves_out_the_present(spark):
    fact = transactions(spark, [
        dict(transaction_amount=10), dict(transaction_amount=30),
        dict(transaction_date="2024-01-02 00:00:00", transaction_amount=1000)])
    prior = user_baseline_point_in_time(fact)
    assert rows_of(prior, "transaction_id", "prior_count", "prior_avg_amount") == [
        ("T0", 0, None), ("T1", 0, None), ("T2", 2, 20.0)]
    assert abs(prior.filter("transaction_id = 'T2'").first().prior_stddev_amount - 200 ** 0.5) < 1e-9


def test_velocity_and_window_on_empty_input(spark):
    fact = transactions(spark, [])
    assert behaviour_windows(fact).count() == 0
    assert featured(fact).count() == 0


def test_lifetime_dimensions(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00", payment_method="UPI"),
        dict(transaction_date="2024-01-03 00:00:00", user_id="U2", device_type="TABLET", is_fraud_label=True),
        dict(transaction_date="2024-01-02 00:00:00", payment_method="CREDIT_CARD", billing_country="C2")])
    assert rows_of(user_lifetime(fact), "user_id", "lifetime_transaction_count", "billing_country",
                   "preferred_payment_method") == [("U1", 2, "C2", "CREDIT_CARD"), ("U2", 1, "C1", "UPI")]
    assert rows_of(device_lifetime(fact), "device_type", "first_user_id", "latest_user_id",
                   "lifetime_transaction_count", "distinct_user_count") == [("MOBILE", "U1", "U2", 3, 2)]
    assert rows_of(device_risk(fact, "2024-01-11"), "distinct_users", "transactions", "age_days") == [(2, 3, 10)]
