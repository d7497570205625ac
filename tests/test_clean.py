import datetime as dt
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException

from tests.helpers import raw_rows, rows_of
from txnrisk.operators.clean import batch_summary, clean, latest_per_key, quarantine


def test_amounts_are_tested_after_rounding(spark):
    raw = raw_rows(spark, [dict(TransactionID=f"T{i}", TransactionAmount=a) for i, a in enumerate(
        [None, "-1", "0", "0.004", "0.005", "9999999999.99"])])
    assert rows_of(clean(raw), "transaction_amount") == [(Decimal("0.01"),), (Decimal("9999999999.99"),)]


def test_malformed_values_raise_or_go_to_quarantine(spark):
    raw = raw_rows(spark, [
        dict(TransactionID="T1", TransactionAmount="abc"), dict(TransactionID="T2", TransactionDate="yesterday"),
        dict(TransactionID="T3", LocationLat="north"), dict(TransactionID="T4"), dict(TransactionID=None),
        dict(TransactionID="T5", TransactionAmount="-3"), dict(TransactionID="T6", TransactionAmount=None)])
    with pytest.raises(PySparkException):
        clean(raw).collect()
    assert rows_of(clean(raw, on_bad="quarantine"), "transaction_id") == [("T4",)]
    assert rows_of(quarantine(raw), "TransactionID", "reason") == sorted([
        ("T1", "malformed value"), ("T2", "malformed value"), ("T3", "malformed value"), (None, "missing id"),
        ("T5", "amount not positive"), ("T6", "missing amount")], key=repr)


def test_bad_option(spark):
    with pytest.raises(ValueError):
        clean(raw_rows(spark, []), on_bad="ignore")


def test_ties_fall_to_the_larger_amount(spark):
    raw = raw_rows(spark, [dict(TransactionAmount=a) for a in ("5", "7", "6")])
    assert rows_of(clean(raw), "transaction_amount") == [(Decimal("7.00"),)]


def test_a_later_refund_removes_the_transaction(spark):
    raw = raw_rows(spark, [dict(), dict(TransactionAmount="-10", TransactionDate="2024-01-01T00:00:01+00:00")])
    assert clean(raw).count() == 0


def test_dates_order_as_instants_not_text(spark):
    raw = raw_rows(spark, [
        dict(TransactionDate="2024-01-01T10:00:00+00:00", TransactionAmount="1"),
        dict(TransactionDate="2024-01-01T12:00:00+05:30", TransactionAmount="2")])
    assert rows_of(clean(raw), "transaction_amount", "transaction_date") == [
        (Decimal("1.00"), dt.datetime(2024, 1, 1, 10))]


def test_text_is_trimmed_and_upper_cased(spark):
    raw = raw_rows(spark, [dict(PaymentMethod=" Debit_Card ", DeviceType="mobile ", IsFraud="True")])
    assert rows_of(clean(raw), "payment_method", "device_type", "is_fraud_label") == [("DEBIT_CARD", "MOBILE", True)]


def test_batch_summary(spark):
    raw = raw_rows(spark, [dict(IsFraud="True"), dict(), dict(), dict()])
    assert rows_of(batch_summary(raw), "transactions", "fraud_transactions", "fraud_share") == [(4, 1, 0.25)]
    assert rows_of(batch_summary(raw.limit(0)), "transactions", "fraud_share") == [(0, None)]


def test_first_and_latest_per_key(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, n int")
    assert rows_of(latest_per_key(rows, ["k"], ["n"])) == [("a", 2), ("b", 3)]
    assert rows_of(latest_per_key(rows, ["k"], ["n"], first=True)) == [("a", 1), ("b", 3)]
