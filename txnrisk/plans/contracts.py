"""The declared checks of every layer table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from txnrisk.operators.quality import (Check, accepted_range, accepted_values, expression, not_null, relationship, report,
                                        unique)
from txnrisk.schemas import DEVICE_TYPES, PAYMENT_METHODS, RISK_TIERS, SCD_ID, VALID_FROM, VALID_TO


def _present(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def _key(column: str) -> list[Check]:
    return [not_null(column), unique(column)]


def _versions(key: str) -> list[Check]:
    return [*_key(SCD_ID), *_present(key, VALID_FROM), expression(f"{VALID_TO} is null or {VALID_TO} > {VALID_FROM}")]


def contracts() -> dict[str, list[Check]]:
    # The bounds and domains consumers of the tables expect.
    return {
        "bronze_transactions": [
            *_key("transaction_id"),
            *_present("user_id", "merchant_id", "device_id", "transaction_amount", "transaction_date", "ip_country",
                      "billing_country"),
            accepted_values("payment_method", PAYMENT_METHODS), accepted_values("device_type", DEVICE_TYPES),
            accepted_values("is_fraud_label", [True, False]),
            accepted_range("location_lat", -90, 90), accepted_range("location_lon", -180, 180)],
        "fact": [*_key("transaction_id"), *_present("user_id", "device_id", "transaction_amount"),
                 relationship("user_id", "users_current", "user_id"),
                 relationship("device_id", "devices_current", "device_id")],
        "users_current": _key("user_id"),
        "devices_current": [*_key("device_id"), accepted_values("device_type", DEVICE_TYPES)],
        "users_versions": _versions("user_id"),
        "devices_versions": _versions("device_id"),
        "user_baseline": [
            *_key("user_id"), *_present("avg_amount_30d", "transaction_count_30d", "last_updated_at"),
            accepted_range("avg_amount_30d", 0), accepted_range("stddev_amount_30d", 0),
            accepted_range("p90_amount_30d", 0), accepted_range("earliest_active_hour", 0, 23),
            accepted_range("latest_active_hour", 0, 23), accepted_range("transaction_count_30d", 1),
            expression("earliest_active_hour <= latest_active_hour")],
        "merchant_risk": [
            *_key("merchant_id"),
            *_present("transaction_count_90d", "fraud_count_90d", "fraud_rate_90d", "distinct_customer_count_90d",
                      "last_updated_at"),
            accepted_range("transaction_count_90d", 1), accepted_range("fraud_count_90d", 0),
            accepted_range("fraud_rate_90d", 0, 1), accepted_range("avg_transaction_amount_90d", 0),
            accepted_range("distinct_customer_count_90d", 1),
            expression("fraud_count_90d <= transaction_count_90d")],
        "features": [
            *_key("transaction_id"), *_present("user_id", "velocity_1hr", "is_fraud_label"),
            accepted_range("velocity_1hr", 0),
            *[accepted_values(f, [0, 1]) for f in ("impossible_travel_flag", "new_device_flag", "off_hours_flag",
                                                  "location_mismatch_flag")],
            accepted_range("merchant_risk_rate", 0, 1), accepted_values("is_fraud_label", [True, False])],
        "scores": [
            *_key("transaction_id"), not_null("fraud_probability"), accepted_range("fraud_probability", 0, 1),
            accepted_values("risk_tier", RISK_TIERS)],
        "daily_kpi": [*_key("date_key"), not_null("total_transactions")],
    }


def contract_report(tables: Mapping[str, DataFrame], only: set[str] | None = None) -> DataFrame:
    declared = contracts()
    return report(tables, {name: declared[name] for name in declared if name in tables and (not only or name in only)})
