"""Latest attributes and lifetime dimensions of users and devices."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, functions as F

from txnrisk.operators.clean import latest_per_key
from txnrisk.operators.state import affected, history_of, new_rows, upsert

USER_CHECK = ["billing_country", "preferred_payment_method"]
DEVICE_CHECK = ["device_type", "primary_user_id"]


def users_latest(fact: DataFrame) -> DataFrame:
    """Country and payment method of each user's latest transaction."""
    rows = fact.select("user_id", "billing_country", F.col("payment_method").alias("preferred_payment_method"),
                       "transaction_date", "transaction_id")
    return latest_per_key(rows, ["user_id"], ["transaction_date", "transaction_id"]).drop("transaction_id")


def devices_latest(fact: DataFrame) -> DataFrame:
    """Type and user of each device's latest transaction."""
    rows = fact.select("device_id", "device_type", F.col("user_id").alias("primary_user_id"),
                       "transaction_date", "transaction_id")
    return latest_per_key(rows, ["device_id"], ["transaction_date", "transaction_id"]).drop("transaction_id")


def user_lifetime(transactions: DataFrame) -> DataFrame:
    """One row per user over its whole history, from a single aggregation."""
    seen = F.struct("transaction_date", "transaction_id")
    last = F.max(F.struct(seen.alias("seen"), "billing_country", "payment_method"))
    return (transactions.groupBy("user_id")
            .agg(F.min("transaction_date").alias("first_seen_at"),
                 F.max("transaction_date").alias("last_seen_at"),
                 F.count("*").alias("lifetime_transaction_count"),
                 last.alias("_last"))
            .select("user_id", "first_seen_at", "last_seen_at", "lifetime_transaction_count",
                    "_last.billing_country", F.col("_last.payment_method").alias("preferred_payment_method")))


def device_lifetime(transactions: DataFrame) -> DataFrame:
    """One row per device: first and latest user, life span, volume, users.

    Grouping by (device, user) first means the distinct user count needs no
    second copy of the rows and a busy device is pre-aggregated per user.
    """
    seen = F.struct("transaction_date", "transaction_id")
    per_user = (transactions.groupBy("device_id", "user_id")
                .agg(F.min(F.struct(seen.alias("seen"), "device_type", "user_id")).alias("_first"),
                     F.max(F.struct(seen.alias("seen"), "device_type", "user_id")).alias("_last"),
                     F.count("*").alias("_n")))
    return (per_user.groupBy("device_id")
            .agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"),
                 F.sum("_n").alias("lifetime_transaction_count"),
                 F.count("user_id").alias("distinct_user_count"))
            .select("device_id", F.col("_first.device_type").alias("device_type"),
                    F.col("_first.user_id").alias("first_user_id"),
                    F.col("_last.user_id").alias("latest_user_id"),
                    F.col("_first.seen.transaction_date").alias("first_seen_at"),
                    F.col("_last.seen.transaction_date").alias("last_seen_at"),
                    "lifetime_transaction_count", "distinct_user_count"))


def refresh_lifetime(held: DataFrame, transactions: DataFrame, key: str, lifetime: Callable[[DataFrame], DataFrame],
                     heavy: Sequence = ()) -> DataFrame:
    """``held`` with the keys that have rows after its latest ``last_seen_at``
    recomputed over their whole history."""
    fresh = new_rows(transactions, "transaction_date", held, "last_seen_at")
    return upsert(held, lifetime(history_of(transactions, affected(fresh, key), key, heavy)), [key])


def device_risk(transactions: DataFrame, as_of: str) -> DataFrame:
    """Users, volume, fraud rate and age in days of each device."""
    per_user = (transactions.groupBy("device_id", "user_id")
                .agg(F.count("*").alias("_n"), F.count_if("is_fraud_label").alias("_fraud"),
                     F.min("transaction_date").alias("_first")))
    return (per_user.groupBy("device_id")
            .agg(F.count("user_id").alias("distinct_users"),
                 F.sum("_n").alias("transactions"),
                 (F.sum("_fraud") / F.sum("_n")).cast("double").alias("fraud_rate"),
                 F.date_diff(F.to_date(F.lit(as_of)), F.to_date(F.min("_first"))).alias("age_days")))
