"""Rolling reference measures: user spending baseline and merchant risk."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from txnrisk.functions.timing import trailing_window_start
from txnrisk.operators.skew import trailing_totals

# The windows the measures are named after.
USER_WINDOW_DAYS = 30
MERCHANT_WINDOW_DAYS = 90


def _window(fact: DataFrame, as_of: str, days: int) -> DataFrame:
    start = trailing_window_start(as_of, days)
    rows = fact.filter(F.col("transaction_date") >= start)
    # On a table partitioned by day this also prunes the partitions.
    return rows.filter(F.col("event_date") >= start) if "event_date" in fact.columns else rows


def restrict(fact: DataFrame, key: str, keys: DataFrame | None) -> DataFrame:
    return fact if keys is None else fact.join(keys.select(key).distinct(), key, "left_semi")


def user_baseline(fact: DataFrame, as_of: str, days: int = USER_WINDOW_DAYS, users: DataFrame | None = None,
                  updated_at: Column | None = None) -> DataFrame:
    """Spending baseline per user over the ``days`` before ``as_of``.

    ``users`` limits it to those keys (over their full window), which is how a
    refresh recomputes only users with new activity. All measures merge
    partially before the shuffle.
    """
    amount, hour = F.col("transaction_amount"), F.hour("transaction_date")
    baseline = (restrict(_window(fact, as_of, days), "user_id", users)
                .groupBy("user_id")
                .agg(F.avg(amount).alias("avg_amount_30d"),
                     F.stddev_samp(amount).alias("stddev_amount_30d"),
                     F.percentile_approx(amount, 0.9, 10000).alias("p90_amount_30d"),
                     F.min(hour).alias("earliest_active_hour"),
                     F.max(hour).alias("latest_active_hour"),
                     F.count("*").alias("transaction_count_30d")))
    return baseline if updated_at is None else baseline.withColumn("last_updated_at", updated_at)


def per_merchant(per_customer: DataFrame) -> DataFrame:
    """Risk per merchant from its rows per customer (``_n``, ``_fraud``, ``_amount``)."""
    return (per_customer.groupBy("merchant_id")
            .agg(F.sum("_n").alias("transaction_count_90d"),
                 F.sum("_fraud").alias("fraud_count_90d"),
                 (F.sum("_fraud") / F.sum("_n")).cast("double").alias("fraud_rate_90d"),
                 (F.sum("_amount") / F.sum("_n")).cast("decimal(16,6)").alias("avg_transaction_amount_90d"),
                 F.count("user_id").alias("distinct_customer_count_90d")))


def merchant_risk(fact: DataFrame, as_of: str, days: int = MERCHANT_WINDOW_DAYS, merchants: DataFrame | None = None,
                  updated_at: Column | None = None, approximate_customers: bool = False) -> DataFrame:
    """Fraud rate, volume and customers per merchant over ``days``.

    Rows are first reduced to one per (merchant, user), so a merchant with a
    third of all rows is split over its customers before it is put together.
    ``approximate_customers`` counts them with a sketch instead, which spares
    the shuffle by (merchant, user).
    """
    fraud = F.count_if("is_fraud_label")
    if approximate_customers:
        risk = (restrict(_window(fact, as_of, days), "merchant_id", merchants).groupBy("merchant_id")
                .agg(F.count("*").alias("transaction_count_90d"), fraud.alias("fraud_count_90d"),
                     (fraud / F.count("*")).cast("double").alias("fraud_rate_90d"),
                     F.avg("transaction_amount").alias("avg_transaction_amount_90d"),
                     F.approx_count_distinct("user_id").alias("distinct_customer_count_90d")))
        return risk if updated_at is None else risk.withColumn("last_updated_at", updated_at)
    per_customer = (restrict(_window(fact, as_of, days), "merchant_id", merchants)
                    .groupBy("merchant_id", "user_id")
                    .agg(F.count("*").alias("_n"), fraud.alias("_fraud"),
                         F.sum("transaction_amount").alias("_amount")))
    risk = per_merchant(per_customer)
    return risk if updated_at is None else risk.withColumn("last_updated_at", updated_at)


def user_baseline_point_in_time(fact: DataFrame, days: int = USER_WINDOW_DAYS, *, heavy: Sequence = (),
                                hours: int = 1) -> DataFrame:
    """Baseline of the user as it stood just before each transaction.

    Uses only earlier rows, so a training set built on it does not see the
    row it scores. Sums are exact decimals; mean and deviation come from them.
    """
    amount = F.col("transaction_amount")
    measures = {"n": F.lit(1).cast("long"), "sum": amount, "squares": amount * amount}
    totals = trailing_totals(fact, "user_id", "transaction_date", {"prior": timedelta(days=days)}, measures,
                             include_current=False, heavy=heavy, hours=hours)
    n, total = F.col("n_prior"), F.col("sum_prior").cast("decimal(18,2)")
    squares = F.col("squares_prior").cast("decimal(32,4)")
    spread = (n.cast("decimal(12,0)") * squares - total * total).cast("double")
    return totals.select(
        *fact.columns,
        n.alias("prior_count"),
        F.when(n > 0, total.cast("double") / n).alias("prior_avg_amount"),
        F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double"))).alias("prior_stddev_amount"))
