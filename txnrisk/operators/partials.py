"""Day partials: what the rolling measures need of one day, kept so that a window is a sum over its days.

A table of partials is partitioned by day like the fact. A run puts the partials
of the days it touched in place of the old ones, so repeating it changes
nothing, and a refresh reads partials instead of the fact. They hold rows, not
lists: one user or merchant with a third of all rows is spread over amounts and
customers until the last, short sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.functions.timing import trailing_window_start
from txnrisk.operators.baselines import MERCHANT_WINDOW_DAYS, USER_WINDOW_DAYS, per_merchant, restrict


def user_days(fact: DataFrame) -> DataFrame:
    """One row per user, day and amount: how often, and in which hours as bits.

    The amounts with their counts are the exact histogram the percentile needs;
    count, sum and sum of squares follow from them without rounding.
    """
    return (fact.groupBy("user_id", "event_date", "transaction_amount")
            .agg(F.count("*").alias("transactions"),
                 F.bit_or(F.expr("shiftleft(1, hour(transaction_date))")).alias("hours")))


def merchant_days(fact: DataFrame) -> DataFrame:
    """One row per merchant, day and customer; a day's customers are a set that others can be joined to."""
    return (fact.groupBy("merchant_id", "event_date", "user_id")
            .agg(F.count("*").alias("transactions"), F.count_if("is_fraud_label").alias("frauds"),
                 F.sum("transaction_amount").alias("amount")))


def _within(partials: DataFrame, as_of: str, days: int) -> DataFrame:
    return partials.filter(F.col("event_date") >= trailing_window_start(as_of, days))


def baseline_from_partials(partials: DataFrame, as_of: str, days: int = USER_WINDOW_DAYS,
                           users: DataFrame | None = None, updated_at: Column | None = None) -> DataFrame:
    """What ``user_baseline`` gives, from ``user_days`` alone.

    The percentile is the smallest amount that nine tenths of the rows do not
    exceed, exact at every size. The only task that sees all of a user reads
    one row per different amount.
    """
    amount = F.col("transaction_amount")
    values = (restrict(_within(partials, as_of, days), "user_id", users).groupBy("user_id", "transaction_amount")
              .agg(F.sum("transactions").alias("_rows"), F.bit_or("hours").alias("_hours"))
              .withColumn("_n", F.when(amount.isNotNull(), F.col("_rows"))))
    of_user = Window.partitionBy("user_id")
    placed = values.withColumns({"_upto": F.sum("_n").over(of_user.orderBy("transaction_amount")),
                                 "_all": F.sum("_n").over(of_user)})
    times = F.col("_n").cast("decimal(12,0)")
    square = (amount * amount).cast("decimal(24,4)")
    sums = placed.groupBy("user_id").agg(
        F.sum("_n").alias("_n"), F.sum(amount * times).cast("decimal(22,2)").alias("_total"),
        F.sum(square * times).cast("decimal(32,4)").alias("_squares"),
        F.min(F.when(F.col("_upto") * 10 >= F.col("_all") * 9, amount)).alias("p90_amount_30d"),
        F.bin(F.bit_or("_hours")).alias("_hours"), F.sum("_rows").alias("transaction_count_30d"))
    n, total = F.col("_n"), F.col("_total")
    spread = (n.cast("decimal(12,0)") * F.col("_squares") - total * total).cast("double")
    baseline = sums.select(
        "user_id", (total / n).cast("decimal(16,6)").alias("avg_amount_30d"),
        F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double"))).alias("stddev_amount_30d"), "p90_amount_30d",
        (F.locate("1", F.reverse("_hours")) - 1).alias("earliest_active_hour"),
        (F.length("_hours") - 1).alias("latest_active_hour"), "transaction_count_30d")
    return baseline if updated_at is None else baseline.withColumn("last_updated_at", updated_at)


def merchant_risk_from_partials(partials: DataFrame, as_of: str, days: int = MERCHANT_WINDOW_DAYS,
                                merchants: DataFrame | None = None, updated_at: Column | None = None) -> DataFrame:
    """What ``merchant_risk`` gives, from ``merchant_days`` alone."""
    per_customer = (restrict(_within(partials, as_of, days), "merchant_id", merchants)
                    .groupBy("merchant_id", "user_id")
                    .agg(F.sum("transactions").alias("_n"), F.sum("frauds").alias("_fraud"),
                         F.sum("amount").alias("_amount")))
    risk = per_merchant(per_customer)
    return risk if updated_at is None else risk.withColumn("last_updated_at", updated_at)
