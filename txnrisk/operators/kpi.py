"""Dashboard measures over scored transactions.

The scored frame is the score table together with the fact columns a measure
needs: features built with ``keep=`` have them already, :func:`enrich` joins
them back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.operators.drift import score_bucket
from txnrisk.operators.evaluation import FLAG_TIERS, flagged
from txnrisk.operators.skew import join_salted
from txnrisk.schemas import PAYMENT_METHODS


def enrich(scores: DataFrame, fact: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Fact columns joined to the score table on its key."""
    return scores.join(fact.select("transaction_id", *columns), "transaction_id")


def _amount_where(condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, F.col("transaction_amount"))), F.lit(0)).cast("decimal(22,2)")


def _fraud_rate() -> Column:
    return (F.count_if("is_fraud_label") / F.count("*")).cast("double")


def daily_kpi(scored: DataFrame, since: Column | None = None, updated_at: Column | None = None) -> DataFrame:
    """Daily totals, tier counts and mean probability.

    ``since`` recomputes the days from that date on, each in full.
    """
    day = F.to_date("transaction_date")
    rows = scored if since is None else scored.filter(F.col("transaction_date") >= since)
    if since is not None and "event_date" in scored.columns:  # prunes the partitions
        rows = rows.filter(F.col("event_date") >= since)
    kpi = rows.groupBy(day.alias("date_key")).agg(
        F.count("*").alias("total_transactions"),
        F.count_if(F.col("risk_tier") == "High").alias("flagged_high"),
        F.count_if(F.col("risk_tier") == "Medium").alias("flagged_medium"),
        F.count_if(F.col("risk_tier") == "Low").alias("flagged_low"),
        F.avg("fraud_probability").alias("avg_fraud_probability"))
    return kpi if updated_at is None else kpi.withColumn("last_updated_at", updated_at)


def exec_overview(scored: DataFrame, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    flag = flagged(tiers)
    return scored.agg(
        F.count("*").alias("total_transactions"),
        F.count_if(flag).alias("flagged_transactions"),
        F.try_divide(F.count_if(flag), F.count("*")).cast("double").alias("flagged_share"),
        F.try_divide(F.count_if("is_fraud_label"), F.count("*")).cast("double").alias("fraud_rate"),
        _amount_where(flag).alias("amount_at_risk"),
        F.try_divide(F.count_if(flag & F.col("is_fraud_label")), F.count_if(flag)).cast("double")
        .alias("model_precision"))


def flagged_trend(scored: DataFrame, days: int = 7, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    """Daily volume and flagged count, change on the day before, moving mean."""
    daily = scored.groupBy(F.to_date("transaction_date").alias("date_key")).agg(
        F.count("*").alias("transactions"), F.count_if(flagged(tiers)).alias("flagged"))
    by_day = Window.orderBy("date_key")
    return daily.withColumns({
        "flagged_change": F.col("flagged") - F.lag("flagged").over(by_day),
        "flagged_moving_avg": F.avg("flagged").over(by_day.rowsBetween(1 - days, 0)),
    })


def tier_distribution(scored: DataFrame) -> DataFrame:
    tiers = scored.groupBy("risk_tier").agg(F.count("*").alias("transactions"))
    return tiers.withColumn(
        "share", (F.col("transactions") / F.sum("transactions").over(Window.partitionBy())).cast("double"))


def fraud_by(scored: DataFrame, dimension: Column, name: str, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    """Volume, fraud and flagged measures per value of one dimension."""
    return scored.groupBy(dimension.alias(name)).agg(
        F.count("*").alias("transactions"),
        F.count_if("is_fraud_label").alias("fraud"),
        _fraud_rate().alias("fraud_rate"),
        F.count_if(flagged(tiers)).alias("flagged"),
        _amount_where(flagged(tiers)).alias("flagged_amount"))


def kpi_grouping_sets(scored: DataFrame, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    """The measures by payment method, device type and country, and overall,
    from one pass over the rows."""
    dims = ["payment_method", "device_type", "billing_country"]
    return scored.groupingSets([[d] for d in map(F.col, dims)] + [[]], *map(F.col, dims)).agg(
        F.count("*").alias("transactions"),
        F.count_if("is_fraud_label").alias("fraud"),
        F.count_if(flagged(tiers)).alias("flagged"),
        _amount_where(flagged(tiers)).alias("flagged_amount"))


def score_histogram(scored: DataFrame, buckets: int = 10) -> DataFrame:
    return scored.groupBy(score_bucket(buckets).alias("bucket")).agg(
        F.count("*").alias("transactions"), F.count_if("is_fraud_label").alias("fraud"))


def tier_by_method(scored: DataFrame) -> DataFrame:
    """Transactions per tier (rows) and payment method (columns)."""
    return (scored.groupBy("risk_tier").pivot("payment_method", PAYMENT_METHODS).agg(F.count(F.lit(1)))
            .na.fill(0, PAYMENT_METHODS)
            .select("risk_tier", *[F.col(m).alias(m.lower()) for m in PAYMENT_METHODS]))


def top_flagged_users(scored: DataFrame, k: int = 20, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    flag = flagged(tiers)
    return (scored.groupBy("user_id").agg(
        F.count_if(flag).alias("flagged"), _amount_where(flag).alias("flagged_amount"),
        F.count("*").alias("transactions"))
        .orderBy(F.desc("flagged"), F.desc("flagged_amount"), "user_id").limit(k))


def top_risky_merchants(risk: DataFrame, k: int = 20) -> DataFrame:
    return risk.orderBy(F.desc("fraud_rate_90d"), F.desc("transaction_count_90d"), "merchant_id").limit(k)


def user_drillthrough(scored: DataFrame, baseline: DataFrame, *, users: Sequence[str] | None = None,
                      heavy_users: Sequence = ()) -> DataFrame:
    """Each transaction beside its user's baseline, for all users or some."""
    rows = scored if users is None else scored.filter(F.col("user_id").isin(list(users)))
    joined = join_salted(rows, baseline, "user_id", "transaction_id", heavy=heavy_users)
    average = F.nullif(F.col("avg_amount_30d").cast("double"), F.lit(0.0))
    return joined.withColumn("amount_vs_avg", F.col("transaction_amount").cast("double") / average)


def user_behaviour_change(fact: DataFrame, as_of: str, recent_days: int = 7, baseline_days: int = 30) -> DataFrame:
    """The ``recent_days`` days before ``as_of`` of each user against the days before them, in one pass."""
    until = F.to_date(F.lit(as_of))
    recent_from, since = F.date_sub(until, recent_days), F.date_sub(until, baseline_days)
    recent = F.col("transaction_date") >= recent_from
    amount = F.col("transaction_amount")
    rows = fact.filter((F.col("transaction_date") >= since) & (F.col("transaction_date") < until))
    if "event_date" in fact.columns:  # prunes the partitions
        rows = rows.filter((F.col("event_date") >= since) & (F.col("event_date") < until))
    measures = rows.groupBy("user_id").agg(
        F.count_if(recent).alias("recent_count"),
        F.count_if(~recent).alias("baseline_count"),
        F.avg(F.when(recent, amount)).cast("double").alias("recent_avg"),
        F.avg(F.when(~recent, amount)).cast("double").alias("baseline_avg"))
    per_day = F.col("recent_count") / F.lit(float(recent_days))
    baseline_per_day = F.col("baseline_count") / F.lit(float(baseline_days - recent_days))
    return measures.withColumns({
        "amount_ratio": F.try_divide(F.col("recent_avg"), F.col("baseline_avg")),
        "volume_ratio": F.try_divide(per_day, baseline_per_day),
    })
