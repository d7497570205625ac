"""Monitoring: input and prediction drift, fraud-rate drift, freshness."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.operators.evaluation import precision_recall


def psi(df: DataFrame, bucket: Column, is_current: Column, epsilon: float = 1e-4) -> DataFrame:
    """Population stability index between the reference rows and the current.

    Returns one row per bucket with its share in each period and its term;
    the index is the sum of the terms. Empty buckets count as ``epsilon``.
    """
    counts = df.groupBy(bucket.alias("bucket")).agg(
        F.count_if(~is_current).alias("reference_rows"), F.count_if(is_current).alias("current_rows"))
    # One row per bucket from here on, so a window over all of it is bounded.
    everything = Window.partitionBy()
    expected = F.greatest(F.try_divide(F.col("reference_rows"), F.sum("reference_rows").over(everything)), F.lit(epsilon))
    actual = F.greatest(F.try_divide(F.col("current_rows"), F.sum("current_rows").over(everything)), F.lit(epsilon))
    return counts.select(
        "bucket", "reference_rows", "current_rows",
        ((actual - expected) * F.ln(actual / expected)).alias("psi_term"))


def feature_bucket(feature: str, steps: float = 1.0, low: float | None = None, high: float | None = None) -> Column:
    """Bucket of a feature: its floor in units of 1 / ``steps`` between bounds; null is a bucket of its own."""
    value = F.floor(F.round(F.col(feature).cast("double"), 6) * steps)
    value = value if low is None else F.greatest(value, F.lit(low * steps).cast("long"))
    value = value if high is None else F.least(value, F.lit(high * steps).cast("long"))
    return F.coalesce(value, F.lit(-1000)).cast("int")


def psi_by_feature(df: DataFrame, buckets: Mapping[str, Column], is_current: Column, epsilon: float = 1e-4) -> DataFrame:
    """The index of every feature: rows per feature and bucket in one pass, then the sum of its terms."""
    pairs = F.array(*[F.struct(F.lit(name).alias("feature"), bucket.alias("bucket")) for name, bucket in buckets.items()])
    counts = (df.select(is_current.alias("_current"), F.inline(pairs)).groupBy("feature", "bucket").agg(
        F.count_if(~F.col("_current")).alias("reference_rows"), F.count_if("_current").alias("current_rows")))
    own = Window.partitionBy("feature")
    expected = F.greatest(F.try_divide(F.col("reference_rows"), F.sum("reference_rows").over(own)), F.lit(epsilon))
    actual = F.greatest(F.try_divide(F.col("current_rows"), F.sum("current_rows").over(own)), F.lit(epsilon))
    terms = counts.select("feature", "current_rows", ((actual - expected) * F.ln(actual / expected)).alias("term"))
    return terms.groupBy("feature").agg(F.count("*").alias("buckets"), F.sum("current_rows").alias("current_rows"),
                                        F.sum("term").alias("psi"))


def score_bucket(buckets: int = 10) -> Column:
    """Equal-width bucket of the probability; 1.0 falls into the last one."""
    return F.least(F.floor(F.col("fraud_probability") * buckets), F.lit(buckets - 1)).cast("int")


def fraud_rate_drift(df: DataFrame, days: int = 7) -> DataFrame:
    """Daily fraud rate against the pooled rate of the ``days`` rows before it."""
    daily = df.groupBy(F.to_date("transaction_date").alias("date_key")).agg(
        F.count("*").alias("transactions"), F.count_if("is_fraud_label").alias("fraud"))
    before = Window.orderBy("date_key").rowsBetween(-days, -1)
    rate = (F.col("fraud") / F.col("transactions")).cast("double")
    prior = F.try_divide(F.sum("fraud").over(before), F.sum("transactions").over(before)).cast("double")
    return daily.select("date_key", "transactions", "fraud", rate.alias("fraud_rate"), prior.alias("prior_rate"),
                        (rate - prior).alias("rate_change"))


def quality_decay(scored: DataFrame) -> DataFrame:
    """Precision and recall per calendar week."""
    return precision_recall(scored, [F.to_date(F.date_trunc("week", "transaction_date")).alias("week_start")])


def freshness(df: DataFrame, by: str, as_of: Column) -> DataFrame:
    """Latest event and its age in hours per value of ``by``."""
    return (df.groupBy(by).agg(F.max("transaction_date").alias("latest_at"), F.count("*").alias("transactions"))
            .withColumn("age_hours", (F.unix_timestamp(as_of) - F.unix_timestamp("latest_at")) / F.lit(3600.0)))
