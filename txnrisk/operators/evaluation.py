"""Model quality for rare positives: confusion, precision, recall, PR-AUC."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from txnrisk.operators.state import write_table
from txnrisk.session import scratch

FLAG_TIERS = ("High",)


def flagged(tiers: Sequence[str] = FLAG_TIERS) -> Column:
    return F.coalesce(F.col("risk_tier").isin(list(tiers)), F.lit(False))


def confusion(scored: DataFrame, tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    flag, fraud = flagged(tiers), F.col("is_fraud_label")
    return scored.agg(
        F.count_if(flag & fraud).alias("true_positives"),
        F.count_if(flag & ~fraud).alias("false_positives"),
        F.count_if(~flag & fraud).alias("false_negatives"),
        F.count_if(~flag & ~fraud).alias("true_negatives"))


def precision_recall(scored: DataFrame, by: Sequence[Column] = (), tiers: Sequence[str] = FLAG_TIERS) -> DataFrame:
    """Precision, recall (= fraud detection rate) and the detected share of
    the fraud amount, over all rows or per group."""
    flag, fraud, amount = flagged(tiers), F.col("is_fraud_label"), F.col("transaction_amount").cast("decimal(12,2)")
    caught = F.count_if(flag & fraud)
    zero = F.lit(0).cast("decimal(12,2)")
    return scored.groupBy(*by).agg(
        F.try_divide(caught, F.count_if(flag)).cast("double").alias("precision"),
        F.try_divide(caught, F.count_if(fraud)).cast("double").alias("recall"),
        F.try_divide(F.sum(F.when(flag & fraud, amount).otherwise(zero)).cast("double"),
                     F.sum(F.when(fraud, amount).otherwise(zero)).cast("double")).alias("fraud_amount_detected"))


def pr_curve(scored: DataFrame) -> DataFrame:
    """Precision and recall at each distinct probability threshold.

    Rows are first counted per probability. The counts are dealt out by ranges
    of it and written down; each range is summed up on its own, and what the
    ranges above hold in all, one row per range, is added.
    """
    counts = (scored.groupBy(F.col("fraud_probability").alias("threshold"))
              .agg(F.count_if("is_fraud_label").alias("_fraud"), F.count("*").alias("_all"))
              .repartitionByRange(F.col("threshold").desc()).withColumn("_range", F.spark_partition_id()))
    counts = write_table(counts, scratch(scored.sparkSession, "pr-counts"))
    above = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranges = counts.groupBy("_range").agg(F.sum("_fraud").alias("_tp"), F.sum("_all").alias("_n")).select(
        "_range", F.coalesce(F.sum("_tp").over(above), F.lit(0)).alias("_tp_above"),
        F.coalesce(F.sum("_n").over(above), F.lit(0)).alias("_n_above"), F.sum("_tp").over(everything).alias("_total"))
    down = Window.partitionBy("_range").orderBy(F.col("threshold").desc()).rowsBetween(Window.unboundedPreceding, 0)
    running = counts.withColumns({"_tp": F.sum("_fraud").over(down), "_n": F.sum("_all").over(down)}).join(
        ranges, "_range").withColumns({"_tp": F.col("_tp") + F.col("_tp_above"), "_n": F.col("_n") + F.col("_n_above")})
    total = F.col("_total")
    return running.select(
        "threshold",
        (F.col("_tp") / F.col("_n")).cast("double").alias("precision"),
        F.try_divide(F.col("_tp"), total).cast("double").alias("recall"),
        F.try_divide(F.col("_fraud"), total).cast("double").alias("recall_step"))


def pr_auc(scored: DataFrame) -> DataFrame:
    """Average precision: precision weighted by each threshold's gain in recall."""
    return pr_curve(scored).agg(F.sum(F.col("precision") * F.col("recall_step")).alias("pr_auc"))
