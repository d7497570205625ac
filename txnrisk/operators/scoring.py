"""Fraud probability and risk tier, computed where the rows are."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from txnrisk.functions.geo import clamp
from txnrisk.schemas import SCORE_COLUMNS

# Upper bounds (inclusive) of Low, Medium and High.
TIER_CUTS = (0.3, 0.7, 1.0)


def risk_tier(probability: Column, cuts: Sequence[float] = TIER_CUTS) -> Column:
    """Low up to the first cut, Medium up to the second, High up to the last.

    NULL, NaN and values outside [0, last cut] have no tier.
    """
    low, medium, high = cuts
    return (F.when(F.isnan(probability) | (probability < 0), F.lit(None).cast("string"))
            .when(probability <= low, "Low").when(probability <= medium, "Medium").when(probability <= high, "High"))


@dataclass(frozen=True)
class LogisticScorer:
    """A fixed logistic model over the eight features; missing inputs count 0."""

    intercept: float = -3.0
    amount_zscore: float = 0.6
    velocity_1hr: float = 0.7
    impossible_travel_flag: float = 2.0
    new_device_flag: float = 1.0
    device_amount_percentile: float = 0.3
    off_hours_flag: float = 0.5
    location_mismatch_flag: float = 1.5
    merchant_risk_rate: float = 4.0
    max_zscore: float = 5.0
    max_percentile: float = 5.0

    def probability(self) -> Column:
        def present(value: Column) -> Column:
            return F.coalesce(value.cast("double"), F.lit(0.0))

        percentile = F.col("device_amount_percentile").cast("double")
        z = (F.lit(self.intercept)
             + self.amount_zscore * present(clamp(F.col("amount_zscore"), -self.max_zscore, self.max_zscore))
             + self.velocity_1hr * present(F.col("velocity_1hr"))
             + self.impossible_travel_flag * present(F.col("impossible_travel_flag"))
             + self.new_device_flag * present(F.col("new_device_flag"))
             + self.device_amount_percentile
             * present(F.when(percentile > self.max_percentile, F.lit(self.max_percentile)).otherwise(percentile))
             + self.off_hours_flag * present(F.col("off_hours_flag"))
             + self.location_mismatch_flag * present(F.col("location_mismatch_flag"))
             + self.merchant_risk_rate * present(F.col("merchant_risk_rate")))
        return F.round(1.0 / (1.0 + F.exp(-z)), 6)


def with_scores(features: DataFrame, model: LogisticScorer | PipelineModel | None = None,
                cuts: Sequence[float] = TIER_CUTS) -> DataFrame:
    """``features`` plus fraud_probability and risk_tier."""
    model = model or LogisticScorer()
    if isinstance(model, LogisticScorer):
        scored = features.withColumn("fraud_probability", model.probability())
    else:
        scored = (model.transform(features)
                  .withColumn("fraud_probability", vector_to_array("probability")[1])
                  .select(*features.columns, "fraud_probability"))
    return scored.withColumn("risk_tier", risk_tier(F.col("fraud_probability"), cuts))


def score(features: DataFrame, model: LogisticScorer | PipelineModel | None = None,
          cuts: Sequence[float] = TIER_CUTS) -> DataFrame:
    """The score table. An empty batch gives an empty, fully typed table."""
    return with_scores(features, model, cuts).select(*SCORE_COLUMNS)
