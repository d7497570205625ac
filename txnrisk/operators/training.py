"""Training the fraud classifier with MLlib, and keeping the champion model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.sql import DataFrame, functions as F

from txnrisk.schemas import FEATURE_COLUMNS


def training_rows(features: DataFrame) -> DataFrame:
    """Double inputs, a 0/1 label and weights that balance the two classes.

    The class shares come from one aggregate row joined in as a scalar; no
    row leaves the executors.
    """
    share = features.agg(F.avg(F.col("is_fraud_label").cast("double"))).scalar()
    fraud = F.col("is_fraud_label")
    return features.select(
        "transaction_id",
        *[F.col(c).cast("double").alias(c) for c in FEATURE_COLUMNS],
        fraud.cast("double").alias("label"),
        F.when(fraud, 0.5 / F.greatest(share, F.lit(1e-9)))
        .otherwise(0.5 / F.greatest(1 - share, F.lit(1e-9))).alias("weight"),
        "is_fraud_label")


def train(features: DataFrame, kind: str = "logistic", max_iter: int = 20) -> PipelineModel:
    """Fit imputation, assembly and a class-weighted classifier."""
    inputs = [f"{c}_filled" for c in FEATURE_COLUMNS]
    fill = Imputer(inputCols=FEATURE_COLUMNS, outputCols=inputs, strategy="mean")
    assemble = VectorAssembler(inputCols=inputs, outputCol="features")
    if kind == "logistic":
        classifier = LogisticRegression(weightCol="weight", maxIter=max_iter)
    elif kind == "trees":
        classifier = GBTClassifier(weightCol="weight", maxIter=max_iter, seed=42)
    else:
        raise ValueError(f"unknown classifier {kind!r}")
    return Pipeline(stages=[fill, assemble, classifier]).fit(training_rows(features))


def for_model(features: DataFrame) -> DataFrame:
    """Feature rows with the inputs as doubles, as the trained model expects."""
    return features.withColumns({c: F.col(c).cast("double") for c in FEATURE_COLUMNS})


def save_champion(model: PipelineModel, root: str, name: str = "risk_model") -> str:
    path = f"{root}/{name}/champion"
    model.write().overwrite().save(path)
    return path


def load_champion(root: str, name: str = "risk_model") -> PipelineModel:
    return PipelineModel.load(f"{root}/{name}/champion")
