import pytest
from pyspark.sql import functions as F

from tests.helpers import FOLDER, rows_of
from txnrisk.operators import evaluation, kpi, training
from txnrisk.operators.scoring import LogisticScorer, risk_tier, score, with_scores
from txnrisk.plans import layers
from txnrisk.schemas import FEATURE_COLUMNS, SCORE_COLUMNS


def test_tier_bounds(spark):
    values = [-0.1, 0.0, 0.3, 0.3000001, 0.7, 0.7000001, 1.0, 1.0000001, float("nan"), None]
    rows = spark.createDataFrame([(v,) for v in values], "p double")
    assert [r[0] for r in rows.select(risk_tier(F.col("p"))).collect()] == [
        None, "Low", "Low", "Medium", "Medium", "High", "High", None, None, None]


def test_missing_inputs_count_as_zero(spark):
    rows = spark.range(1).select(*[F.lit(None).cast("double").alias(c) for c in FEATURE_COLUMNS])
    assert rows.select(LogisticScorer().probability()).first()[0] == round(1 / (1 + 2.718281828459045 ** 3), 6)


def test_empty_batch_keeps_its_types(spark):
    features = layers.features(spark, FOLDER).limit(0)
    empty = score(features)
    assert empty.columns == SCORE_COLUMNS and empty.count() == 0
    assert dict(empty.dtypes)["fraud_probability"] == "double" and dict(empty.dtypes)["risk_tier"] == "string"


@pytest.fixture(scope="module")
def rows(spark):
    return training.for_model(layers.features(spark, FOLDER, keep=layers.KEPT))


@pytest.mark.parametrize("kind", ["logistic", "trees"])
def test_trained_model_survives_saving(spark, rows, kind, tmp_path):
    model = training.train(rows, kind, max_iter=3)
    training.save_champion(model, str(tmp_path))
    scored = with_scores(rows, training.load_champion(str(tmp_path)))
    assert scored.filter(F.col("fraud_probability").between(0, 1)).count() == rows.count()
    mean = scored.groupBy("is_fraud_label").agg(F.avg("fraud_probability")).collect()
    by_label = {r[0]: r[1] for r in mean}
    assert by_label[True] > by_label[False]


def test_unknown_classifier(rows):
    with pytest.raises(ValueError):
        training.train(rows, "oracle")


def scored(spark, *triples):
    return spark.createDataFrame([(p, t, f, 10) for p, t, f in triples],
                                 "fraud_probability double, risk_tier string, is_fraud_label boolean, transaction_amount int")


def test_measures_without_positives(spark):
    frame = scored(spark, (0.1, "Low", False), (0.2, None, False))
    assert rows_of(evaluation.confusion(frame), "true_positives", "true_negatives") == [(0, 2)]
    assert rows_of(evaluation.precision_recall(frame), "precision", "recall", "fraud_amount_detected") == [(None, None, None)]
    assert rows_of(evaluation.pr_auc(frame)) == [(None,)]


def test_pr_auc_of_a_perfect_and_a_tied_ranking(spark):
    perfect = scored(spark, (0.9, "High", True), (0.8, "High", True), (0.1, "Low", False))
    assert rows_of(evaluation.pr_auc(perfect)) == [(1.0,)]
    tied = scored(spark, *[(0.5, "Medium", i == 0) for i in range(4)])
    assert rows_of(evaluation.pr_auc(tied)) == [(0.25,)]


def test_scores_joined_back_to_the_fact(spark):
    fact = layers.fact(spark, FOLDER)
    joined = kpi.enrich(score(layers.features(spark, FOLDER)), fact, ["transaction_amount", "payment_method"])
    assert joined.count() == fact.count()


def test_kpis_recompute_whole_days(spark):
    rows = spark.createDataFrame(
        [("2024-01-01 00:00:00", "Low", 0.1), ("2024-01-02 00:00:00", "High", 0.9), ("2024-01-02 10:00:00", "Low", 0.1)],
        "t string, risk_tier string, fraud_probability double").withColumn("transaction_date", F.to_timestamp("t"))
    refreshed = kpi.daily_kpi(rows, since=F.lit("2024-01-02").cast("date"))
    # The row at midnight belongs to its day.
    assert rows_of(refreshed, "total_transactions", "flagged_high") == [(2, 1)]
