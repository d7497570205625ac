import numpy as np
import pytest
from pyspark.sql import functions as F

from txnrisk.llm import ordinal_quality as oq
from txnrisk.llm.common import read_table


def test_fit_recovers_the_order():
    draw = np.random.default_rng(3)
    grades = draw.integers(0, 3, 600)
    rows = [np.array(sorted({10 + g, 100 + int(x)}), np.int32) for g, x in zip(grades, draw.integers(0, 40, 600))]
    model = oq.fit(rows, grades)
    scores = [np.mean([model.weights[r].sum() for r, g in zip(rows, grades) if g == grade]) for grade in range(3)]
    assert scores[0] < model.thresholds[0] < scores[1] < model.thresholds[1] < scores[2]
    at = np.array(scores)
    assert (np.diff(model.expected(at)) > 0).all() and (model.tail(at, 1) >= model.tail(at, 2)).all()


def test_gradient_lowers_the_loss_from_its_start():
    grades = np.array([0, 1, 2] * 20)
    rows = [np.array([5], np.int32)] * 60
    model = oq.fit(rows, grades)  # nothing to tell grades apart: thresholds must give their shares
    score = model.weights[5]
    assert model.tail(score, 1) == pytest.approx(2 / 3, abs=0.02) and model.tail(score, 2) == pytest.approx(1 / 3, abs=0.02)


def test_held_out_documents(spark):
    """Fitted on half of some 4,000 rated documents, it grades the other half."""
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    model = oq.train(docs, labels.where("doc_id % 2 = 0"))
    judged = oq.score(docs.join(labels.where("doc_id % 2 = 1"), "doc_id"), model)
    shares = {r.clean: r.kept for r in judged.groupBy(((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("clean"))
              .agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert shares[True] >= 0.98 and shares[False] <= 0.15


def test_sample_is_bounded(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.01", t) for t in ("documents", "labels"))
    a, b = oq.train(docs, labels, sample_rows=100), oq.train(docs.repartition(7), labels.repartition(3), sample_rows=100)
    assert np.array_equal(a.weights, b.weights) and a.thresholds == b.thresholds


def test_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (5, 1, 1), (7, None, 1), (None, 1, 1), (4, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = oq.train(edge, labels)
    docs = edge.selectExpr("*", "1 AS expected_grade", "2 AS tail_probability")
    rows = oq.score(docs, model).collect()
    assert len(rows) == docs.count() and all(0 <= r.expected_grade <= 2 and isinstance(r.kept, bool) for r in rows)
    assert oq.score(nothing, model).count() == 0
    assert oq.train(nothing, labels) is None and oq.train(edge, labels.where("false")) is None
    assert all(r.kept and r.expected_grade is None for r in oq.score(edge, None).collect())


def test_query(spark):
    from txnrisk.llm.queries import op2_ordinal_quality
    rows = op2_ordinal_quality(spark, "/root/testdata/sf0.001")
    assert rows.columns == ["doc_id", "expected_grade", "tail_probability", "kept"] and rows.count() == 200
