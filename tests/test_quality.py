import pytest

from tests.helpers import rows_of
from txnrisk.operators.quality import (QualityError, accepted_range, accepted_values, expression, failing_rows, gate,
                                       not_null, orphans, relationship, report, unique)
from txnrisk.plans.contracts import contracts


@pytest.fixture(scope="module")
def tables(spark):
    child = spark.createDataFrame(
        [("a", 1, "x"), ("a", 5, "y"), ("a", -1, None), ("b", None, "x"), (None, 7, "z"), (None, 8, "x")],
        "k string, n int, c string")
    return {"child": child, "parent": spark.createDataFrame([("a",), ("a",), (None,)], "k string")}


DECLARED = {"child": [
    not_null("k"), unique("k"), accepted_values("c", ["x", "y"]), accepted_range("n", 0, 7), accepted_range("n", 0),
    accepted_range("n", high=5), expression("n < 8 or c = 'y'"), relationship("k", "parent", "k")]}


def test_report(tables):
    assert rows_of(report(tables, DECLARED), "column_name", "check_name", "failures") == sorted([
        ("k", "not_null", 2), ("k", "unique", 1), ("c", "accepted_values", 1), ("n", "accepted_range", 2),
        ("n", "accepted_range", 1), ("n", "accepted_range", 2), ("n < 8 or c = 'y'", "expression_is_true", 1),
        ("k", "relationships", 1)], key=repr)


def test_gate(tables):
    with pytest.raises(QualityError) as error:
        gate(report(tables, DECLARED))
    assert len(error.value.failed) == 8 and "child.k unique: 1" in str(error.value)
    assert gate(report(tables, {"parent": [accepted_values("k", ["a"])]})) == 1


def test_orphans_and_rows(tables):
    assert rows_of(orphans(tables["child"], "k", tables["parent"], "k")) == [("b", 1)]
    assert rows_of(failing_rows(tables["child"], accepted_range("n", 0)), "n") == [(-1,)]
    with pytest.raises(ValueError):
        failing_rows(tables["child"], unique("k"))


def test_one_scan_for_all_row_level_checks(tables):
    plan = report(tables, {"child": [c for c in DECLARED["child"] if c.row_level]})
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Aggregate") == 1


def test_every_declared_check_is_there():
    counts = {name: len(checks) for name, checks in contracts().items()}
    assert sum(counts.values()) == 81
    assert counts["bronze_transactions"] == 14
