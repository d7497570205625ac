import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import at, rows_of, transactions
from txnrisk.operators.scd2 import asof_join, current_rows, scd2_apply, scd2_from_events
from txnrisk.schemas import SCD_ID, VALID_FROM, VALID_TO

DAY = {n: dt.datetime(2024, 1, n) for n in range(1, 10)}


def snapshot(state, spark, rows, day):
    current = spark.createDataFrame(rows, "k string, a string, b string")
    return scd2_apply(state, current, "k", ["a", "b"], F.lit(DAY[day]))


def test_snapshots(spark):
    state = snapshot(None, spark, [("same", "1", None), ("changed", "1", "x"), ("to_null", "1", "x"),
                                   ("from_null", None, "x"), ("gone", "1", "x")], 1)
    state = snapshot(state, spark, [("same", "1", None), ("changed", "2", "x"), ("to_null", "1", None),
                                    ("from_null", "1", "x"), ("new", "9", "y")], 2)
    state = snapshot(state, spark, [("changed", "1", "x")], 3)
    assert rows_of(state, "k", "a", "b", VALID_FROM, VALID_TO) == sorted([
        ("same", "1", None, DAY[1], None),
        ("changed", "1", "x", DAY[1], DAY[2]), ("changed", "2", "x", DAY[2], DAY[3]), ("changed", "1", "x", DAY[3], None),
        ("to_null", "1", "x", DAY[1], DAY[2]), ("to_null", "1", None, DAY[2], None),
        ("from_null", None, "x", DAY[1], DAY[2]), ("from_null", "1", "x", DAY[2], None),
        ("gone", "1", "x", DAY[1], None), ("new", "9", "y", DAY[2], None)], key=repr)
    assert state.select(SCD_ID).distinct().count() == state.count()
    assert current_rows(state).count() == 6


def test_repeated_snapshot_changes_nothing(spark):
    first = snapshot(None, spark, [("a", "1", "x")], 1)
    second = snapshot(first, spark, [("a", "2", "x")], 2)
    assert rows_of(snapshot(second, spark, [("a", "2", "x")], 2)) == rows_of(second)
    corrected = snapshot(second, spark, [("a", "3", "x")], 2)
    assert rows_of(corrected, "a", VALID_FROM, VALID_TO) == [("1", DAY[1], DAY[2]), ("3", DAY[2], None)]


def test_event_time_versions(spark):
    fact = transactions(spark, [
        dict(transaction_date="2024-01-01 00:00:00", billing_country="A"),
        dict(transaction_date="2024-01-02 00:00:00", billing_country="A"),
        dict(transaction_date="2024-01-03 00:00:00", billing_country=None),
        dict(transaction_date="2024-01-04 00:00:00", billing_country="A"),
        dict(transaction_date="2024-01-04 00:00:00", billing_country="B")])
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country"], "transaction_id")
    assert rows_of(versions, "billing_country", VALID_FROM, VALID_TO) == sorted([
        ("A", DAY[1], DAY[3]), (None, DAY[3], DAY[4]), ("B", DAY[4], None)], key=repr)


def test_asof_edges(spark):
    versions = spark.createDataFrame(
        [("U1", "A", DAY[2], DAY[4]), ("U1", "B", DAY[5], None), ("U2", "Z", DAY[1], None), (None, "N", DAY[1], None)],
        f"user_id string, country string, {VALID_FROM} timestamp, {VALID_TO} timestamp")
    fact = transactions(spark, [dict(transaction_date=d) for d in (
        "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-03 23:59:59", "2024-01-04 00:00:00",
        "2024-01-05 00:00:00", "2024-01-09 00:00:00")] + [dict(user_id=None), dict(user_id="U3")])
    for heavy in ([], ["U1"]):
        found = asof_join(fact, versions, "user_id", "transaction_date", "transaction_id", {"country": "then"}, heavy=heavy)
        assert rows_of(found, "transaction_id", "then") == sorted([
            ("T0", None), ("T1", "A"), ("T2", "A"), ("T3", None), ("T4", "B"), ("T5", "B"), ("T6", None), ("T7", None)])


def test_asof_equals_range_join(spark):
    fact = transactions(spark, [
        dict(user_id=f"U{i % 3}", transaction_date=at("2024-01-01 00:00:00") + dt.timedelta(hours=7 * i % 240))
        for i in range(120)])
    source = fact.withColumn("c", F.pmod(F.xxhash64("transaction_id"), F.lit(3)).cast("string"))
    versions = scd2_from_events(source, "user_id", "transaction_date", ["c"], "transaction_id")
    versions = versions.filter(F.col("c") != "2")
    by_time = asof_join(fact, versions, "user_id", "transaction_date", "transaction_id", {"c": "then"})
    v = versions.withColumnRenamed("user_id", "u")
    ranged = fact.join(v, (F.col("user_id") == F.col("u")) & (F.col("transaction_date") >= F.col(VALID_FROM))
                       & (F.col(VALID_TO).isNull() | (F.col("transaction_date") < F.col(VALID_TO))), "left")
    assert rows_of(by_time, "transaction_id", "then") == rows_of(ranged, "transaction_id", "c")
