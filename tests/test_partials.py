"""Measures from day partials beside those from the rows themselves."""

import random

from tests.helpers import rows_of, transactions
from txnrisk.operators.baselines import merchant_risk, user_baseline
from txnrisk.operators.partials import baseline_from_partials, merchant_days, merchant_risk_from_partials, user_days
from txnrisk.operators.state import overwrite_days, with_event_date, write_by_day, write_table


def some_rows(spark, n=400, seed=3):
    draw = random.Random(seed)
    return with_event_date(transactions(spark, [dict(
        transaction_id=f"T{i}", user_id=draw.choice(["A", "A", "A", "B", "C", None]), merchant_id=draw.choice(["M", "N"]),
        transaction_amount=draw.choice([1, 2.5, 9999999999.99, draw.randint(1, 10**6) / 100]),
        transaction_date=f"2024-01-{draw.randint(1, 28):02d} {draw.randint(0, 23):02d}:00:00",
        is_fraud_label=draw.random() < 0.2) for i in range(n)]))


def close(rows):
    return [tuple(round(v, 4) if isinstance(v, float) else v for v in row) for row in rows]


def test_equal_to_the_measures_of_the_rows(spark):
    fact = some_rows(spark)
    keys = spark.createDataFrame([("A",), ("Z",)], "user_id string")
    for as_of in ("2024-01-28", "2024-02-15", "2025-01-01"):
        for users in (None, keys):
            assert close(rows_of(baseline_from_partials(user_days(fact), as_of, users=users))) == close(
                rows_of(user_baseline(fact, as_of, users=users)))
        assert rows_of(merchant_risk_from_partials(merchant_days(fact), as_of, 20)) == rows_of(
            merchant_risk(fact, as_of, 20))


def test_same_columns_and_types(spark):
    fact = some_rows(spark, 20)
    for made, plain in ((baseline_from_partials(user_days(fact), "2024-02-01"), user_baseline(fact, "2024-02-01")),
                        (merchant_risk_from_partials(merchant_days(fact), "2024-02-01"), merchant_risk(fact, "2024-02-01"))):
        assert [(f.name, f.dataType) for f in made.schema] == [(f.name, f.dataType) for f in plain.schema]


def test_percentile_of_one_two_and_ten(spark):
    rows = [dict(transaction_id=f"{u}{i}", user_id=u, transaction_amount=i + 1)
            for u, n in (("one", 1), ("two", 2), ("ten", 10), ("eleven", 11)) for i in range(n)]
    made = baseline_from_partials(user_days(with_event_date(transactions(spark, rows))), "2024-01-02")
    assert {r.user_id: int(r.p90_amount_30d) for r in made.collect()} == {"one": 1, "two": 2, "ten": 9, "eleven": 10}


def test_days_are_put_in_place_of_what_was_there(spark, tmp_path):
    fact, path = some_rows(spark), str(tmp_path / "days")
    write_by_day(user_days(fact), path)
    schema = user_days(fact).schema
    later = fact.filter("event_date != '2024-01-10' and not (event_date = '2024-01-11' and user_id = 'A')")
    days = [r[0] for r in fact.filter("event_date in ('2024-01-10', '2024-01-11')").select("event_date").distinct().collect()]
    for _ in range(2):  # a repeated run changes nothing
        fresh = write_table(user_days(later.filter(later.event_date.isin(days))), str(tmp_path / "fresh"), ["event_date"])
        overwrite_days(spark, path, fresh, days)
        assert rows_of(spark.read.schema(schema).parquet(path)) == rows_of(user_days(later))


def test_empty(spark):
    fact = some_rows(spark, 5).limit(0)
    assert baseline_from_partials(user_days(fact), "2024-02-01").count() == 0
    assert merchant_risk_from_partials(merchant_days(fact), "2024-02-01").count() == 0
