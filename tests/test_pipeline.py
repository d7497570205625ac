"""Several daily runs must leave what recomputing from scratch gives."""

import pytest
from pyspark.sql import functions as F

from tests.helpers import FOLDER, raw_rows, rows_of
from txnrisk.operators import state
from txnrisk.operators.baselines import merchant_risk, user_baseline
from txnrisk.operators.clean import clean
from txnrisk.operators.features import build_features
from txnrisk.operators.incremental import device_firsts, user_points
from txnrisk.operators.kpi import daily_kpi
from txnrisk.operators.quality import QualityError
from txnrisk.operators.scd2 import scd2_from_events
from txnrisk.plans.layers import early
from txnrisk.plans import pipeline
from txnrisk.plans.pipeline import run_pipeline
from txnrisk.sources.events import read_raw
from txnrisk.sources.tables import LayerStore


def batches(raw):
    cut = F.lit("2024-01-24").cast("timestamp_ntz")
    late = ~early()
    second = raw.filter(late & (F.col("TransactionDate") < cut))
    # The last batch re-sends some early transactions, a day later.
    resent = (raw.filter(early() & (F.col("UserID") == "U000003"))
              .withColumn("TransactionDate", F.col("TransactionDate") + F.expr("interval 1 day"))
              .withColumn("TransactionAmount", F.abs("TransactionAmount") + 5))
    third = raw.filter(late & (F.col("TransactionDate") >= cut)).unionByName(resent)
    return [raw.filter(early()), second, third]


@pytest.fixture(scope="module")
def runs(spark, tmp_path_factory):
    """The store after three runs, and the fact of all their rows."""
    store = LayerStore(spark, str(tmp_path_factory.mktemp("layers")))
    fact = None
    for number, raw in enumerate(batches(read_raw(spark, FOLDER))):
        report = run_pipeline(store, raw, f"2024-02-0{number + 1}")
        assert report.checks == 82
        fact = state.write_table(
            state.upsert(fact, clean(raw), ["transaction_id"]), str(tmp_path_factory.mktemp("fact") / "t"))
    return store, fact


def table(store, layer, name):
    return store.spark.read.parquet(store.path(layer, name))


def test_fact(runs):
    store, fact = runs
    for layer, name in (("bronze", "transactions"), ("silver", "fact")):
        assert rows_of(table(store, layer, name).drop("event_date")) == rows_of(fact)


FROM_HISTORY = ["transaction_id", "velocity_1hr", "impossible_travel_flag", "new_device_flag", "location_mismatch_flag"]


def test_features_from_history_equal_a_rebuild(runs):
    store, fact = runs
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country"], "transaction_id")
    rebuilt = build_features(fact, versions, store.read("gold", "user_baseline"), store.read("gold", "merchant_risk"))
    assert rows_of(table(store, "gold", "features"), *FROM_HISTORY) == rows_of(rebuilt, *FROM_HISTORY)


def test_baselines_equal_a_rebuild(runs):
    store, fact = runs
    for name, measure in (("user_baseline", user_baseline), ("merchant_risk", merchant_risk)):
        held, rebuilt = store.read("gold", name).drop("last_updated_at"), measure(fact, "2024-02-03")
        shown = [F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in rebuilt.dtypes]
        assert rows_of(held.select(*shown)) == rows_of(rebuilt.select(*shown))


def test_a_late_row_corrects_the_rows_after_it(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    run_pipeline(store, raw_rows(spark, [dict(TransactionID="A", TransactionDate="2024-01-01T10:30:00+00:00")]), "2024-02-01")
    run_pipeline(store, raw_rows(spark, [dict(TransactionID="B", TransactionDate="2024-01-01T10:10:00+00:00")]), "2024-02-02")
    assert rows_of(table(store, "gold", "features"), "transaction_id", "velocity_1hr", "new_device_flag") == [
        ("A", 1, 0), ("B", 0, 1)]


def test_keys_that_a_resent_row_left_are_refreshed(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = [dict(TransactionID=i, UserID=u, MerchantID=m) for i, u, m in (("A", "U1", "M1"), ("B", "U1", "M1"), ("C", "U3", "M3"))]
    run_pipeline(store, raw_rows(spark, rows), "2024-01-10")
    moved = [dict(TransactionID=i, UserID="U2", MerchantID="M2") for i in ("A", "C")]
    run_pipeline(store, raw_rows(spark, moved), "2024-01-11")
    assert rows_of(store.read("gold", "user_baseline"), "user_id", "transaction_count_30d") == [("U1", 1), ("U2", 2)]
    assert rows_of(store.read("gold", "merchant_risk"), "merchant_id", "transaction_count_90d") == [("M1", 1), ("M2", 2)]


def test_windows_that_roll_on_are_refreshed(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    rows = [dict(TransactionID=f"{u}{d}", UserID=u, TransactionDate=f"2024-01-{d:02}T00:00:00+00:00")
            for u, d in (("U1", 1), ("U1", 20), ("U2", 1), ("U3", 25))]
    run_pipeline(store, raw_rows(spark, rows), "2024-01-30")
    run_pipeline(store, raw_rows(spark, [dict(TransactionID="x", UserID="U3", TransactionDate="2024-02-05T00:00:00+00:00")]),
                 "2024-02-10")
    assert rows_of(store.read("gold", "user_baseline"), "user_id", "transaction_count_30d") == [("U1", 1), ("U3", 2)]


def test_an_id_sent_again_after_a_long_time_is_replaced(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    for number, date in enumerate(("2022-03-01", "2024-01-09")):
        run_pipeline(store, raw_rows(spark, [dict(TransactionID="A", TransactionDate=f"{date}T00:00:00+00:00")]), f"2024-02-0{number + 1}")
    assert rows_of(table(store, "silver", "fact"), "transaction_id") == [("A",)]


def test_state_tables(runs):
    store, fact = runs
    assert rows_of(store.read("state", "user_points")) == rows_of(user_points(fact))
    assert rows_of(store.read("state", "device_firsts")) == rows_of(device_firsts(fact))
    versions = scd2_from_events(fact, "user_id", "transaction_date", ["billing_country"], "transaction_id")
    assert rows_of(store.read("silver", "country_versions")) == rows_of(versions)


def test_kpis_follow_the_scores(runs):
    store, _ = runs
    scores = table(store, "gold", "scores")
    assert rows_of(store.read("gold", "daily_kpi").drop("last_updated_at", "avg_fraud_probability")) == rows_of(
        daily_kpi(scores).drop("avg_fraud_probability"))


def test_repeating_the_last_run_changes_nothing(runs, spark):
    store, _ = runs

    def gold():
        # A deviation summed in another order may differ in its last bit.
        features = table(store, "gold", "features").withColumn("amount_zscore", F.round("amount_zscore", 9))
        return rows_of(features), rows_of(table(store, "gold", "scores"))

    before = gold()
    users = rows_of(store.read("snapshots", "users"))
    run_pipeline(store, batches(read_raw(spark, FOLDER))[2], "2024-02-03")
    assert gold() == before
    assert rows_of(store.read("snapshots", "users")) == users


def test_a_failed_check_stops_the_run(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    raw = raw_rows(spark, [dict(PaymentMethod="barter"), dict(TransactionID="T2", UserID=None)])
    with pytest.raises(QualityError) as error:
        run_pipeline(store, raw, "2024-02-01")
    assert {(r.column_name, r.check_name) for r in error.value.failed} == {
        ("payment_method", "accepted_values"), ("user_id", "not_null")}
    assert store.read("snapshots", "users") is None


def test_an_empty_batch_changes_nothing(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    run_pipeline(store, raw_rows(spark, [dict()]), "2024-02-01")
    assert run_pipeline(store, raw_rows(spark, []), "2024-02-02").days == ()


def test_snapshot_country_history(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))
    raw = raw_rows(spark, [dict(IP_Country="DE", BillingCountry="US")])
    run_pipeline(store, raw, "2024-02-01", country_history="snapshot")
    # The transaction is older than the first snapshot, so no country is known.
    assert rows_of(table(store, "gold", "features"), "location_mismatch_flag") == [(0,)]


@pytest.mark.parametrize("step", ["_features", "daily_kpi"])
def test_a_run_that_died_half_way_can_be_repeated(spark, tmp_path, monkeypatch, step):
    first = raw_rows(spark, [dict(TransactionID=f"T{d}", TransactionDate=f"2024-01-0{d}T00:00:00+00:00") for d in (1, 2)])
    # T1 comes again with another date, so its old row must go.
    second = raw_rows(spark, [dict(TransactionID="T1", TransactionDate="2024-01-03T00:00:00+00:00", LocationLat="60"),
                              dict(TransactionID="T3", TransactionDate="2024-01-03T00:10:00+00:00")])
    stores = [LayerStore(spark, str(tmp_path / name)) for name in ("broken", "whole")]
    for store in stores:
        run_pipeline(store, first, "2024-02-01")
    with monkeypatch.context() as patched:
        def die(*_, **__):
            raise RuntimeError("lost")
        patched.setattr(pipeline, step, die)
        with pytest.raises(RuntimeError, match="lost"):
            run_pipeline(stores[0], second, "2024-02-02")
    for store in stores:
        run_pipeline(store, second, "2024-02-02")
    broken, whole = stores
    for layer, name in (("bronze", "transactions"), ("silver", "fact"), ("gold", "features"), ("gold", "scores")):
        assert rows_of(table(broken, layer, name)) == rows_of(table(whole, layer, name))
    for layer, name in (("gold", "daily_kpi"), ("snapshots", "users"), ("state", "user_points"),
                        ("state", "device_firsts"), ("silver", "country_versions")):
        assert rows_of(broken.read(layer, name)) == rows_of(whole.read(layer, name))


def test_new_rows_of_a_day_leave_its_files(spark, tmp_path):
    store = LayerStore(spark, str(tmp_path))

    def files():
        return {str(f) for name in ("bronze/transactions", "silver/fact", "state/user_days", "state/merchant_days", "gold/features",
                                    "gold/scores") for f in (tmp_path / name).glob("event_date=2024-01-01/*.parquet")}

    def run(number, *rows):
        run_pipeline(store, raw_rows(spark, [dict(TransactionID=i, UserID=u, TransactionDate=f"2024-01-01T{h}:00:00+00:00")
                                             for i, u, h in rows]), f"2024-01-1{number}")
        return files()

    first = run(0, ("A", "U1", 10))
    second = run(1, ("B", "U2", 11), ("C", "U1", 12))
    assert len(first) == 6 and first < second
    assert not first & run(2, ("A", "U2", 13))  # stored, so its day is written anew
    assert rows_of(table(store, "gold", "features"), "transaction_id", "user_id", "velocity_1hr") == [
        ("A", "U2", 0), ("B", "U2", 0), ("C", "U1", 0)]
    assert rows_of(store.read("gold", "user_baseline"), "user_id", "transaction_count_30d") == [("U1", 1), ("U2", 2)]
    counted = table(store, "state", "user_days").groupBy("user_id").agg(F.sum("transactions").alias("n"))
    assert rows_of(counted, "user_id", "n") == [("U1", 1), ("U2", 2)]


def test_keys_of_a_batch_are_collected_once(spark, tmp_path, monkeypatch):
    """Baselines and features take the users from what the snapshots use; only a rolled window adds to them."""
    store, written = LayerStore(spark, str(tmp_path / "layers")), []
    scratch = pipeline.scratch
    monkeypatch.setattr(pipeline, "scratch", lambda spark, label: written.append(label) or scratch(spark, label))
    for number in (1, 2):
        run_pipeline(store, raw_rows(spark, [dict(TransactionID=f"T{number}", TransactionDate=f"2024-01-0{number}T00:00:00+00:00")]),
                     f"2024-02-0{number}")
    assert [sum(label.startswith(name) for label in written) for name in ("keys-", "touched-users")] == [6, 0]
    assert table(store, "gold", "features").count() == 2
