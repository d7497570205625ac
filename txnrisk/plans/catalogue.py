"""The registered queries: every operator applied to a data folder.

Doubles are rounded and decimals shown as doubles here, at the edge, so that
results compare across engines; the operators themselves do neither.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from txnrisk.functions.timing import trailing_window_start
from txnrisk.operators import (baselines, behaviour, clean, dims, drift, evaluation, features, incremental, kpi,
                               partials, quality, scd2, scoring, state, training)
from txnrisk.operators.skew import heavy_keys_by, join_salted
from txnrisk.plans import layers
from txnrisk.plans.contracts import contract_report
from txnrisk.plans.pipeline import run_pipeline
from txnrisk.schemas import PAYMENT_METHODS, RAW_COLUMNS, SCORE_COLUMNS, TRANSACTION_COLUMNS
from txnrisk.session import scratch
from txnrisk.sources import csv_files
from txnrisk.sources.tables import LayerStore, scan_table
from txnrisk.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), digits) for n in names})


def _double(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("double") for n in names})


def _bronze(df: DataFrame) -> DataFrame:
    return _double(df.select(*TRANSACTION_COLUMNS), "transaction_amount")


def _baseline(df: DataFrame) -> DataFrame:
    return _double(_rounded(df, 6, "stddev_amount_30d"), "avg_amount_30d", "p90_amount_30d")


def _kpi(df: DataFrame) -> DataFrame:
    return _rounded(df, 6, "avg_fraud_probability")


def _features(df: DataFrame) -> DataFrame:
    return _rounded(_rounded(df, 6, "amount_zscore"), 9, "device_amount_percentile", "merchant_risk_rate")


# -- landing and bronze ----------------------------------------------------

@query
def scan_raw(spark, folder):
    rows = csv_files.scan_csv(spark, layers.landed_csv(spark, folder))
    return rows.select(
        "TransactionID", "UserID", "MerchantID", "DeviceID", F.col("TransactionAmount").cast("double"),
        F.col("TransactionDate").cast("timestamp").cast("timestamp_ntz").alias("TransactionDate"),
        "PaymentMethod", "DeviceType", "IP_Address", F.col("LocationLat").cast("double"),
        F.col("LocationLon").cast("double"), "IP_Country", "BillingCountry", F.col("IsFraud").cast("boolean"))


def _per_date(rows: DataFrame) -> DataFrame:
    return rows.groupBy("business_date").agg(
        F.count("*").alias("row_count"),
        F.sum(F.col("TransactionAmount").cast("decimal(12,2)")).cast("double").alias("amount"))


@query
def scan_by_business_date(spark, folder):
    return _per_date(csv_files.scan_csv(spark, layers.landed_csv(spark, folder)))


@query
def scan_one_business_date(spark, folder):
    return _per_date(csv_files.scan_business_date(spark, layers.landed_csv(spark, folder), "2024-01-20"))


@query
def scan_flat_folder(spark, folder):
    """CSV files side by side in one folder, without looking below it."""
    path = scratch(spark, "flat")
    layers.raw(spark, folder).select(*[F.col(c).cast("string") for c in RAW_COLUMNS]).write.option("header", True).csv(path)
    rows = csv_files.scan_csv(spark, path, recursive=False)
    return rows.groupBy(F.col("IP_Country").alias("ip_country")).agg(F.count("*").alias("row_count"))


@query
def scan_named_table(spark, folder):
    """The fact as a catalog table, by its three-part name."""
    name = f"txnrisk_fact_{uuid.uuid4().hex}"
    layers.fact(spark, folder).write.option("path", scratch(spark, name)).saveAsTable(name)
    return _bronze(scan_table(spark, f"spark_catalog.default.{name}"))


@query
def bronze_dedup(spark, folder):
    rows = clean.deduplicate(clean.typed(layers.raw(spark, folder)))
    return _double(rows.select("transaction_id", "transaction_date", "transaction_amount"), "transaction_amount")


@query
def bronze_clean(spark, folder):
    return _bronze(clean.clean(layers.raw(spark, folder)))


@query
def bronze_quarantine(spark, folder):
    return clean.quarantine(layers.raw(spark, folder)).select(
        "reason", F.col("UserID").alias("user_id"), F.col("TransactionDate").alias("transaction_date"),
        F.col("TransactionAmount").alias("amount"))


@query
def batch_fraud_summary(spark, folder):
    return _rounded(clean.batch_summary(layers.raw(spark, folder)), 9, "fraud_share")


def _dated(files: DataFrame) -> DataFrame:
    return files.select(csv_files.business_date(F.col("file_path")).alias("business_date"))


@query
def pending_files(spark, folder):
    files = csv_files.list_files(spark, layers.landed_csv(spark, folder))
    known = files.filter(csv_files.business_date(F.col("file_path")) < F.lit("2024-01-16"))
    return _dated(csv_files.pending_files(files, known)).distinct()


def _loaded(spark: SparkSession, folder: str) -> tuple[str, str]:
    """Two loads: all files, then a second call that finds nothing pending."""
    root = scratch(spark, "landing")
    target = (f"{root}/rows", f"{root}/ledger")
    for _ in range(2):
        csv_files.load_pending(spark, layers.landed_csv(spark, folder), *target)
    return target


@query
def append_batches(spark, folder):
    return _per_date(csv_files.read_landing(spark, *_loaded(spark, folder)))


@query
def load_ledger(spark, folder):
    ledger = csv_files.read_ledger(spark, _loaded(spark, folder)[1])
    return (ledger.groupBy(csv_files.business_date(F.col("file_path")).alias("business_date"))
            .agg(F.sum("rows_loaded").alias("rows_loaded")))


@query
def load_ledger_seed(spark, folder):
    ledger = csv_files.seed_ledger(spark, layers.landed_csv(spark, folder), scratch(spark, "ledger"))
    return (ledger.groupBy(csv_files.business_date(F.col("file_path")).alias("business_date"))
            .agg(F.max("rows_loaded").alias("rows_loaded"), F.max("note").alias("note")))


# -- incremental state -----------------------------------------------------

def _newer(spark, folder):
    return state.new_rows(layers.fact(spark, folder), "transaction_date", layers.first_batch(spark, folder))


@query
def state_watermark(spark, folder):
    first = layers.first_batch(spark, folder)
    empty = state.watermark(first.limit(0), "transaction_date").scalar()
    return state.watermark(first, "transaction_date").withColumn("empty_watermark", empty)


@query
def incremental_filter_event_time(spark, folder):
    return _newer(spark, folder).select("transaction_id", "transaction_date")


@query
def affected_users(spark, folder):
    return state.affected(_newer(spark, folder), "user_id")


@query
def affected_users_history(spark, folder):
    users = state.affected(_newer(spark, folder), "user_id")
    return state.history_of(layers.fact(spark, folder), users, "user_id", layers.heavy(spark, folder, "user_id")).select(
        "transaction_id", "user_id")


@query
def affected_merchants_history(spark, folder):
    merchants = state.affected(_newer(spark, folder), "merchant_id")
    return state.history_of(layers.fact(spark, folder), merchants, "merchant_id",
                            layers.heavy(spark, folder, "merchant_id")).select("transaction_id", "merchant_id")


@query
def incremental_filter_affected(spark, folder):
    users = state.affected(_newer(spark, folder), "user_id")
    return _baseline(baselines.user_baseline(layers.fact(spark, folder), layers.USER_AS_OF, users=users))


@query
def bronze_incremental(spark, folder):
    held = layers.first_batch(spark, folder)
    arriving = layers.raw(spark, folder).filter(~layers.early())
    fresh = state.new_rows(arriving, "TransactionDate", held, "transaction_date")
    rows = state.append(held, clean.clean(fresh))
    return _double(rows.select("transaction_id", "transaction_date", "transaction_amount"), "transaction_amount")


def _upserted(spark, folder):
    return state.upsert(layers.first_batch(spark, folder), layers.second_batch(spark, folder), ["transaction_id"])


@query
def fact_upsert(spark, folder):
    return _bronze(_upserted(spark, folder))


@query
def upsert_user_baseline(spark, folder):
    held = baselines.user_baseline(layers.first_batch(spark, folder), layers.USER_AS_OF)
    users = state.affected(layers.second_batch(spark, folder), "user_id")
    refreshed = baselines.user_baseline(_upserted(spark, folder), layers.USER_AS_OF, users=users)
    return _baseline(state.upsert(held, refreshed, ["user_id"]))


def _held_kpi(spark, folder):
    """KPIs up to the middle of a day, as an earlier run would have left them."""
    return kpi.daily_kpi(layers.scored(spark, folder).filter(F.col("transaction_date") < _ntz("2024-01-16 12:00:00")))


def _refreshed_kpi(spark, folder):
    last_day = _held_kpi(spark, folder).agg(F.max("date_key")).scalar()
    return kpi.daily_kpi(layers.scored(spark, folder), since=last_day)


@query
def upsert_daily_kpi(spark, folder):
    return _kpi(state.upsert(_held_kpi(spark, folder), _refreshed_kpi(spark, folder), ["date_key"]))


@query
def daily_kpi_incremental(spark, folder):
    return _kpi(_refreshed_kpi(spark, folder))


# -- dimensions and history ------------------------------------------------

@query
def users_latest(spark, folder):
    return dims.users_latest(layers.fact(spark, folder))


@query
def devices_latest(spark, folder):
    return dims.devices_latest(layers.fact(spark, folder))


@query
def user_lifetime_dim(spark, folder):
    return dims.user_lifetime(layers.fact(spark, folder))


@query
def device_lifetime_dim(spark, folder):
    return dims.device_lifetime(layers.fact(spark, folder))


@query
def user_lifetime_incremental(spark, folder):
    held = dims.user_lifetime(layers.first_batch(spark, folder))
    return dims.refresh_lifetime(held, layers.fact(spark, folder), "user_id", dims.user_lifetime,
                                 layers.heavy(spark, folder, "user_id"))


@query
def device_lifetime_incremental(spark, folder):
    held = dims.device_lifetime(layers.first_batch(spark, folder))
    return dims.refresh_lifetime(held, layers.fact(spark, folder), "device_id", dims.device_lifetime,
                                 layers.heavy(spark, folder, "device_id"))


def _event_time(spark, folder, key, columns, source):
    return scd2.scd2_from_events(source, key, "transaction_date", columns, "transaction_id",
                                 heavy=layers.heavy(spark, folder, key))


@query
def scd2_users_event_time(spark, folder):
    source = layers.fact(spark, folder).withColumnRenamed("payment_method", "preferred_payment_method")
    return _event_time(spark, folder, "user_id", dims.USER_CHECK, source)


@query
def scd2_devices_event_time(spark, folder):
    source = layers.fact(spark, folder).withColumnRenamed("user_id", "primary_user_id")
    return _event_time(spark, folder, "device_id", dims.DEVICE_CHECK, source)


@query
def scd2_users_two_batches(spark, folder):
    return layers.two_snapshots(spark, folder, dims.users_latest, "user_id", dims.USER_CHECK)


@query
def scd2_devices_two_batches(spark, folder):
    return layers.two_snapshots(spark, folder, dims.devices_latest, "device_id", dims.DEVICE_CHECK)


@query
def users_current(spark, folder):
    return scd2.current_rows(layers.users_snapshots(spark, folder))


@query
def devices_current(spark, folder):
    return scd2.current_rows(layers.devices_snapshots(spark, folder))


def _located(spark, folder, versions):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_date", "ip_country")
    return scd2.asof_join(rows, versions, "user_id", "transaction_date", "transaction_id",
                          {"billing_country": "billing_country_at_tx_time"},
                          heavy=layers.heavy(spark, folder, "user_id")).drop("user_id")


@query
def asof_billing_country(spark, folder):
    return _located(spark, folder, layers.users_snapshots(spark, folder))


@query
def asof_billing_country_event_time(spark, folder):
    return _located(spark, folder, layers.country_versions(spark, folder))


# -- baselines -------------------------------------------------------------

@query
def user_baseline_30d(spark, folder):
    return _baseline(baselines.user_baseline(layers.fact(spark, folder), layers.USER_AS_OF))


@query
def merchant_risk_90d(spark, folder):
    """Straight from the raw rows: scan, clean, dedup, grouped aggregates."""
    # The kept copy of an id is its latest, so rows before the window can go before the dedup.
    start = trailing_window_start(layers.MERCHANT_AS_OF, baselines.MERCHANT_WINDOW_DAYS)
    rows = layers.raw(spark, folder).filter(F.col("TransactionDate") >= start)
    risk = baselines.merchant_risk(clean.clean(rows), layers.MERCHANT_AS_OF)
    return _double(_rounded(risk, 9, "fraud_rate_90d"), "avg_transaction_amount_90d")


@query
def baseline_from_partials(spark, folder):
    return _baseline(partials.baseline_from_partials(layers.user_day_partials(spark, folder), layers.USER_AS_OF))


@query
def merchant_risk_from_partials(spark, folder):
    risk = partials.merchant_risk_from_partials(layers.merchant_day_partials(spark, folder), layers.MERCHANT_AS_OF)
    return _double(_rounded(risk, 9, "fraud_rate_90d"), "avg_transaction_amount_90d")


@query
def user_baseline_point_in_time(spark, folder):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_date", "transaction_amount")
    prior = baselines.user_baseline_point_in_time(rows, heavy=layers.heavy(spark, folder, "user_id"))
    shown = prior.select("transaction_id", "prior_count", "prior_avg_amount", "prior_stddev_amount")
    return _rounded(_rounded(shown, 8, "prior_avg_amount"), 6, "prior_stddev_amount")


# -- features --------------------------------------------------------------

def _windows(spark, folder, *columns):
    rows = layers.fact(spark, folder).select(
        "transaction_id", "user_id", "device_id", "transaction_date", "location_lat", "location_lon")
    return behaviour.behaviour_windows(rows, heavy=layers.heavy(spark, folder, "user_id")).select(
        "transaction_id", *columns)


@query
def prev_transaction(spark, folder):
    return _windows(spark, folder, "prev_transaction_date", "prev_lat", "prev_lon")


@query
def velocity_1h(spark, folder):
    return _windows(spark, folder, features.velocity_1hr().alias("velocity_1hr"))


@query
def device_first_seen(spark, folder):
    return _windows(spark, folder, "device_first_seen_at")


@query
def feat_new_device(spark, folder):
    return _windows(spark, folder, features.new_device().alias("new_device_flag"))


@query
def feat_impossible_travel(spark, folder):
    return _windows(
        spark, folder, F.round(features.distance_from_prev_km(), 6).alias("distance_km"),
        F.round(features.hours_since_prev(), 9).alias("hours_since_prev"),
        features.impossible_travel().alias("impossible_travel_flag"))


def _beside_baseline(spark, folder):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_amount", "transaction_date")
    return join_salted(rows, layers.baseline(spark, folder), "user_id", "transaction_id",
                       heavy=layers.heavy(spark, folder, "user_id"))


@query
def feat_amount_zscore(spark, folder):
    return _beside_baseline(spark, folder).select(
        "transaction_id", F.round(features.amount_zscore(), 6).alias("amount_zscore"))


@query
def feat_amount_p90_ratio(spark, folder):
    return _beside_baseline(spark, folder).select(
        "transaction_id", F.round(features.amount_to_p90().cast("double"), 9).alias("device_amount_percentile"))


@query
def flag_off_hours(spark, folder):
    return _beside_baseline(spark, folder).select("transaction_id", features.off_hours().alias("off_hours_flag"))


@query
def flag_location_mismatch(spark, folder):
    return asof_billing_country_event_time(spark, folder).select(
        "transaction_id", features.location_mismatch().alias("location_mismatch_flag"))


@query
def device_risk(spark, folder):
    return _rounded(dims.device_risk(layers.fact(spark, folder), layers.USER_AS_OF), 9, "fraud_rate")


@query
def user_frequency(spark, folder):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_date")
    counted = behaviour.user_frequency(rows, heavy=layers.heavy(spark, folder, "user_id"))
    return counted.select("transaction_id", "transactions_24h", "transactions_7d")


@query
def features_full(spark, folder):
    return _features(layers.features(spark, folder))


@query
def features_point_in_time(spark, folder):
    """All eight inputs as known just before each transaction, merchant labels a week late."""
    return _features(layers.features_point_in_time(spark, folder))


@query
def features_incremental(spark, folder):
    """Rows newer than the first batch, with their users' history as context."""
    newer = _newer(spark, folder)
    history = state.history_of(layers.fact(spark, folder), state.affected(newer, "user_id"), "user_id",
                               layers.heavy(spark, folder, "user_id"))
    return _features(layers.features(spark, folder, new_ids=newer, rows=history))


@query
def features_incremental_bounded(spark, folder):
    """The same rows from state tables and the last hour instead of history."""
    fact, heavy = layers.fact(spark, folder), layers.heavy(spark, folder, "user_id")
    mark = state.watermark(layers.first_batch(spark, folder), "transaction_date").scalar()
    known, arriving = (fact.filter(F.col("transaction_date") <= mark), fact.filter(F.col("transaction_date") > mark))
    context = incremental.bounded_context(fact, arriving, incremental.user_points(known), heavy=heavy)
    return _features(features.build_features(
        context, layers.country_versions(spark, folder), layers.baseline(spark, folder), layers.risk(spark, folder),
        new_flag="_new", device_firsts=incremental.device_firsts(known), heavy_users=heavy,
        heavy_merchants=layers.heavy(spark, folder, "merchant_id")))


# -- scoring and evaluation ------------------------------------------------

@query
def score_transactions(spark, folder):
    return scoring.score(layers.features(spark, folder))


@query
def risk_tier(spark, folder):
    return layers.scored(spark, folder).groupBy(scoring.risk_tier(F.col("fraud_probability")).alias("risk_tier")).agg(
        F.count("*").alias("transactions"), F.min("fraud_probability").alias("lowest"),
        F.max("fraud_probability").alias("highest"))


@query
def eval_confusion(spark, folder):
    return evaluation.confusion(layers.scored(spark, folder))


@query
def eval_precision_recall(spark, folder):
    return _rounded(evaluation.precision_recall(layers.scored(spark, folder)), 9,
                    "precision", "recall", "fraud_amount_detected")


@query
def eval_weekly_decay(spark, folder):
    return _rounded(drift.quality_decay(layers.scored(spark, folder)), 9,
                    "precision", "recall", "fraud_amount_detected")


@query
def eval_pr_auc(spark, folder):
    return _rounded(evaluation.pr_auc(layers.scored(spark, folder)), 6, "pr_auc")


def _trained_scores(spark, folder):
    """Fit the classifier on the earlier rows, score the later ones with it; inputs as known at the time."""
    rows = training.for_model(layers.features_point_in_time(spark, folder))
    cut = _ntz("2024-01-23")
    model = training.train(rows.filter(F.col("transaction_date") < cut))
    saved = scratch(spark, "models")
    training.save_champion(model, saved)
    later = rows.filter(F.col("transaction_date") >= cut)
    return rows.filter(F.col("transaction_date") < cut), later, scoring.score(later, training.load_champion(saved))


@query
def train_and_score(spark, folder):
    """One row: rows and labels of either part, and whether the model's scores are valid and higher for fraud."""
    earlier, later, scores = _trained_scores(spark, folder)
    label = F.col("is_fraud_label")
    judged = scores.join(later.select("transaction_id", "is_fraud_label"), "transaction_id")
    quality = judged.agg(
        F.count("*").alias("scored_rows"), F.count_if(label).alias("scored_fraud"),
        F.coalesce(F.bool_and(F.col("fraud_probability").between(0, 1)), F.lit(True)).alias("all_probabilities_valid"),
        F.coalesce(F.avg(F.when(label, F.col("fraud_probability"))) > F.avg(F.when(~label, F.col("fraud_probability"))) + 0.1,
                   F.lit(False)).alias("fraud_scores_higher"))
    counts = earlier.agg(F.count("*").alias("trained_rows"), F.count_if(label).alias("trained_fraud")).first()
    return quality.select(F.lit(counts[0]).cast("long").alias("trained_rows"),
                          F.lit(counts[1]).cast("long").alias("trained_fraud"), "*")


# -- dashboard measures ----------------------------------------------------

@query
def daily_kpi(spark, folder):
    return _kpi(kpi.daily_kpi(layers.scored(spark, folder)))


@query
def exec_overview(spark, folder):
    overview = kpi.exec_overview(layers.scored(spark, folder))
    return _double(_rounded(overview, 9, "flagged_share", "fraud_rate", "model_precision"), "amount_at_risk")


@query
def flagged_trend(spark, folder):
    return _rounded(kpi.flagged_trend(layers.scored(spark, folder)), 9, "flagged_moving_avg")


@query
def tier_distribution(spark, folder):
    return _rounded(kpi.tier_distribution(layers.scored(spark, folder)), 9, "share")


def _fraud_by(spark, folder, dimension, name):
    measures = kpi.fraud_by(layers.scored(spark, folder), dimension, name)
    return _double(_rounded(measures, 9, "fraud_rate"), "flagged_amount")


@query
def fraud_by_payment_method(spark, folder):
    return _fraud_by(spark, folder, F.col("payment_method"), "payment_method")


@query
def fraud_by_device_type(spark, folder):
    return _fraud_by(spark, folder, F.col("device_type"), "device_type")


@query
def fraud_by_country(spark, folder):
    return _fraud_by(spark, folder, F.col("billing_country"), "billing_country")


@query
def fraud_by_hour(spark, folder):
    return _fraud_by(spark, folder, F.hour("transaction_date"), "hour_of_day")


@query
def kpi_grouping_sets(spark, folder):
    return _double(kpi.kpi_grouping_sets(layers.scored(spark, folder)), "flagged_amount")


@query
def score_histogram(spark, folder):
    return kpi.score_histogram(layers.scored(spark, folder))


@query
def tier_by_method_pivot(spark, folder):
    return kpi.tier_by_method(layers.scored(spark, folder))


@query
def top_flagged_users(spark, folder):
    return _double(kpi.top_flagged_users(layers.scored(spark, folder)), "flagged_amount")


@query
def top_risky_merchants(spark, folder):
    top = kpi.top_risky_merchants(layers.risk(spark, folder))
    return _rounded(top.select("merchant_id", "transaction_count_90d", "fraud_count_90d", "fraud_rate_90d"), 9,
                    "fraud_rate_90d")


@query
def user_drillthrough(spark, folder):
    rows = kpi.user_drillthrough(layers.scored(spark, folder), layers.baseline(spark, folder),
                                 heavy_users=layers.heavy(spark, folder, "user_id"))
    shown = rows.select("user_id", "transaction_id", "transaction_date", "transaction_amount", "fraud_probability",
                        "risk_tier", "avg_amount_30d", "amount_vs_avg")
    return _double(_rounded(shown, 9, "amount_vs_avg"), "transaction_amount", "avg_amount_30d")


@query
def user_behaviour_change(spark, folder):
    change = kpi.user_behaviour_change(layers.fact(spark, folder), "2024-01-31")
    return _rounded(change, 9, "amount_ratio", "volume_ratio")


# -- monitoring ------------------------------------------------------------

def _is_current() -> Column:
    return F.col("transaction_date") >= _ntz("2024-01-16")


@query
def drift_psi(spark, folder):
    return _rounded(drift.psi(layers.scored(spark, folder), drift.score_bucket(), _is_current()), 6, "psi_term")


@query
def feature_drift_psi(spark, folder):
    bucket = F.least(F.col("velocity_1hr"), F.lit(5)).cast("int")
    return _rounded(drift.psi(layers.scored(spark, folder), bucket, _is_current()), 6, "psi_term")


@query
def feature_drift_all(spark, folder):
    """The stability index of every model input."""
    buckets = {
        "amount_zscore": drift.feature_bucket("amount_zscore", 2, -3, 3),
        "velocity_1hr": drift.feature_bucket("velocity_1hr", 1, 0, 20),
        "impossible_travel_flag": drift.feature_bucket("impossible_travel_flag"),
        "new_device_flag": drift.feature_bucket("new_device_flag"),
        "device_amount_percentile": drift.feature_bucket("device_amount_percentile", 4, 0, 5),
        "off_hours_flag": drift.feature_bucket("off_hours_flag"),
        "location_mismatch_flag": drift.feature_bucket("location_mismatch_flag"),
        "merchant_risk_rate": drift.feature_bucket("merchant_risk_rate", 50, 0, 1)}
    return _rounded(drift.psi_by_feature(layers.scored(spark, folder), buckets, _is_current()), 6, "psi")


@query
def fraud_rate_drift(spark, folder):
    return _rounded(drift.fraud_rate_drift(layers.fact(spark, folder)), 9, "fraud_rate", "prior_rate", "rate_change")


@query
def data_freshness(spark, folder):
    return _rounded(drift.freshness(layers.fact(spark, folder), "payment_method", _ntz(layers.USER_AS_OF)), 9,
                    "age_hours")


# -- quality ---------------------------------------------------------------

def _rejected(spark, folder, check):
    rows = layers.raw(spark, folder).select(
        F.col("TransactionID").alias("transaction_id"), F.col("UserID").alias("user_id"),
        F.col("TransactionDate").alias("transaction_date"), F.col("TransactionAmount").alias("amount"),
        F.col("PaymentMethod").alias("payment_method"), F.col("IP_Country").alias("ip_country"),
        F.col("BillingCountry").alias("billing_country"))
    return quality.failing_rows(rows, check)


@query
def dq_not_null(spark, folder):
    return _rejected(spark, folder, quality.not_null("transaction_id")).select("user_id", "transaction_date")


@query
def dq_unique(spark, folder):
    ids = layers.raw(spark, folder).select(F.col("TransactionID").alias("transaction_id"))
    return quality.duplicates(ids, "transaction_id")


@query
def dq_accepted_values(spark, folder):
    return _rejected(spark, folder, quality.accepted_values("payment_method", PAYMENT_METHODS)).select(
        "transaction_id", "payment_method", "transaction_date")


@query
def dq_accepted_range(spark, folder):
    return _rejected(spark, folder, quality.accepted_range("amount", 0, 100)).select(
        "transaction_id", "transaction_date", "amount")


@query
def dq_expression(spark, folder):
    return _rejected(spark, folder, quality.expression("ip_country = billing_country")).select(
        "transaction_id", "transaction_date", "ip_country")


@query
def dq_relationships(spark, folder):
    return quality.orphans(layers.fact(spark, folder), "device_id", layers.first_batch(spark, folder), "device_id")


@query
def dq_report(spark, folder):
    """Every declared check of every layer table."""
    return contract_report(_layer_tables(spark, folder))


def _layer_tables(spark, folder):
    stamp = F.lit(layers.USER_AS_OF).cast("timestamp")
    scored = layers.scored(spark, folder)
    users, devices = layers.users_snapshots(spark, folder), layers.devices_snapshots(spark, folder)
    return {
        "bronze_transactions": layers.fact(spark, folder),
        "fact": layers.fact(spark, folder),
        "users_current": scd2.current_rows(users),
        "devices_current": scd2.current_rows(devices),
        "users_versions": users,
        "devices_versions": devices,
        "user_baseline": layers.baseline(spark, folder).withColumn("last_updated_at", stamp),
        "merchant_risk": layers.risk(spark, folder).withColumn("last_updated_at", stamp),
        "features": scored,
        "scores": scored,
        "daily_kpi": kpi.daily_kpi(scored),
    }


@query
def daily_run_scores(spark, folder):
    """The whole daily run over all raw rows: every layer, every check."""
    store = LayerStore(spark, scratch(spark, "daily-run"))
    run_pipeline(store, layers.raw(spark, folder), layers.USER_AS_OF)
    return spark.read.parquet(store.path("gold", "scores")).select(*SCORE_COLUMNS)


def _run_table(spark, folder, layer, name):
    return spark.read.parquet(layers.three_runs(spark, folder).path(layer, name))


@query
def daily_run_resent_far_back(spark, folder):
    """The fact after three runs, the last of which re-sends ids from long ago."""
    return _bronze(_run_table(spark, folder, "silver", "fact"))


@query
def daily_run_incremental_features(spark, folder):
    """What the features take from history, after runs with late, re-sent and moved rows."""
    return _run_table(spark, folder, "gold", "features").select(
        "transaction_id", "user_id", "velocity_1hr", "impossible_travel_flag", "new_device_flag", "location_mismatch_flag")


@query
def daily_run_baseline(spark, folder):
    return _baseline(layers.three_runs(spark, folder).read("gold", "user_baseline").drop("last_updated_at"))


@query
def daily_run_merchant_risk(spark, folder):
    risk = layers.three_runs(spark, folder).read("gold", "merchant_risk").drop("last_updated_at")
    return _double(_rounded(risk, 9, "fraud_rate_90d"), "avg_transaction_amount_90d")


@query
def daily_run_snapshots(spark, folder):
    """The open version of every user after three runs."""
    return layers.three_runs(spark, folder).read("silver", "users_current").select(
        "user_id", "billing_country", "preferred_payment_method")


@query
def daily_run_country_versions(spark, folder):
    return layers.three_runs(spark, folder).read("silver", "country_versions")


@query
def daily_run_kpi(spark, folder):
    """Rows per day and how many of them the KPIs put into a tier."""
    return layers.three_runs(spark, folder).read("gold", "daily_kpi").select(
        "date_key", "total_transactions",
        (F.col("flagged_high") + F.col("flagged_medium") + F.col("flagged_low")).alias("tiered"))


@query
def daily_run_refresh_times(spark, folder):
    """Which run last computed each user's baseline: the last whose rows or window touched it."""
    held = layers.three_runs(spark, folder).read("gold", "user_baseline")
    return held.select("user_id", F.to_date("last_updated_at").alias("refreshed_on"))


# -- heavy keys: the same results with every user cut into time slices ------

def _all_heavy(spark, folder):
    return heavy_keys_by(layers.fact(spark, folder), ["user_id"], min_rows=1)["user_id"]


@query
def velocity_1h_sliced(spark, folder):
    rows = layers.fact(spark, folder).select(
        "transaction_id", "user_id", "device_id", "transaction_date", "location_lat", "location_lon")
    windows = behaviour.behaviour_windows(rows, heavy=_all_heavy(spark, folder))
    return windows.select("transaction_id", features.velocity_1hr().alias("velocity_1hr"))


@query
def user_frequency_sliced(spark, folder):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_date")
    counted = behaviour.user_frequency(rows, heavy=_all_heavy(spark, folder))
    return counted.select("transaction_id", "transactions_24h", "transactions_7d")


@query
def scd2_sliced(spark, folder):
    source = layers.fact(spark, folder).withColumnRenamed("payment_method", "preferred_payment_method")
    return scd2.scd2_from_events(source, "user_id", "transaction_date", dims.USER_CHECK, "transaction_id",
                                 heavy=_all_heavy(spark, folder))


@query
def asof_sliced(spark, folder):
    rows = layers.fact(spark, folder).select("transaction_id", "user_id", "transaction_date", "ip_country")
    return scd2.asof_join(rows, layers.country_versions(spark, folder), "user_id", "transaction_date", "transaction_id",
                          {"billing_country": "billing_country_at_tx_time"},
                          heavy=_all_heavy(spark, folder)).drop("user_id")


@query
def features_full_sliced(spark, folder):
    return _features(features.build_features(
        layers.fact(spark, folder), layers.country_versions(spark, folder), layers.baseline(spark, folder),
        layers.risk(spark, folder), heavy_users=_all_heavy(spark, folder)))


# -- streaming -------------------------------------------------------------

@query
def stream_bronze_dedup(spark, folder):
    """Ids of raw rows that arrive in several files, their copies in different ones."""
    arrived = layers.arriving(spark, folder, layer=layers.raw)
    return streams.run_deduplicated(arrived, scratch(spark, "stream-dedup")).select("transaction_id")


@query
def stream_velocity_sliding(spark, folder):
    table = streams.run_sliding_velocity(layers.arriving(spark, folder), scratch(spark, "stream-velocity"))
    return table.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query
def stream_burst_sessions(spark, folder):
    """Sessions of rows that arrive in several files, those still open at the end too."""
    table = streams.run_burst_sessions(layers.arriving(spark, folder), scratch(spark, "stream-sessions"))
    return table.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


@query
def stream_daily_kpi(spark, folder):
    scored = layers.arriving(spark, folder, layer=layers.scored)
    return _kpi(streams.run_daily_kpi(scored, scratch(spark, "stream-kpi")))


@query
def stream_scored_alerts(spark, folder):
    """Alerts of rows that arrive in several files, not in the order of their time."""
    shuffled = layers.arriving(spark, folder)
    return streams.run_scored_alerts(
        shuffled, scratch(spark, "stream-alerts"), layers.country_versions(spark, folder),
        layers.baseline(spark, folder), layers.risk(spark, folder))


@query
def stream_velocity_exact(spark, folder):
    """Each transaction's others of the hour before it, from the same stream."""
    return streams.run_features(
        layers.arriving(spark, folder), scratch(spark, "stream-features"), layers.country_versions(spark, folder),
        layers.baseline(spark, folder), layers.risk(spark, folder)).select("transaction_id", "velocity_1hr")
