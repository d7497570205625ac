"""The feature table: one row per transaction, eight model inputs and the label."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from txnrisk.functions.geo import haversine_km
from txnrisk.functions.timing import whole_seconds_between
from txnrisk.operators.behaviour import plain_windows, sliced_windows
from txnrisk.operators.scd2 import asof_join
from txnrisk.operators.skew import join_salted, split_heavy
from txnrisk.schemas import FEATURE_COLUMNS

# Fixed value: faster than an airliner.
IMPOSSIBLE_SPEED_KMH = 900.0


def _flag(condition: Column) -> Column:
    """1 when true; 0 when false or unknown."""
    return F.when(condition, 1).otherwise(0)


def amount_zscore() -> Column:
    return ((F.col("transaction_amount") - F.col("avg_amount_30d")).cast("double")
            / F.nullif(F.col("stddev_amount_30d"), F.lit(0.0)))


def velocity_1hr() -> Column:
    return F.greatest(F.col("velocity_1hr_inclusive") - 1, F.lit(0))


def distance_from_prev_km() -> Column:
    return haversine_km(F.col("prev_lat"), F.col("prev_lon"), F.col("location_lat"), F.col("location_lon"))


def hours_since_prev() -> Column:
    """At least one second, so two rows of the same second have a speed."""
    seconds = whole_seconds_between(F.col("transaction_date"), F.col("prev_transaction_date"))
    return F.when(F.col("prev_transaction_date").isNotNull(), F.greatest(seconds, F.lit(1)) / F.lit(3600.0))


def impossible_travel(speed_kmh: float = IMPOSSIBLE_SPEED_KMH) -> Column:
    return _flag(distance_from_prev_km() / hours_since_prev() > speed_kmh)


def new_device() -> Column:
    return _flag(F.col("transaction_date") == F.col("device_first_seen_at"))


def amount_to_p90() -> Column:
    return F.col("transaction_amount") / F.nullif(F.col("p90_amount_30d"), F.lit(0))


def off_hours() -> Column:
    return _flag(~F.hour("transaction_date").between(F.col("earliest_active_hour"), F.col("latest_active_hour")))


def location_mismatch() -> Column:
    return _flag(F.col("ip_country") != F.col("billing_country_at_tx_time"))


def _new_rows(context: DataFrame, new_ids: DataFrame | None, new_flag: str | None) -> DataFrame:
    if new_flag is not None:
        context = context.filter(F.col(new_flag)).drop(new_flag)
    if new_ids is not None:
        context = context.join(new_ids.select("transaction_id"), "transaction_id", "left_semi")
    return context


def _earlier_devices(context: DataFrame, device_firsts: DataFrame | None) -> DataFrame:
    if device_firsts is None:
        return context
    known = device_firsts.select("user_id", "device_id", "first_seen_at")
    return (context.join(known, ["user_id", "device_id"], "left")
            .withColumn("device_first_seen_at", F.least("first_seen_at", "device_first_seen_at"))
            .drop("first_seen_at"))


def build_features(fact: DataFrame, versions: DataFrame, baseline: DataFrame, risk: DataFrame, *,
                   new_ids: DataFrame | None = None, new_flag: str | None = None,
                   device_firsts: DataFrame | None = None, keep: Sequence[str] = (), heavy_users: Sequence = (),
                   heavy_merchants: Sequence = (), speed_kmh: float = IMPOSSIBLE_SPEED_KMH) -> DataFrame:
    """Feature rows for ``fact``, or for its new rows with the rest as context.

    The new rows are those with an id in ``new_ids``, or those whose boolean
    column ``new_flag`` is true, which needs no shuffle by id.
    ``device_firsts`` adds first uses of devices that lie before ``fact``.
    ``keep`` names fact columns to carry along, which spares consumers a join
    back on transaction_id. Ordinary users' transactions, versions and baseline
    meet on one partitioning by user; heavy users go through the sliced windows
    and meet their baseline, one row per user, in a broadcast. The merchant
    side is small and left to AQE.
    """
    needed = {"transaction_id", "user_id", "merchant_id", "device_id", "transaction_amount", "transaction_date",
              "location_lat", "location_lon", "ip_country", "is_fraud_label", new_flag, *keep}
    measures = baseline.select("user_id", "avg_amount_30d", "stddev_amount_30d", "p90_amount_30d",
                               "earliest_active_hour", "latest_active_hour")
    rates = risk.select("merchant_id", F.col("fraud_rate_90d").alias("merchant_risk_rate"))
    passed = ["transaction_id", "user_id", "merchant_id", *[c for c in FEATURE_COLUMNS if c != "merchant_risk_rate"],
              "is_fraud_label", "transaction_date"]
    passed += [c for c in keep if c not in passed]
    hot = F.col("user_id").isin(list(heavy_users))

    def located(rows: DataFrame, spans: DataFrame, heavy: Sequence) -> DataFrame:
        return asof_join(rows, spans, "user_id", "transaction_date", "transaction_id",
                         {"billing_country": "billing_country_at_tx_time"}, heavy=heavy)

    def finished(context: DataFrame, beside: DataFrame) -> DataFrame:
        chosen = _earlier_devices(_new_rows(context, new_ids, new_flag), device_firsts)
        # Evaluated before the merchant shuffle, so that it moves narrow rows.
        return chosen.join(beside, "user_id", "left").withColumns({
            "amount_zscore": amount_zscore(), "velocity_1hr": velocity_1hr(),
            "impossible_travel_flag": impossible_travel(speed_kmh), "new_device_flag": new_device(),
            "device_amount_percentile": amount_to_p90(), "off_hours_flag": off_hours(),
            "location_mismatch_flag": location_mismatch(),
        }).select(*passed)

    def plain(rows: DataFrame) -> DataFrame:
        spans = versions.filter(~hot) if heavy_users else versions
        return finished(plain_windows(located(rows, spans, ())), measures)

    def sliced(rows: DataFrame) -> DataFrame:
        context = sliced_windows(located(rows, versions.filter(hot), heavy_users))
        # At most one row per heavy user, and their list is bounded.
        return finished(context, F.broadcast(measures.filter(hot)))

    computed = split_heavy(fact.select(*[c for c in fact.columns if c in needed]), "user_id", heavy_users, plain, sliced)
    rated = join_salted(computed, rates, "merchant_id", "transaction_id", heavy=heavy_merchants)
    ordered = ["transaction_id", "user_id", "merchant_id", *FEATURE_COLUMNS, "is_fraud_label", "transaction_date"]
    return rated.select(*ordered, *[c for c in keep if c not in ordered])
