"""Feature rows as they could be known just before each transaction.

For training and for replaying decisions: no input looks at the row itself, at
later rows, or at labels that had not arrived yet. All moving measures are sums
of signed moves on the time line (a row enters at its time and leaves when the
window has passed it), so their cost does not depend on how many rows a window
holds, and a key with a third of all rows is cut into time slices.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from txnrisk.operators import features
from txnrisk.operators.baselines import MERCHANT_WINDOW_DAYS, USER_WINDOW_DAYS
from txnrisk.operators.behaviour import behaviour_windows
from txnrisk.operators.scd2 import asof_join
from txnrisk.operators.skew import sums_before
from txnrisk.schemas import FEATURE_COLUMNS

# A label is known so many days after its transaction, unless the caller says otherwise.
LABEL_DELAY_DAYS = 7
# Bits of a value settled per pass of the quantile.
DIGIT_BITS = 4


def _moves(rows: DataFrame, ts: str, window: timedelta, delay: timedelta = timedelta(0)) -> DataFrame:
    """Every row twice: entering the window (``_sign`` 1) and leaving it (-1)."""
    entering = rows.withColumn("_sign", F.lit(1)).withColumn("_at", F.col(ts) + F.lit(delay))
    leaving = rows.withColumn("_sign", F.lit(-1)).withColumn("_at", F.col(ts) + F.lit(delay + window))
    return entering.unionByName(leaving).drop(ts)


def _signed(value: Column) -> Column:
    return F.when(F.col("_sign") > 0, value).otherwise(-value)


def sliding_quantile(rows: DataFrame, key: str, ts: str, row_id: str, value: str, window: timedelta, *,
                     share: tuple[int, int] = (9, 10), heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Per row, the quantile ``share`` of the key's values in [t - window, t): columns ``row_id`` and ``quantile``.

    The quantile is the smallest value that the share of the rows does not
    exceed, exact. ``value`` names a whole-number column; NULL values do not
    count. Rows without a key, or with nothing in their window, are left out.
    It is found digit by digit, all rows at once: a pass counts how many values
    of the window go on with each next digit of the value found so far, and the
    rank picks the digit. A pass is one shuffle by (key, digits so far) of
    narrow rows; their number follows from the range of the values.
    """
    low, high = rows.agg(F.min(value), F.max(value)).first()
    low, width = low or 0, ((high or 0) - (low or 0)).bit_length()
    rows = rows.filter(F.col(key).isNotNull())
    points = rows.filter(F.col(value).isNotNull()).select(key, ts, (F.col(value).cast("long") - low).alias("_value"))
    moves = _moves(points, ts, window)
    asking = rows.select(row_id, key, F.col(ts).alias("_at"), F.lit(0).cast("long").alias("_prefix"),
                         F.lit(None).cast("long").alias("_rank"))
    top, counts = (1 << DIGIT_BITS) - 1, [f"_upto_{d}" for d in range(1 << DIGIT_BITS)]
    passes = max(1, -(-width // DIGIT_BITS))
    for level in reversed(range(passes)):
        digits = moves.select(
            key, "_at", "_sign", F.shiftright("_value", DIGIT_BITS * (level + 1)).alias("_prefix"),
            F.shiftright("_value", DIGIT_BITS * level).bitwiseAND(top).cast("int").alias("_digit"))
        measures = {name: F.when(F.col("_digit") <= d, F.col("_sign")) for d, name in enumerate(counts)}
        # After the first pass few of a key's prefixes are asked for.
        counted = sums_before(asking, digits, [key, "_prefix"], "_at", measures, heavy=heavy, hours=hours,
                              sparse=level < passes - 1)
        if level == passes - 1:
            counted = (counted.filter(F.col(counts[top]) > 0)
                       .withColumn("_rank", F.expr(f"({counts[top]} * {share[0]} + {share[1] - 1}) div {share[1]}")))
        below = [F.col(name) < F.col("_rank") for name in counts[:top]]
        digit = sum((b.cast("long") for b in below), F.lit(0).cast("long"))
        passed = F.greatest(F.lit(0).cast("long"), *[F.when(b, F.col(name)) for b, name in zip(below, counts)])
        asking = counted.select(row_id, key, "_at", (F.col("_prefix") * (1 << DIGIT_BITS) + digit).alias("_prefix"),
                                (F.col("_rank") - passed).alias("_rank"))
        if heavy:  # a sliced pass reads its input twice
            asking = asking.checkpoint()
    return asking.select(row_id, (F.col("_prefix") + low).alias("quantile"))


def prior_baseline(rows: DataFrame, days: int = USER_WINDOW_DAYS, *, heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """``rows`` with the user's baseline over the ``days`` before each of them, itself left out.

    Adds ``avg_amount_30d``, ``stddev_amount_30d``, ``p90_amount_30d``,
    ``earliest_active_hour``, ``latest_active_hour`` and
    ``transaction_count_30d`` as ``user_baseline`` defines them; a user's first
    row has NULLs and 0, and so has a row without a user.
    """
    window, amount = timedelta(days=days), F.col("_amount")
    active = [f"_hour_{h}" for h in range(24)]
    of_user = rows.filter(F.col("user_id").isNotNull())
    moves = _moves(of_user.select("user_id", "transaction_date", F.col("transaction_amount").alias("_amount"),
                                  F.hour("transaction_date").alias("_hour")), "transaction_date", window)
    measures = {"transaction_count_30d": F.col("_sign").cast("long"),
                "_n": F.when(amount.isNotNull(), F.col("_sign")).cast("long"),
                "_total": _signed(amount), "_squares": _signed(amount * amount),
                **{name: F.when(F.col("_hour") == h, F.col("_sign")) for h, name in enumerate(active)}}
    moves = moves.withColumnRenamed("_at", "transaction_date")
    summed = sums_before(rows, moves, "user_id", "transaction_date", measures, heavy=heavy, hours=hours)

    n, total = F.col("_n"), F.col("_total").cast("decimal(22,2)")
    spread = (n.cast("decimal(12,0)") * F.col("_squares").cast("decimal(32,4)") - total * total).cast("double")
    hours_used = [F.when(F.col(name) > 0, F.lit(h)) for h, name in enumerate(active)]
    described = summed.withColumns({
        "avg_amount_30d": F.when(n > 0, total / n).cast("decimal(16,6)"),
        "stddev_amount_30d": F.when(n > 1, F.sqrt(spread / (n * (n - 1)).cast("double"))),
        "earliest_active_hour": F.least(*hours_used), "latest_active_hour": F.greatest(*hours_used),
    }).drop("_n", "_total", "_squares", *active)
    cents = rows.select("transaction_id", "user_id", "transaction_date",
                        (F.col("transaction_amount") * 100).cast("long").alias("_cents"))
    ninetieth = sliding_quantile(cents, "user_id", "transaction_date", "transaction_id", "_cents", window,
                                 heavy=heavy, hours=hours)
    p90 = (F.col("quantile") / F.lit(100).cast("decimal(3,0)")).cast("decimal(18,2)")
    return described.join(ninetieth.select("transaction_id", p90.alias("p90_amount_30d")), "transaction_id", "left")


def prior_merchant_rate(rows: DataFrame, days: int = MERCHANT_WINDOW_DAYS, label_delay: int = LABEL_DELAY_DAYS, *,
                        labels: DataFrame | None = None, heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """``rows`` with ``merchant_risk_rate``: frauds among the merchant's rows whose labels were known.

    A label arrives ``label_delay`` days after its transaction; the rate counts
    those that arrived in the ``days`` before the row. NULL where none had.
    ``labels`` holds the labelled transactions, ``rows`` themselves if not given.
    """
    labels = rows if labels is None else labels
    known = labels.filter(F.col("merchant_id").isNotNull()).select(
        "merchant_id", "transaction_date", F.col("is_fraud_label").alias("_fraud"))
    moves = _moves(known, "transaction_date", timedelta(days=days), timedelta(days=label_delay))
    measures = {"_n": F.col("_sign").cast("long"), "_frauds": F.when(F.col("_fraud"), F.col("_sign")).cast("long")}
    summed = sums_before(rows, moves.withColumnRenamed("_at", "transaction_date"), "merchant_id", "transaction_date",
                         measures, heavy=heavy, hours=hours)
    rate = F.when(F.col("_n") > 0, (F.col("_frauds") / F.col("_n")).cast("double"))
    return summed.withColumn("merchant_risk_rate", rate).drop("_n", "_frauds")


def features_point_in_time(fact: DataFrame, versions: DataFrame, *, label_delay: int = LABEL_DELAY_DAYS,
                           keep: Sequence[str] = (), heavy_users: Sequence = (), heavy_merchants: Sequence = (),
                           hours: int = 1, speed_kmh: float = features.IMPOSSIBLE_SPEED_KMH) -> DataFrame:
    """The feature table with all eight inputs as known just before each transaction.

    Same columns as ``build_features``. Velocity, travel, first use of a device
    and the country as of the transaction look back by definition; baseline and
    merchant rate are those of ``prior_baseline`` and ``prior_merchant_rate``.
    """
    needed = ["transaction_id", "user_id", "merchant_id", "device_id", "transaction_amount", "transaction_date",
              "location_lat", "location_lon", "ip_country", "is_fraud_label"]
    rows = fact.select(*needed, *[c for c in keep if c not in needed])
    located = asof_join(rows, versions, "user_id", "transaction_date", "transaction_id",
                        {"billing_country": "billing_country_at_tx_time"}, heavy=heavy_users, hours=hours)
    context = behaviour_windows(located, heavy=heavy_users, hours=hours)
    measured = prior_baseline(context, heavy=heavy_users, hours=hours).withColumns({
        "amount_zscore": features.amount_zscore(), "velocity_1hr": features.velocity_1hr(),
        "impossible_travel_flag": features.impossible_travel(speed_kmh), "new_device_flag": features.new_device(),
        "device_amount_percentile": features.amount_to_p90(), "off_hours_flag": features.off_hours(),
        "location_mismatch_flag": features.location_mismatch()})
    ids = ["transaction_id", "user_id", "merchant_id"]
    given = [*FEATURE_COLUMNS, "is_fraud_label", "transaction_date"]
    extra = [c for c in keep if c not in (*ids, *given)]
    narrow = measured.select(*ids, *[c for c in given if c != "merchant_risk_rate"], *extra)
    # Labels come from the fact, so that the windows above are not computed a second time for them.
    rated = prior_merchant_rate(narrow, label_delay=label_delay, labels=fact, heavy=heavy_merchants, hours=hours)
    return rated.select(*ids, *given, *extra)
