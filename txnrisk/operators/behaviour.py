"""Per-user event-time context: previous point, velocity, first use of a device."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, Window, functions as F

from txnrisk.functions.timing import slice_index
from txnrisk.operators.skew import split_heavy, trailing_totals

HOUR = timedelta(hours=1)


def behaviour_windows(fact: DataFrame, *, velocity: timedelta = HOUR, heavy: Sequence = (),
                      hours: int = 1) -> DataFrame:
    """Add prev_transaction_date, prev_lat, prev_lon, velocity_1hr_inclusive
    and device_first_seen_at.

    Ordinary users need one shuffle on user_id for all of it. Heavy users run
    through the sliced form of the same windows.
    """
    return split_heavy(fact, "user_id", heavy, lambda rows: plain_windows(rows, velocity),
                       lambda rows: sliced_windows(rows, velocity, hours))


def plain_windows(fact: DataFrame, velocity: timedelta = HOUR) -> DataFrame:
    by_user = Window.partitionBy("user_id").orderBy("transaction_date", "transaction_id")
    seconds = int(velocity.total_seconds())
    in_window = F.expr(
        "count(*) over (partition by user_id order by transaction_date "
        f"range between interval {seconds} second preceding and current row)")
    return fact.withColumns({
        "prev_transaction_date": F.lag("transaction_date").over(by_user),
        "prev_lat": F.lag("location_lat").over(by_user),
        "prev_lon": F.lag("location_lon").over(by_user),
        "velocity_1hr_inclusive": in_window,
        "device_first_seen_at": F.min("transaction_date").over(Window.partitionBy("user_id", "device_id")),
    })


def sliced_windows(fact: DataFrame, velocity: timedelta = HOUR, hours: int = 1) -> DataFrame:
    """The same columns, every user cut into time slices.

    One shuffle by (user, slice) brings together a slice's rows, the rows
    leaving the velocity window in it, and what earlier slices know: one row
    with the running counts and the last point, and one per device first seen
    before.
    """
    ts, date_type = "transaction_date", fact.schema["transaction_date"].dataType
    point = F.struct(F.col(ts).alias("at"), F.col("transaction_id").alias("id"),
                     F.col("location_lat").alias("lat"), F.col("location_lon").alias("lon"))
    rows = fact.withColumns({
        "_at": F.col(ts), "_point": point, "_in": F.lit(1), "_first": F.col(ts),
        "_slice": slice_index(F.col(ts), hours)})
    leaving = fact.select("user_id", (F.col(ts) + F.lit(velocity)).alias("_at"), F.lit(1).alias("_out"))
    leaving = leaving.withColumn("_slice", slice_index(F.col("_at"), hours))

    # Carried rows sort before everything else of their slice.
    origin = F.lit("0001-01-01").cast(date_type).alias("_at")
    edges = (rows.select("user_id", "_slice", "_in", "_point").unionByName(leaving.drop("_at"), allowMissingColumns=True)
             .groupBy("user_id", "_slice")
             .agg(F.sum("_in").alias("_in"), F.sum("_out").alias("_out"), F.max("_point").alias("_point")))
    before = Window.partitionBy("user_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    known = edges.select(
        "user_id", "_slice", origin, F.sum("_in").over(before).alias("_in"), F.sum("_out").over(before).alias("_out"),
        F.last("_point", ignorenulls=True).over(before).alias("_point"))
    used = rows.groupBy("user_id", "device_id", "_slice").agg(F.min(ts).alias("_in_slice"))
    devices = (used.withColumn("_first", F.min("_in_slice").over(Window.partitionBy("user_id", "device_id")))
               .filter(F.col("_first") < F.col("_in_slice"))
               .select("user_id", "device_id", "_slice", origin, "_first"))

    merged = rows
    for extra in (leaving, known, devices):
        merged = merged.unionByName(extra, allowMissingColumns=True)
    in_order = Window.partitionBy("user_id", "_slice").orderBy("_at", "transaction_id")
    earlier = in_order.rowsBetween(Window.unboundedPreceding, -1)
    window = "over (partition by user_id, _slice order by _at range between unbounded preceding and "
    entered, left = f"{window} current row)", f"{window} interval '0 00:00:00.000001' day to second preceding)"
    seen = merged.withColumns({
        "_prev": F.last("_point", ignorenulls=True).over(earlier),
        "velocity_1hr_inclusive": F.expr(f"sum(_in) {entered} - coalesce(sum(_out) {left}, 0)"),
        "device_first_seen_at": F.min("_first").over(Window.partitionBy("user_id", "_slice", "device_id")),
    }).filter(F.col("_point").isNotNull() & F.col("_first").isNotNull())
    return seen.select(
        *fact.columns, F.col("_prev.at").alias("prev_transaction_date"), F.col("_prev.lat").alias("prev_lat"),
        F.col("_prev.lon").alias("prev_lon"), "velocity_1hr_inclusive", "device_first_seen_at")


def user_frequency(fact: DataFrame, *, heavy: Sequence = (), hours: int = 1) -> DataFrame:
    """Transactions of the user in the last 24 hours and 7 days, this one included."""
    windows = {"24h": timedelta(hours=24), "7d": timedelta(days=7)}
    return trailing_totals(
        fact, "user_id", "transaction_date", windows, {"transactions": F.lit(1).cast("long")},
        heavy=heavy, hours=hours)
