"""Daily refresh of features without reading every user's whole history.

Two small state tables stand in for the history: the last point of each user
and the first use of each (user, device). A user whose new rows all come after
the last point needs, besides that point, only the rows of the velocity window
before the batch, which partition pruning by day reaches directly. A user with
late or re-sent rows is recomputed from the whole history.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, functions as F

from txnrisk.operators.behaviour import HOUR
from txnrisk.operators.scd2 import scd2_from_events
from txnrisk.operators.skew import join_salted
from txnrisk.schemas import SCD_ID, VALID_FROM, VALID_TO

_POINT = ["transaction_date", "transaction_id", "location_lat", "location_lon"]


def user_points(rows: DataFrame) -> DataFrame:
    """Last point per user. Also merges points: their union has their shape."""
    return (rows.filter(F.col("user_id").isNotNull()).groupBy("user_id")
            .agg(F.max(F.struct(*_POINT)).alias("_last")).select("user_id", "_last.*"))


def device_firsts(rows: DataFrame, ts: str = "transaction_date") -> DataFrame:
    """First use per (user, device)."""
    return rows.groupBy("user_id", "device_id").agg(F.min(ts).alias("first_seen_at"))


def late_users(batch: DataFrame, points: DataFrame, resent: DataFrame | None = None) -> DataFrame:
    """Users of the batch with a row not after their last point, and those of
    ``resent``, rows the batch replaced."""
    first_new = batch.groupBy("user_id").agg(F.min("transaction_date").alias("_first"))
    last = points.select("user_id", F.col("transaction_date").alias("_last"))
    late = first_new.join(last, "user_id").filter(F.col("_first") <= F.col("_last")).select("user_id")
    return late if resent is None else late.union(resent.select("user_id")).distinct()


def bounded_context(fact: DataFrame, batch: DataFrame, points: DataFrame, *, velocity: timedelta = HOUR,
                    heavy: Sequence = ()) -> DataFrame:
    """The rows the in-order users of ``batch`` need, with ``_new`` marking theirs.

    ``fact`` already holds the batch; ``points`` is the state before it.
    """
    start = batch.agg(F.min("transaction_date") - F.lit(velocity)).scalar()
    recent = fact.filter(F.col("transaction_date") >= start)
    if "event_date" in fact.columns:
        recent = recent.filter(F.col("event_date") >= F.to_date(start)).drop("event_date")
    last = points.select("user_id", F.struct(*_POINT).alias("_last"))
    users = batch.select("user_id").distinct().join(last, "user_id", "left")
    rows = join_salted(recent, users, "user_id", "transaction_id", heavy=heavy, how="inner")
    marked = rows.withColumn(
        "_new", F.col("_last").isNull() | (F.col("transaction_date") > F.col("_last.transaction_date"))).drop("_last")
    # A last point further back than the window only supplies the previous
    # place and time; a nearer one is among the recent rows already.
    earlier = (users.filter(F.col("_last.transaction_date") < start)
               .select("user_id", "_last.*", F.lit(False).alias("_new")))
    return marked.unionByName(earlier, allowMissingColumns=True)


def extend_versions(versions: DataFrame, batch: DataFrame, key: str, ts: str, check_cols: Sequence[str], tie: str, *,
                    heavy: Sequence = ()) -> DataFrame:
    """Event-time versions after in-order rows: the open version of each key
    takes part as the row that opened it."""
    is_open = F.col(VALID_TO).isNull()
    opening = versions.filter(is_open).select(
        key, F.col(VALID_FROM).alias(ts), F.lit("").alias(tie), *check_cols)
    rows = batch.select(key, ts, tie, *check_cols).unionByName(opening)
    extended = scd2_from_events(rows, key, ts, check_cols, tie, heavy=heavy)
    return versions.filter(~is_open).select(SCD_ID, key, *check_cols, VALID_FROM, VALID_TO).unionByName(extended)
