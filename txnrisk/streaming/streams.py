"""Streaming forms of ingest, velocity, sessions, KPIs and alerts.

Every transformation maps a streaming DataFrame to a streaming DataFrame; the
``run_*`` functions write one to a table folder until the input is used up.
Event time must be a zoned timestamp for a watermark, so :func:`zoned` casts.

The transformations alone forget rows that come more than ``LATENESS`` behind
the newest. ``run_deduplicated``, ``run_sliding_velocity``, ``run_burst_sessions``
and ``run_daily_kpi`` do not: each micro-batch is written under its number, a
repeated one replaces itself, and the result is that of all rows that arrived,
in whatever order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import DateType, LongType, StructField, StructType

from txnrisk.operators.clean import deduplicate, typed
from txnrisk.operators.features import build_features
from txnrisk.operators.incremental import bounded_context, device_firsts, user_points
from txnrisk.operators.scoring import LogisticScorer, with_scores
from txnrisk.operators.state import with_event_date, write_table
from txnrisk.schemas import RAW_SCHEMA
from txnrisk.sources.tables import LayerStore

# Fixed values of the hot path.
SESSION_GAP = "10 minutes"
LATENESS = "1 hour"
# Rows so far behind the newest of their micro-batch are corrected from the days kept at hand.
HORIZON = timedelta(days=1)
# Windows of all users that one task counts, about.
GROUPS = 1_000_000


def event_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """The ``events`` files of a folder as they arrive."""
    reader = (spark.readStream.option("pathGlobFilter", "events*.parquet")
              .schema("event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def bus_stream(spark: SparkSession, **options: str) -> DataFrame:
    """Raw transactions from a Kafka topic (needs the connector on the class
    path); ``options`` are the reader's, such as ``subscribe``."""
    return parse_messages(spark.readStream.format("kafka").options(**options).load())


def parse_messages(messages: DataFrame) -> DataFrame:
    """Landed columns from messages whose ``value`` is one JSON transaction."""
    parsed = F.from_json(F.col("value").cast("string"), RAW_SCHEMA)
    return messages.select(parsed.alias("row")).select("row.*")


def csv_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Daily CSV files as they arrive; the checkpoint is the load ledger."""
    reader = (spark.readStream.schema(RAW_SCHEMA).option("header", True).option("enforceSchema", False)
              .option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv"))
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.csv(folder)


def zoned(stream: DataFrame, ts: str = "transaction_date") -> DataFrame:
    return stream.withColumn(ts, F.col(ts).cast("timestamp"))


def deduplicated(raw: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """Typed rows, one per id among copies that arrive within ``lateness``.

    Keeps the copy that arrives first, where the batch form keeps the latest:
    a stream cannot take back what it emitted.
    """
    rows = zoned(typed(raw).filter(F.col("transaction_id").isNotNull()))
    return rows.withWatermark("transaction_date", lateness).dropDuplicatesWithinWatermark(["transaction_id"])


def sliding_velocity(transactions: DataFrame, width: str = "1 hour", slide: str = "5 minutes",
                     lateness: str = LATENESS) -> DataFrame:
    """Transactions per user in sliding windows."""
    return (zoned(transactions).withWatermark("transaction_date", lateness)
            .groupBy("user_id", F.window("transaction_date", width, slide))
            .agg(F.count("*").alias("transactions"))
            .select("user_id", F.col("window.start").alias("window_start"), "transactions"))


def burst_sessions(transactions: DataFrame, gap: str = SESSION_GAP, at_least: int = 2,
                   lateness: str = LATENESS) -> DataFrame:
    """Runs of a user's transactions no more than ``gap`` apart, once closed."""
    return (zoned(transactions).withWatermark("transaction_date", lateness)
            .groupBy("user_id", F.session_window("transaction_date", gap))
            .agg(F.count("*").alias("transactions"), F.count_if("is_fraud_label").alias("fraud"))
            .filter(F.col("transactions") >= at_least)
            .select("user_id", F.col("session_window.start").alias("session_start"),
                    F.col("session_window.end").alias("session_end"), "transactions", "fraud"))


def daily_kpi(scored: DataFrame, lateness: str = LATENESS) -> DataFrame:
    """The daily measures over tumbling one-day windows."""
    return (zoned(scored).withWatermark("transaction_date", lateness)
            .groupBy(F.window("transaction_date", "1 day"))
            .agg(F.count("*").alias("total_transactions"),
                 F.count_if(F.col("risk_tier") == "High").alias("flagged_high"),
                 F.count_if(F.col("risk_tier") == "Medium").alias("flagged_medium"),
                 F.count_if(F.col("risk_tier") == "Low").alias("flagged_low"),
                 F.avg("fraud_probability").alias("avg_fraud_probability"))
            .select(F.to_date("window.start").alias("date_key"), "total_transactions", "flagged_high",
                    "flagged_medium", "flagged_low", "avg_fraud_probability"))


def run_features(transactions: DataFrame, path: str, versions: DataFrame, baseline: DataFrame, risk: DataFrame, *,
                 horizon: timedelta = HORIZON, heavy: Sequence = ()) -> DataFrame:
    """All eight model inputs of every transaction that arrives; returns the table of them.

    A micro-batch costs what it and the last ``horizon`` hold, not what ever
    arrived: rows are kept by day, and each user's last point and first device
    uses in tables whose buckets of the batch's users alone are opened. A late
    row corrects the rows after it: within the horizon from the kept days, and
    a user with an older one is computed again from all rows that arrived. No
    row is too late; a row without a user has no history and is left out. A
    repeated micro-batch replaces itself, the latest one to hold a transaction
    counts.
    """
    schema, spark = transactions.drop("event_date").schema, transactions.sparkSession
    by_day = StructType([*schema.fields, StructField("batch_id", LongType()), StructField("event_date", DateType())])
    store = LayerStore(spark, f"{path}/kept")

    def kept(name: str, keys: DataFrame, empty: DataFrame) -> DataFrame:
        held = store.read("state", name, keys)
        return empty.limit(0) if held is None else held

    def handle(batch: DataFrame, batch_id: int) -> None:
        folder = f"{path}/rows/batch_id={batch_id}"
        with_event_date(batch.drop("event_date")).write.mode("overwrite").partitionBy("event_date").parquet(folder)
        rows = spark.read.schema(schema).parquet(folder)
        arrived = (spark.read.schema(by_day).option("basePath", f"{path}/rows").parquet(f"{path}/rows")
                   .filter(F.col("batch_id") <= batch_id).drop("batch_id"))
        users = rows.select("user_id").distinct()
        points = kept("user_points", users, user_points(rows))
        firsts = kept("device_firsts", users, device_firsts(rows))
        first = write_table(_ways(rows, points, horizon), f"{path}/first/batch_id={batch_id}")
        newest = rows.agg(F.max("transaction_date")).scalar()
        recent = arrived.filter(F.col("event_date") >= F.to_date(newest - F.lit(2 * horizon))).drop("event_date")

        def of(way: str) -> DataFrame:
            return first.filter(F.col("way") == way).select("user_id", "first_new")

        late = recent.join(of("late"), "user_id")
        # Whoever has a row before the late one in the kept days needs nothing older.
        reached = write_table(late.filter(F.col("transaction_date") < F.col("first_new")).select("user_id").distinct(),
                              f"{path}/reached/batch_id={batch_id}")
        again = write_table(of("old").unionByName(of("late").join(reached, "user_id", "left_anti")),
                            f"{path}/again/batch_id={batch_id}")

        def since(context: DataFrame, users: DataFrame, **state: DataFrame) -> DataFrame:
            inputs = build_features(context, versions, baseline, risk, heavy_users=heavy, **state)
            return inputs.join(users, "user_id").filter(F.col("transaction_date") >= F.col("first_new")).drop("first_new")

        in_order = rows.join(of("in order"), "user_id", "left_semi")
        parts = [build_features(bounded_context(arrived, in_order, points, heavy=heavy), versions, baseline, risk,
                                new_flag="_new", device_firsts=firsts, heavy_users=heavy),
                 since(late.drop("first_new").join(reached, "user_id", "left_semi"),
                       of("late").join(reached, "user_id", "left_semi"), device_firsts=firsts)]
        if not again.isEmpty():
            parts.append(since(arrived.drop("event_date").join(again, "user_id", "left_semi"), again))
        reduce(DataFrame.unionByName, parts).write.mode("overwrite").parquet(f"{path}/inputs/batch_id={batch_id}")

        # Merged by maximum and minimum, so late rows and a repeated micro-batch do no harm.
        last = write_table(user_points(points.unionByName(rows, allowMissingColumns=True)),
                           f"{path}/points/batch_id={batch_id}")
        used = write_table(device_firsts(firsts.withColumnRenamed("first_seen_at", "transaction_date")
                                         .unionByName(rows, allowMissingColumns=True)), f"{path}/used/batch_id={batch_id}")
        store.replace(users, last, "state", "user_points", ["user_id"])
        store.replace(users, used, "state", "device_firsts", ["user_id"])

    _run_batches(transactions, path, handle)
    return latest_per_key(spark.read.option("basePath", f"{path}/inputs").parquet(f"{path}/inputs"), ["transaction_id"])


def _ways(rows: DataFrame, points: DataFrame, horizon: timedelta) -> DataFrame:
    """``(user_id, first_new, way)``: whether a user's new rows are in order, late within the horizon, or old."""
    newest = rows.agg(F.max("transaction_date")).scalar()
    first = (rows.filter(F.col("user_id").isNotNull()).groupBy("user_id")
             .agg(F.min("transaction_date").alias("first_new")))
    last = points.select("user_id", F.col("transaction_date").alias("_last"))
    way = (F.when(F.col("first_new") < newest - F.lit(horizon), "old")
           .when(F.col("first_new") <= F.col("_last"), "late").otherwise("in order"))
    return first.join(last, "user_id", "left").select("user_id", "first_new", way.alias("way"))


def run_scored_alerts(transactions: DataFrame, path: str, versions: DataFrame, baseline: DataFrame, risk: DataFrame,
                      threshold: float = 0.7, model: LogisticScorer | None = None) -> DataFrame:
    """Transactions whose score is above the threshold: those the batch scoring of the same rows finds."""
    inputs = run_features(transactions, path, versions, baseline, risk)
    return (with_scores(inputs, model).filter(F.col("fraud_probability") > threshold)
            .select("transaction_id", "user_id", "transaction_date", "fraud_probability", "risk_tier"))


def latest_per_key(written: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of rows that several micro-batches wrote, those of the last."""
    newest = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("batch_id")))
    return written.withColumn("_rank", newest).filter(F.col("_rank") == 1).drop("_rank", "batch_id")


def _run_batches(stream: DataFrame, path: str, handle: Callable[[DataFrame, int], None]) -> None:
    query = (stream.writeStream.foreachBatch(handle).trigger(availableNow=True)
             .option("checkpointLocation", f"{path}-checkpoint").start())
    query.awaitTermination()


def _batches(spark: SparkSession, path: str, schema: StructType, last: int) -> DataFrame:
    """What micro-batches up to ``last`` wrote."""
    numbered = StructType([*schema.fields, StructField("batch_id", LongType())])
    return spark.read.schema(numbered).option("basePath", path).parquet(path).filter(F.col("batch_id") <= last)


def _run_partials(stream: DataFrame, path: str, partial: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The partial sums of every micro-batch."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _run_batches(stream, path, handle)
    return stream.sparkSession.read.option("basePath", path).parquet(path).drop("batch_id")


def run_deduplicated(raw: DataFrame, path: str) -> DataFrame:
    """Typed rows, one per id however far apart its copies arrive; returns the table.

    The copy of the first micro-batch stays; of copies in one micro-batch, the
    one that the batch form keeps.
    """
    spark = raw.sparkSession

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = zoned(deduplicate(typed(batch)))
        if batch_id:
            held = _batches(spark, path, rows.schema, batch_id - 1)
            rows = rows.join(held.select("transaction_id"), "transaction_id", "left_anti")
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _run_batches(raw, path, handle)
    return spark.read.option("basePath", path).parquet(path).drop("batch_id")


def run_sliding_velocity(transactions: DataFrame, path: str, width: str = "1 hour", slide: str = "5 minutes") -> DataFrame:
    """Transactions per user in sliding windows; returns the table.

    A micro-batch is written as its counts per user and slot, a slot being the
    longest time that every window holds whole or not at all. The counts are
    dealt by user, and only then does each go into the windows around it, a
    bounded number of them per task. However many rows a user has, what is left
    of them is a row per slot and micro-batch.
    """
    lengths = transactions.sparkSession.sql(f"SELECT interval {width} AS width, interval {slide} AS slide").first()
    slot = f"{math.gcd(*(length // timedelta(microseconds=1) for length in lengths))} microseconds"

    def per_slot(batch: DataFrame) -> DataFrame:
        return (zoned(batch).groupBy("user_id", F.window("transaction_date", slot)).agg(F.count("*").alias("_n"))
                .select("user_id", F.col("window.start").alias("_slot"), "_n"))

    partials = _run_partials(transactions, path, per_slot)
    windows = max(1, -(-lengths["width"] // lengths["slide"]))
    tasks = max(1, -(-partials.count() * windows // GROUPS))
    return (partials.repartition(tasks, "user_id").groupBy("user_id", "_slot").agg(F.sum("_n").alias("_n"))
            .groupBy("user_id", F.window("_slot", width, slide)).agg(F.sum("_n").alias("transactions"))
            .select("user_id", F.col("window.start").alias("window_start"), "transactions"))


def run_burst_sessions(transactions: DataFrame, path: str, gap: str = SESSION_GAP, at_least: int = 2) -> DataFrame:
    """Runs of a user's transactions no more than ``gap`` apart, those still open at the end too; returns the table.

    A micro-batch is written as the intervals its rows make by themselves, and
    nothing earlier is read for it. Intervals of all micro-batches that touch
    are joined in the result, so a late row may join two sessions.
    """
    partials = _run_partials(transactions, path, lambda batch: intervals(batch, gap))
    return (merge_intervals(partials).filter(F.col("transactions") >= at_least)
            .select("user_id", "session_start", "session_end", "transactions", "fraud"))


def intervals(rows: DataFrame, gap: str = SESSION_GAP) -> DataFrame:
    """Sessions of one or more rows each; rows without a time are in none."""
    points = zoned(rows).filter(F.col("transaction_date").isNotNull()).select(
        "user_id", F.col("transaction_date").alias("session_start"),
        (F.col("transaction_date") + F.expr(f"interval {gap}")).alias("session_end"),
        F.lit(1).cast("long").alias("transactions"),
        F.coalesce(F.col("is_fraud_label").cast("long"), F.lit(0)).alias("fraud"))
    return merge_intervals(points)


def merge_intervals(sessions: DataFrame) -> DataFrame:
    """Intervals of a user that overlap or touch, joined into one as ``session_window`` does.

    First within the days they start on, so that a user with a third of all
    rows is spread over the days; what is left of one user after that is no
    more than a day has gaps, times the days.
    """
    by_day = _joined(sessions.withColumn("_day", F.to_date("session_start")), ["user_id", "_day"])
    return _joined(by_day.drop("_day"), ["user_id"])


def _joined(sessions: DataFrame, parts: Sequence[str]) -> DataFrame:
    in_order = Window.partitionBy(*parts).orderBy("session_start", "session_end")
    reached = F.max("session_end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("session_start") <= F.col("_reached"), 0).otherwise(1)
    return (sessions.withColumn("_reached", reached).withColumn("_opens", opens)
            .withColumn("_session", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
            .groupBy(*parts, "_session")
            .agg(F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"),
                 F.sum("transactions").alias("transactions"), F.sum("fraud").alias("fraud")).drop("_session"))


def run_daily_kpi(scored: DataFrame, path: str) -> DataFrame:
    """The daily measures, rows without a date in a group of their own as in the batch form; returns the table."""
    def partial(batch: DataFrame) -> DataFrame:
        return batch.groupBy(F.to_date("transaction_date").alias("date_key")).agg(
            F.count("*").alias("total_transactions"),
            *[F.count_if(F.col("risk_tier") == tier).alias(f"flagged_{tier.lower()}") for tier in ("High", "Medium", "Low")],
            F.sum("fraud_probability").alias("_sum"), F.count("fraud_probability").alias("_scored"))

    counts = ["total_transactions", "flagged_high", "flagged_medium", "flagged_low"]
    return _run_partials(scored, path, partial).groupBy("date_key").agg(
        *[F.sum(c).alias(c) for c in counts],
        F.try_divide(F.sum("_sum"), F.sum("_scored")).alias("avg_fraud_probability"))


def run_append(stream: DataFrame, path: str) -> DataFrame:
    """Write finished rows as they come; returns the table."""
    query = (stream.writeStream.format("parquet").outputMode("append").trigger(availableNow=True)
             .option("checkpointLocation", f"{path}-checkpoint").start(path))
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def run_updates(stream: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Write changed groups per micro-batch; returns the latest row per key.

    Each batch owns one folder, so a repeated batch replaces itself.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (stream.writeStream.outputMode("update").trigger(availableNow=True).foreachBatch(write)
             .option("checkpointLocation", f"{path}-checkpoint").start())
    query.awaitTermination()
    return latest_per_key(stream.sparkSession.read.option("basePath", path).parquet(path), keys)
