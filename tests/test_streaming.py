import datetime as dt
import functools
import shutil

from pyspark.sql import DataFrame, functions as F

from tests.helpers import raw_rows, rows_of, transactions
from txnrisk.operators.baselines import merchant_risk, user_baseline
from txnrisk.operators.clean import typed
from txnrisk.operators import kpi
from txnrisk.operators.features import build_features
from txnrisk.plans import layers
from txnrisk.plans.pipeline import run_pipeline
from txnrisk.sources import csv_files
from txnrisk.sources.tables import LayerStore
from txnrisk.streaming import streams
from txnrisk.streaming.daily import run_pipeline_stream


def stream_of(spark, folder, *frames):
    """Files read one per micro-batch, in order."""
    for number, frame in enumerate(frames):
        frame.coalesce(1).write.mode("append").parquet(str(folder / "in"))
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))


def test_copies_are_dropped_across_batches(spark, tmp_path):
    first = raw_rows(spark, [dict(TransactionID="T1", TransactionAmount="1"), dict(TransactionID=None)])
    again = raw_rows(spark, [dict(TransactionID="T1", TransactionAmount="2"), dict(TransactionID="T2")])
    rows = streams.deduplicated(stream_of(spark, tmp_path, first, again))
    assert rows_of(streams.run_append(rows, str(tmp_path / "out")), "transaction_id", F.col("transaction_amount").cast("int")) == [
        ("T1", 1), ("T2", 10)]


def test_sessions_close_with_the_watermark(spark, tmp_path):
    burst = transactions(spark, [dict(transaction_date=f"2024-01-01 00:0{m}:00", is_fraud_label=m == 3) for m in (0, 3, 6)]
                         + [dict(transaction_date="2024-01-01 00:30:00")])
    later = transactions(spark, [dict(transaction_id="S", user_id="sentinel", transaction_date="2024-01-02 00:00:00")])
    sessions = streams.burst_sessions(stream_of(spark, tmp_path, burst, later))
    found = streams.run_append(sessions, str(tmp_path / "out"))
    assert rows_of(found, "user_id", "session_start", "session_end", "transactions", "fraud") == [
        ("U1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 16), 3, 1)]


def test_updates_keep_the_newest_value_per_key(spark, tmp_path):
    first = transactions(spark, [dict(transaction_date="2024-01-01 00:01:00")])
    more = transactions(spark, [dict(transaction_id="X", transaction_date="2024-01-01 00:02:00")])
    counts = streams.sliding_velocity(stream_of(spark, tmp_path, first, more))
    table = streams.run_updates(counts, str(tmp_path / "out"), ["user_id", "window_start"])
    assert table.count() == 12 and {r.transactions for r in table.collect()} == {2}


def test_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    now = transactions(spark, [dict(transaction_date="2024-01-05 12:00:00")])
    late = transactions(spark, [dict(transaction_id="L", transaction_date="2024-01-01 00:00:00")])
    rows = [f.withColumn("risk_tier", F.lit("Low")).withColumn("fraud_probability", F.lit(0.1)) for f in (now, now, late)]
    kpis = streams.daily_kpi(stream_of(spark, tmp_path, *rows))
    table = streams.run_updates(kpis, str(tmp_path / "out"), ["date_key"])
    assert rows_of(table, F.col("date_key").cast("string"), "total_transactions") == [("2024-01-05", 2)]


def test_copies_are_dropped_however_far_apart(spark, tmp_path):
    dates = {"T1": "2024-01-01", "T2": "2024-01-09", "T3": "2023-12-01"}
    first, other, again = (raw_rows(spark, [dict(TransactionID=i, TransactionAmount=amount, TransactionDate=f"{dates[i]}T00:00:00+00:00")
                                            for i in ids]) for ids, amount in (("T1 T1".split(), "1"), (["T2"], "2"), (["T1", "T3"], "3")))
    found = streams.run_deduplicated(stream_of(spark, tmp_path, first, other, again), str(tmp_path / "out"))
    assert rows_of(found, "transaction_id", F.col("transaction_amount").cast("int")) == [("T1", 1), ("T2", 2), ("T3", 3)]


def late_batches(spark):
    """Two bursts that a row five days late joins to one, and one that is still open at the end."""
    minutes = [(0, 3), (14, 18), None, (9,)]
    old = [transactions(spark, [dict(transaction_id=f"O{m}", transaction_date=f"2024-01-01 00:{m:02}:00", is_fraud_label=m == 3)
                                for m in ms]) if ms else None for ms in minutes]
    old[2] = transactions(spark, [dict(transaction_id=f"N{m}", transaction_date=f"2024-01-06 00:0{m}:00") for m in (0, 1)])
    return old


def test_sessions_take_late_rows_and_end_with_the_input(spark, tmp_path):
    found = streams.run_burst_sessions(stream_of(spark, tmp_path, *late_batches(spark)), str(tmp_path / "out"))
    assert rows_of(found, "user_id", "session_start", "session_end", "transactions", "fraud") == [
        ("U1", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 28), 5, 1),
        ("U1", dt.datetime(2024, 1, 6), dt.datetime(2024, 1, 6, 0, 11), 2, 0)]


def test_windows_and_days_take_late_rows(spark, tmp_path):
    batches = late_batches(spark)
    counts = streams.run_sliding_velocity(stream_of(spark, tmp_path / "v", *batches), str(tmp_path / "v" / "out"))
    whole = streams.sliding_velocity(functools.reduce(DataFrame.union, batches))
    assert rows_of(counts) == rows_of(whole)
    scored = [f.withColumn("risk_tier", F.when(F.col("is_fraud_label"), "High").otherwise("Low"))
              .withColumn("fraud_probability", F.minute("transaction_date") / 100) for f in batches]
    table = streams.run_daily_kpi(stream_of(spark, tmp_path / "k", *scored), str(tmp_path / "k" / "out"))
    assert rows_of(table, F.col("date_key").cast("string"), "total_transactions", "flagged_high", "flagged_low",
                   F.round("avg_fraud_probability", 6)) == [("2024-01-01", 5, 1, 4, 0.088), ("2024-01-06", 2, 0, 2, 0.005)]


def test_sliding_counts_are_written_by_slot(spark, tmp_path):
    """A row is written once, not once per window, also where windows are no multiple of the slide."""
    rows = [transactions(spark, [dict(transaction_id=f"{n}-{i}", user_id=f"U{i % 2}" if i % 5 else None, transaction_date=str(
        dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i * i % 97 + n))) for i in range(20)] + [dict(transaction_date=None)])
        for n in range(2)]
    for width, slide in (("1 hour", "5 minutes"), ("50 minutes", "20 minutes")):
        out = tmp_path / width
        counts = streams.run_sliding_velocity(stream_of(spark, out, *rows), str(out / "out"), width, slide)
        assert rows_of(counts) == rows_of(streams.sliding_velocity(rows[0].union(rows[1]), width, slide))
        assert spark.read.parquet(str(out / "out")).count() <= 40


def test_micro_batches_arrive_in_files_of_bounded_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(layers, "FILE_ROWS", 50, raising=False)
    ids = spark.range(1000).select(F.col("id").cast("string").alias("transaction_id"), F.current_date().alias("event_date"))

    def thousand(spark, folder):
        return ids

    seen = []
    found = layers.arriving(spark, str(tmp_path), layer=thousand)
    query = (found.writeStream.foreachBatch(lambda batch, _: seen.append(batch.groupBy(F.input_file_name()).count().collect()))
             .trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "checkpoint")).start())
    query.awaitTermination()
    assert [len(files) for files in seen] == [5] * 4
    assert sum(row["count"] for files in seen for row in files) == 1000
    assert max(row["count"] for files in seen for row in files) < 100


def test_days_of_rows_without_a_date(spark, tmp_path):
    scored = transactions(spark, [dict(), dict(transaction_date=None), dict(transaction_date=None)]).withColumns(
        {"risk_tier": F.lit("High"), "fraud_probability": F.lit(0.9)})
    table = streams.run_daily_kpi(stream_of(spark, tmp_path, scored), str(tmp_path / "out"))
    assert rows_of(table) == rows_of(kpi.daily_kpi(scored))


def test_sessions_equal_spark_sessions(spark):
    rows = transactions(spark, [dict(user_id=f"U{i % 3}" if i % 7 else None, transaction_date=str(
        dt.datetime(2024, 1, 1, 23) + dt.timedelta(minutes=i * i % 400 * 5 // 2)), is_fraud_label=i % 4 == 0) for i in range(200)])
    found = streams.merge_intervals(streams.intervals(rows)).filter(F.col("transactions") >= 2)
    assert rows_of(found) == rows_of(streams.burst_sessions(rows))


def arrivals(spark):
    """Rows of six days, a day per micro-batch; some a little late, one of a user unseen for long, one very late."""
    def row(name, user, day, minute, **more):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(days=day, minutes=minute)
        return dict(transaction_id=name, user_id=user, transaction_date=str(at), location_lat=float(minute % 90), **more)

    days = [[row(f"{d}-{u}-{m}", u, d, m, device_id=f"D{(d + m) % 4}") for u in ("U1", "U2") for m in (5, 40, 70, 900)]
            for d in range(6)]
    days[2].append(row("near", "U1", 1, 1000, device_id="D9"))
    days[3] += [row("old", "U2", 0, 50, device_id="D3"), row("seldom", "U3", 3, 10)]
    days[5].append(row("again", "U3", 5, 11))
    return [transactions(spark, rows) for rows in days]


def stream_inputs(spark, folder, batches, **options):
    versions = spark.createDataFrame([], "user_id string, billing_country string, dbt_valid_from timestamp_ntz, dbt_valid_to timestamp_ntz")
    baseline = user_baseline(batches[0], "2024-02-01")
    risk = merchant_risk(batches[0], "2024-02-01")
    whole = build_features(functools.reduce(DataFrame.union, batches), versions, baseline, risk)
    return whole, lambda stream: streams.run_features(stream, str(folder / "out"), versions, baseline, risk, **options)


def test_inputs_of_a_stream_equal_the_batch(spark, tmp_path):
    batches = arrivals(spark)
    whole, run = stream_inputs(spark, tmp_path, batches)
    assert rows_of(run(stream_of(spark, tmp_path, *batches))) == rows_of(whole)


def test_rows_beyond_the_horizon_are_not_read(spark, tmp_path):
    """Rows that arrived long ago are gone before the last micro-batches; their inputs do not miss them."""
    batches = arrivals(spark)
    whole, run = stream_inputs(spark, tmp_path, batches)
    run(stream_of(spark, tmp_path, *batches[:4]))
    for number in range(2):
        shutil.rmtree(tmp_path / "out" / "rows" / f"batch_id={number}")
    assert rows_of(run(stream_of(spark, tmp_path, *batches[4:]))) == rows_of(whole)


def test_event_time_must_be_zoned(spark):
    rows = spark.range(1).select(F.lit("2024-01-01").cast("timestamp_ntz").alias("transaction_date"))
    assert dict(streams.zoned(rows).dtypes)["transaction_date"] == "timestamp"


def test_messages_parse_like_files(spark):
    text = '{"TransactionID": "T1", "TransactionAmount": "5.50", "TransactionDate": "2024-01-01T00:00:00+00:00"}'
    messages = spark.createDataFrame([(bytearray(text, "utf-8"),)], "value binary")
    assert rows_of(typed(streams.parse_messages(messages)), "transaction_id", F.col("transaction_amount").cast("double"),
                   "user_id") == [("T1", 5.5, None)]


def test_csv_files_are_taken_once(spark, tmp_path):
    raw = raw_rows(spark, [dict(TransactionID="T1")])
    csv_files.write_daily_csv(raw.withColumn("TransactionDate", F.col("TransactionDate").cast("timestamp")),
                              str(tmp_path / "in"))
    for _ in range(2):
        table = streams.run_append(streams.csv_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"))
    assert rows_of(table, "TransactionID") == [("T1",)]


def test_streamed_run_equals_daily_runs(spark, tmp_path):
    days = [raw_rows(spark, [dict(TransactionID=f"{d}-{i}", TransactionDate=f"2024-01-0{d}T00:{i}0:00+00:00",
                                  LocationLat=str(i * 20)) for i in range(3)]) for d in (1, 2)]
    store = LayerStore(spark, str(tmp_path / "streamed"))
    run_pipeline_stream(store, stream_of(spark, tmp_path, *days), "2024-02-01", str(tmp_path / "checkpoint"))
    daily = LayerStore(spark, str(tmp_path / "daily"))
    for raw in days:
        run_pipeline(daily, raw, "2024-02-01")
    for name in ("features", "scores"):
        streamed, expected = (spark.read.parquet(s.path("gold", name)) for s in (store, daily))
        assert rows_of(streamed) == rows_of(expected) and streamed.count() == 6
