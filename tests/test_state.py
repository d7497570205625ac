import datetime as dt

from pyspark.sql import functions as F

from tests.helpers import rows_of
from txnrisk.operators import state


def rows(spark, *values):
    return spark.createDataFrame(
        [(k, dt.datetime.fromisoformat(t), v) for k, t, v in values], "id string, ts timestamp, v int")


def test_watermark_of_empty_state_is_the_floor(spark):
    assert rows_of(state.watermark(rows(spark), "ts")) == [(dt.datetime(1900, 1, 1),)]
    days = spark.createDataFrame([], "d date")
    assert rows_of(state.watermark(days, "d")) == [(dt.date(1900, 1, 1),)]


def test_new_rows_are_strictly_later(spark):
    held = rows(spark, ("a", "2024-01-05", 1))
    batch = rows(spark, ("b", "2024-01-04", 1), ("c", "2024-01-05", 1), ("d", "2024-01-05 00:00:00.000001", 1))
    assert rows_of(state.new_rows(batch, "ts", held), "id") == [("d",)]
    assert state.new_rows(batch, "ts", None).count() == 3
    assert state.new_rows(batch, "ts", rows(spark)).count() == 3


def test_watermark_is_pushed_to_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    rows(spark, ("a", "2024-01-05", 1)).write.parquet(path)
    table = spark.read.parquet(path)
    plan = state.new_rows(table, "ts", table)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts,ScalarSubquery" in plan


def test_upsert(spark):
    held = rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-01", 1))
    batch = rows(spark, ("b", "2024-01-02", 2), ("c", "2024-01-02", 2))
    assert rows_of(state.upsert(held, batch, ["id"]), "id", "v") == [("a", 1), ("b", 2), ("c", 2)]
    assert rows_of(state.upsert(None, batch, ["id"]), "id", "v") == [("b", 2), ("c", 2)]
    assert rows_of(state.append(held, batch), "id", "v") == [("a", 1), ("b", 1), ("b", 2), ("c", 2)]


def test_partition_upsert_touches_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = lambda *values: state.with_event_date(rows(spark, *values), "ts")
    state.write_by_day(dated(("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-01-03", 1)), path)
    untouched = {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "event_date=2024-01-01").iterdir()}
    # b moves from the 2nd to the 3rd, which leaves the 2nd without rows.
    days = state.upsert_partitions(spark, path, dated(("b", "2024-01-03", 2), ("d", "2024-01-04", 2)), ["id"])
    assert days == [dt.date(2024, 1, 2), dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    assert rows_of(spark.read.parquet(path), "id", "v") == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert untouched == {f: f.stat().st_mtime_ns for f in (tmp_path / "t" / "event_date=2024-01-01").iterdir()}


def test_partition_upsert_of_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = state.with_event_date(rows(spark, ("a", "2024-01-01", 1)), "ts")
    state.write_by_day(dated, path)
    assert state.upsert_partitions(spark, path, dated.limit(0), ["id"]) == []


def test_affected_history(spark):
    held = rows(spark, ("a", "2024-01-01", 1), ("a", "2024-01-02", 2), ("b", "2024-01-01", 3))
    batch = rows(spark, ("a", "2024-01-02", 2), ("a", "2024-01-03", 2))
    keys = state.affected(batch, "id")
    assert keys.count() == 1
    for heavy in ([], ["a"]):
        assert rows_of(state.history_of(held, keys, "id", heavy, "v"), "v") == [(1,), (2,)]


def test_rewritten_days_are_in_few_files(spark, tmp_path):
    path = tmp_path / "t"
    held = spark.range(400).selectExpr("id", "date_add(date'2024-01-01', cast(id % 2 as int)) AS event_date", "0 AS v")
    state.write_by_day(held, str(path))
    batch = state.write_table(held.filter("id < 300").withColumn("v", F.lit(1)).repartition(8), str(tmp_path / "batch"))
    days = state.upsert_partitions(spark, str(path), batch, ["id"], days=[dt.date(2024, 1, 1), dt.date(2024, 1, 2)], staged=True)
    assert [len(list((path / f"event_date={day}").glob("*.parquet"))) for day in days] == [1, 1]
    assert rows_of(spark.read.parquet(str(path)).groupBy("v").count(), "v", "count") == [(0, 100), (1, 300)]


def test_upsert_of_a_written_batch_writes_only_the_table(spark, tmp_path, monkeypatch):
    path = tmp_path / "t"
    dated = lambda *values: state.with_event_date(rows(spark, *values), "ts")
    state.write_by_day(dated(("a", "2024-01-01", 1), ("b", "2024-01-02", 1), ("c", "2024-01-02", 1), ("a", "2024-01-05", 1)), str(path))
    batch = state.write_table(dated(("b", "2024-01-03", 2), ("d", "2024-01-02", 2), ("d", "2024-01-02", 2)), str(tmp_path / "batch"))
    monkeypatch.setattr(state, "scratch", None)
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    for stored in (rows(spark, ("b", "2024-01-01", 0)), batch):  # the second time all are stored
        assert state.upsert_partitions(spark, str(path), batch, ["id"], days=days, staged=True, stored=stored) == days
        assert rows_of(spark.read.parquet(str(path)), "id", "v") == [("a", 1), ("a", 1), ("b", 2), ("c", 1), ("d", 2), ("d", 2)]


def test_days_that_lose_all_rows_are_dropped(spark, tmp_path):
    path = tmp_path / "t"
    state.write_by_day(state.with_event_date(rows(spark, ("a", "2024-01-01", 1), ("b", "2024-01-02", 1)), "ts"), str(path))
    for gone in (dt.date(2024, 1, 2), dt.date(2024, 1, 1)):
        held = spark.read.parquet(str(path)) if gone.day == 2 else spark.read.schema("id string, ts timestamp, v int, event_date date").parquet(str(path))
        state.overwrite_days(spark, str(path), held.filter(held.event_date != gone), [dt.date(2024, 1, 1), dt.date(2024, 1, 2)])
        assert not (path / f"event_date={gone}").exists()


def test_days_without_rows_to_replace_are_added_to(spark, tmp_path):
    path = tmp_path / "t"
    dated = lambda *values: state.with_event_date(rows(spark, *values), "ts")
    files = lambda day: set((path / f"event_date={day}").glob("*.parquet"))
    first, second = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    state.write_by_day(dated(("a", "2024-01-01", 1), ("b", "2024-01-02", 1)), str(path))
    before = files(first), files(second)
    batch = dated(("c", "2024-01-01", 2), ("b", "2024-01-02", 2), ("d", "2024-01-03", 2))
    days = [first, second, dt.date(2024, 1, 3)]
    assert state.upsert_partitions(spark, str(path), batch, ["id"], days=days, staged=True,
                                   stored=rows(spark, ("b", "2024-01-02", 1)), holding=[second]) == days
    assert before[0] < files(first) and not before[1] & files(second)
    assert rows_of(spark.read.parquet(str(path)), "id", "v") == [("a", 1), ("b", 2), ("c", 2), ("d", 2)]


def test_a_day_of_many_small_files_is_written_anew(spark, tmp_path):
    path, day = tmp_path / "t", dt.date(2024, 1, 1)
    for number in range(state.MOST_SMALL_FILES + 1):
        batch = state.with_event_date(rows(spark, (f"a{number}", "2024-01-01", number)), "ts")
        if number == 0:
            state.write_by_day(batch, str(path))
        else:
            state.upsert_partitions(spark, str(path), batch, ["id"], days=[day], staged=True, stored=batch.limit(0), holding=[])
        held = len(list((path / f"event_date={day}").glob("*.parquet")))
        assert held == (1 if number == state.MOST_SMALL_FILES else number + 1)
    assert spark.read.parquet(str(path)).count() == state.MOST_SMALL_FILES + 1
